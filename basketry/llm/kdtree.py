"""Exact top-k by inner product with a KD-tree per shard.

Vectors become integers, floor(scale * x).  Median splits of a bounded sample cut
the space into cells, and the rows of a cell are dealt to shards by row number, so
that a cell of very many equal vectors is many shards.  A shard's tree splits at the
median of the dimension with the widest box until a leaf is small or all its points
are equal; every node keeps the tight bounding box of its points.  The trees are
written once, and so are the queries, in blocks.  Groups of shards meet blocks of
queries in tasks; neither goes through the driver.

For a query the box bound sum(max(q * low, q * high)) is the largest inner product a
node can hold.  The shards of a task are visited by the bounds of their roots, a
shard's leaves best first for each query; a query is done with a shard at the first
bound below its k-th score, which goes on to the next shard.  Queries that open the
same leaf at the same turn share one matrix product.  Equal scores are decided by the
smaller id, so a node whose bound equals the k-th score is still visited.

Defined results: vectors that are null, empty or hold a null or a number that is
not finite take no part, nor do rows without an id; vectors of different length
are not compared; a repeated query row is answered once; a repeated candidate row
is a candidate each time, but rows with the query's own id never are; scores
beyond a long are given as the largest or smallest long; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .support import clash_free, prepare, written


@dataclass(frozen=True)
class Settings:
    k: int = 10
    scale: int = 1024
    shard_rows: int = 2048
    leaf: int = 64
    group_bytes: int = 8 << 20  # points of the shards that one task holds
    block: int = 8192  # queries at most
    least_block: int = 128
    sample_rows: int = 4096  # vectors that the cells are cut by
    most_cells: int = 256


class Tree:
    """Points in leaf order; nodes as arrays of box, range of points, and children (-1: leaf)."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, leaf: int):
        order = np.argsort(ids, kind="stable")
        parts, nodes = [], []

        def grow(own: np.ndarray) -> int:
            box = points[own].min(axis=0), points[own].max(axis=0)
            node = len(nodes)
            nodes.append([*box, 0, 0, -1, -1])
            wide = int(np.argmax(box[1] - box[0]))
            if len(own) <= leaf or box[0][wide] == box[1][wide]:
                nodes[node][2] = sum(map(len, parts))
                nodes[node][3] = nodes[node][2] + len(own)
                parts.append(own)
                return node
            split = np.argsort(points[own, wide], kind="stable")
            middle = len(own) // 2
            nodes[node][4] = grow(own[np.sort(split[:middle])])
            nodes[node][5] = grow(own[np.sort(split[middle:])])
            return node

        grow(order)
        placed = np.concatenate(parts)
        self.points, self.ids = points[placed], ids[placed]
        self.low, self.high = (np.array([n[i] for n in nodes], points.dtype) for i in (0, 1))
        self.links = np.array([n[2:] for n in nodes], np.int64)

    def bounds(self, queries: np.ndarray, nodes=slice(None)) -> np.ndarray:
        """Largest inner product with a point of each of the nodes: queries x nodes."""
        return np.maximum(queries, 0) @ self.high[nodes].T + np.minimum(queries, 0) @ self.low[nodes].T


class Block:
    """Queries of one length with the best candidates found so far."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, largest: int, k: int):
        self.ids, self.k = ids, k
        self.kind = exact_kind(queries.shape[1], largest)
        self.queries = queries.astype(self.kind)
        lowest = -queries.shape[1] * max(1, largest) ** 2 - 1  # below every score
        self.floor = np.full(len(ids), lowest, self.kind)  # score of the k-th best
        self.last = np.full(len(ids), np.iinfo(np.int64).max)  # and its id
        self.heaps: list[list[tuple[int, int]]] = [[] for _ in ids]

    def take(self, rows: np.ndarray, tree: Opened, start: int, end: int) -> None:
        """Put the better points of a leaf into the heaps of (score, -id)."""
        scores = self.queries[rows] @ tree.points[start:end].T
        ids = tree.ids[start:end]
        floor = self.floor[rows, None]
        better = (scores > floor) | ((scores == floor) & (ids[None, :] < self.last[rows, None]))
        better &= ids[None, :] != self.ids[rows, None]
        hits, places = np.nonzero(better.astype(bool))
        if not len(hits):
            return
        order = np.lexsort((ids[places], -scores[hits, places], hits))
        hits, places = hits[order], places[order]
        # Of one leaf only the first k of a query can stay.
        begin = np.searchsorted(hits, hits, side="left")
        first = np.arange(len(hits)) - begin < self.k
        hits, places = hits[first], places[first]
        for i, score, found in zip(rows[hits].tolist(), scores[hits, places].tolist(), ids[places].tolist()):
            heap, entry = self.heaps[i], (int(score), -found)
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
        for i in np.unique(rows[hits]).tolist():
            if len(self.heaps[i]) == self.k:
                self.floor[i], self.last[i] = self.heaps[i][0][0], -self.heaps[i][0][1]


def search(tree: Opened, block: Block, rows: np.ndarray) -> None:
    """Each of the queries opens the leaves best first, until a bound is below its k-th score."""
    rows = rows[(tree.bounds(block.queries[rows], slice(0, 1))[:, 0] >= block.floor[rows]).astype(bool)]
    if not len(rows):
        return
    leaves = np.flatnonzero(tree.links[:, 2] < 0)
    bounds = tree.bounds(block.queries[rows], leaves)
    order = np.argsort(-bounds, axis=1, kind="stable")
    open_ = np.arange(len(rows))
    for turn in range(len(leaves)):
        leaf = order[open_, turn]
        on = (bounds[open_, leaf] >= block.floor[rows[open_]]).astype(bool)
        open_, leaf = open_[on], leaf[on]
        for one in np.unique(leaf):
            start, end = tree.links[leaves[one], :2]
            block.take(rows[open_[leaf == one]], tree, start, end)


def answer(trees: list[Opened], block: Block) -> None:
    """The best of a task's shards for each query, the shards with the largest bounds first."""
    for start in range(0, len(block.ids), 512):
        rows = np.arange(start, min(start + 512, len(block.ids)))
        promise = [tree.bounds(block.queries[rows], slice(0, 1)).mean() for tree in trees]
        for i in sorted(range(len(trees)), key=lambda i: (-promise[i], i)):
            search(trees[i], block, rows)


def exact_kind(dimensions: int, largest: int) -> np.dtype:
    """A type in which all inner products are exact."""
    most = dimensions * max(1, largest) ** 2
    return np.dtype(np.float64 if most < 1 << 53 else np.int64 if most < 1 << 63 else object)


def integer_vectors(table: DataFrame, scale: int) -> DataFrame:
    """vec_id, v (array of long) of all rows that take part."""
    x = F.col("embedding")
    numbers = F.transform(x, lambda e: e.cast("double"))
    finite = F.forall(numbers, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return (
        clash_free(table, ["vec_id", "embedding"])
        .where(F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0))
        .where(finite)
        .select("vec_id", F.transform(numbers, lambda e: F.floor(e * scale).cast("long")).alias("v"))
    )


class Cells:
    """Median splits of a sample, the widest dimension first: at most ``most`` cells."""

    def __init__(self, sample: np.ndarray, most: int):
        self.nodes: list[tuple[int, int, int, int]] = []  # dimension, cut, left and right (below 0: a cell)
        self.cells = 0

        def split(own: np.ndarray, share: int) -> int:
            wide = int(np.argmax(np.ptp(own, axis=0))) if len(own) else 0
            cut = int(np.sort(own[:, wide])[len(own) // 2]) if len(own) else 0
            left = own[:, wide] < cut if len(own) else None
            if share < 2 or left is None or not left.any():
                self.cells += 1
                return -self.cells
            node = len(self.nodes)
            self.nodes.append((0, 0, 0, 0))
            below, above = split(own[left], share // 2), split(own[~left], share - share // 2)
            self.nodes[node] = (wide, cut, below, above)
            return node

        self.root = split(sample, most)

    def place(self, points: np.ndarray) -> np.ndarray:
        """The cell of each point, from 0."""
        at = np.full(len(points), self.root)
        table = np.array(self.nodes, np.int64).reshape(-1, 4)
        while (inner := np.flatnonzero(at >= 0)).size:
            wide, cut, below, above = table[at[inner]].T
            at[inner] = np.where(points[inner, wide] < cut, below, above)
        return -1 - at


def in_cells(vectors: DataFrame, settings: Settings) -> DataFrame:
    """Adds ``cell``, cut by a bounded sample; vectors of another length than the sample's are cell 0."""
    size = F.size("v")
    common = vectors.groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "size").first()
    if common is None:
        return vectors.withColumn("cell", F.lit(0).cast("long"))
    drawn = vectors.where(size == common["size"]).orderBy(F.xxhash64("vec_id"), "vec_id").limit(settings.sample_rows)
    sample = np.array([r["v"] for r in drawn.select("v").collect()], np.int64)
    wanted = -(-common["n"] // settings.shard_rows)
    cells, width = Cells(sample, min(settings.most_cells, wanted)), common["size"]

    @F.pandas_udf("long")
    def place(v: pd.Series) -> pd.Series:
        out = np.zeros(len(v), np.int64)
        own = np.flatnonzero(v.map(len).to_numpy() == width)
        if len(own):
            out[own] = cells.place(np.array(v.iloc[own].tolist(), np.int64))
        return pd.Series(out)

    return vectors.withColumn("cell", place("v"))


def build_trees(vectors: DataFrame, settings: Settings) -> DataFrame:
    """One row for each shard: its tree, ready for ``Opened``; ``grp`` names the shards that meet in a task."""
    numbers = written(in_cells(vectors, settings).withColumn("number", F.monotonically_increasing_id()), "cells")
    total = numbers.agg(F.sum(8 * F.size("v"))).first()[0] or 0
    groups = max(1, -(-total // settings.group_bytes))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        points = np.array(group["v"].tolist(), np.int64)
        tree = Tree(points, group["vec_id"].to_numpy(np.int64), settings.leaf)
        return pd.DataFrame([{
            "grp": (int(group["number"].min()) * 2654435761 % (1 << 32) * groups) >> 32, "size": points.shape[1], "ids": tree.ids.tobytes(),
            "points": tree.points.tobytes(), "low": tree.low.tobytes(), "high": tree.high.tobytes(),
            "links": tree.links.tobytes(),
        }])

    size = F.size("v").alias("size")
    sizes = written(numbers.groupBy(size, "cell").agg(F.count(F.lit(1)).alias("rows")), "cell-sizes")
    shards = F.ceil(F.col("rows") / settings.shard_rows)
    schema = "grp long, size int, ids binary, points binary, low binary, high binary, links binary"
    return (
        numbers.withColumn("size", size)
        .join(sizes, ["size", "cell"])
        .withColumn("shard", F.pmod(F.xxhash64("number"), shards))
        .groupBy("size", "cell", "shard")
        .applyInPandas(build, schema)
    )


class Opened:
    """A shard's tree read back, in a type that is exact for the given queries."""

    def __init__(self, row, kind: np.dtype):
        self.ids = np.frombuffer(row.ids, np.int64)
        self.links = np.frombuffer(row.links, np.int64).reshape(-1, 4)
        self.points, self.low, self.high = (
            np.frombuffer(x, np.int64).reshape(-1, row.size).astype(kind) for x in (row.points, row.low, row.high)
        )

    bounds = Tree.bounds


def query_blocks(asked: DataFrame, blocks: int) -> DataFrame:
    """One row for each block of queries of equal length."""

    def gather(group: pd.DataFrame) -> pd.DataFrame:
        queries, ids = np.array(group["v"].tolist(), np.int64), group["vec_id"].to_numpy(np.int64)
        row = {"block": int(group["block"].iloc[0]), "size": queries.shape[1]}
        return pd.DataFrame([row | {"query_ids": ids.tobytes(), "queries": queries.tobytes()}])

    block = F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).cast("int")
    schema = "block int, size int, query_ids binary, queries binary"
    return asked.withColumn("block", block).groupBy(F.size("v"), "block").applyInPandas(gather, schema)


def top_k(table: DataFrame, query: F.Column, settings: Settings = Settings()) -> DataFrame:
    """query_id, rank, vec_id, score for every row of ``table`` where ``query`` holds, against all rows."""
    spark = prepare(table.sparkSession)
    vectors = written(integer_vectors(table, settings.scale), "vectors")
    trees = written(build_trees(vectors, settings), "trees")
    asked = written(vectors.where(query).distinct(), "queries")
    groups = (trees.agg(F.max("grp")).first()[0] or 0) + 1
    n = asked.count()
    # Large blocks move the shards less often; there must be enough pairs for all cores.
    wanted = -(-2 * spark.sparkContext.defaultParallelism // groups)
    blocks = max(1, -(-n // settings.block), min(wanted, -(-n // settings.least_block)))
    queries = written(query_blocks(asked, blocks), "query-blocks")
    largest = vectors.agg(F.max(F.array_max(F.transform("v", lambda e: F.abs(e))))).first()[0] or 0

    def search_pair(key, shards: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        fit = lambda x: max(-(1 << 63), min((1 << 63) - 1, x))
        out = []
        for q in block.itertuples():
            kind = exact_kind(q.size, largest)
            trees = [Opened(row, kind) for row in shards.itertuples() if row.size == q.size]
            ids = np.frombuffer(q.query_ids, np.int64)
            own = Block(ids, np.frombuffer(q.queries, np.int64).reshape(-1, q.size), largest, settings.k)
            answer(trees, own)
            for i, (own_id, heap) in enumerate(zip(ids.tolist(), own.heaps)):
                out += [(int(q.size), int(key[1]), i, own_id, -e[1], fit(e[0])) for e in heap]
        return pd.DataFrame(out, columns=["size", "block", "query", "query_id", "vec_id", "score"], dtype="int64")

    to_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    to_group = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("grp")
    pairs = groups * blocks
    left = trees.select("*", to_block).repartition(pairs, "grp", "block").groupBy("grp", "block")
    right = queries.select("*", to_group).repartition(pairs, "grp", "block").groupBy("grp", "block")
    schema = "size long, block long, query long, query_id long, vec_id long, score long"
    found = left.cogroup(right).applyInPandas(search_pair, schema)
    order = Window.partitionBy("size", "block", "query").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= settings.k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
