"""Approximate nearest neighbours by inner product: stable projections in kd-trees, searched until a chi-square test holds.

Inside a shard every vector x gets one more coordinate, sqrt(M^2 - |x|^2) with M the
shard's longest vector, so that the largest inner product with q is the smallest
Euclidean distance to (q, 0): its square is |q|^2 + M^2 - 2 q.x.  A few normally
distributed directions project the vectors.  The normal law is 2-stable: the squared
projected distance of a pair, divided by its squared distance, has a chi-square law
with as many degrees of freedom as there are directions.

The projections of a shard are indexed by a kd-tree.  A query opens its leaves in
ascending distance of their boxes and verifies the projected neighbours there by exact
inner product.  With r the projected distance of the next box and d the distance of the
k-th best so far, a point nearer than d that is still unseen has a projected distance of
at least r, which happens with probability 1 - F(r^2 / d^2); the walk ends when
F(r^2 / d^2) >= ``confidence``, and a point is left out for the same reason.  So each of
the k neighbours is found with at least that probability, and no number of candidates is
fixed.  The k-th best goes on from shard to shard of a group.  Queries of a block that
open the same leaf do so in one matrix product.

Query blocks and groups of shards are rows of written tables that meet in tasks, one
task a pair; neither goes through the driver.  A group is bounded in bytes, a block in
rows; how many blocks there are does not change a result.

Defined results: vectors that are null, empty, zero or hold a null or a number that is
not finite take no part, nor do rows without an id; vectors of different length are not
compared; a repeated query row is answered once; a repeated candidate row is a candidate
each time, rows with the query's own id never are; equal scores rank by the smaller id;
an inner product too large for a double is infinite, and one that is no number ranks
last; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .support import clash_free, prepare, written


@dataclass(frozen=True)
class Settings:
    k: int = 20
    directions: int = 16
    confidence: float = 0.95
    leaf: int = 512
    shard_bytes: int = 8 << 20  # of vectors as doubles
    group_shards: int = 8
    least_block: int = 512
    most_block: int = 8192
    seed: int = 20


def chi_square_share(x: float, freedom: int) -> float:
    """The chi-square distribution function, by the series of the lower incomplete gamma function."""
    a, y = freedom / 2, x / 2
    if y <= 0:
        return 0.0
    term = total = 1.0
    n = 0
    while term > total * 1e-15:
        n += 1
        term *= y / (a + n)
        total += term
    return min(1.0, total * math.exp(a * math.log(y) - y - math.lgamma(a + 1)))


def chi_square_limit(share: float, freedom: int) -> float:
    """The number that a chi-square variable stays below with probability ``share``."""
    low, high = 0.0, float(freedom)
    while chi_square_share(high, freedom) < share:
        high *= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_share(middle, freedom) < share else (low, middle)
    return high


def directions(size: int, settings: Settings) -> np.ndarray:
    """Seeded normal directions for vectors of ``size`` numbers and the added coordinate.

    All pairs share the added coordinate, so its row has exactly the expected length: else the
    luck of one draw would stretch or shrink all projected distances alike.
    """
    rows = np.random.default_rng([settings.seed, size]).normal(size=(size + 1, settings.directions))
    rows[-1] *= math.sqrt(settings.directions / (rows[-1] ** 2).sum())
    return rows


class Index:
    """The vectors of a shard in the leaf order of the kd-tree over their projections; a box and a range for each leaf."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, settings: Settings):
        with np.errstate(over="ignore", invalid="ignore"):
            squares = (vectors.astype(np.float64) ** 2).sum(axis=1)
            most = squares.max()
            added = np.sqrt(most - squares)
            points = np.column_stack([vectors, added]) @ directions(vectors.shape[1], settings)
        if not np.isfinite(points).all():  # numbers near the end of the doubles: nothing is ruled out
            most, points = np.inf, np.zeros((len(vectors), settings.directions))
        points = points.astype(np.float32)
        leaves: list[np.ndarray] = []
        left = [np.argsort(ids, kind="stable")]
        while left:
            own = left.pop()
            span = points[own].max(axis=0) - points[own].min(axis=0)
            wide = int(np.argmax(span))
            if len(own) <= settings.leaf or span[wide] == 0:
                leaves.append(own)
                continue
            middle = len(own) // 2
            split = np.argpartition(points[own, wide], middle)
            left += [own[np.sort(split[middle:])], own[np.sort(split[:middle])]]
        placed = np.concatenate(leaves)
        self.vectors, self.ids, self.points, self.most = vectors[placed], ids[placed], points[placed], float(most)
        self.low = np.array([points[own].min(axis=0) for own in leaves])
        self.high = np.array([points[own].max(axis=0) for own in leaves])
        self.ends = np.cumsum([0, *map(len, leaves)])


PARTS = {"ids": np.int64, "points": np.float32, "low": np.float32, "high": np.float32, "ends": np.int64}
INDEX = "grp int, size int, width int, most double, vectors binary, " + ", ".join(f"{p} binary" for p in PARTS)
QUERIES = "block int, size int, query_ids binary, queries binary"


class Opened:
    """An index read back from its row."""

    def __init__(self, row, settings: Settings):
        self.size, self.most = int(row.size), float(row.most)
        kind = np.float32 if row.width == 4 else np.float64
        self.vectors = np.frombuffer(row.vectors, kind).reshape(-1, self.size).astype(np.float64)
        self.ids, self.points, self.low, self.high, self.ends = (
            np.frombuffer(getattr(row, name), kind) for name, kind in PARTS.items()
        )
        self.points, self.low, self.high = (
            x.reshape(-1, settings.directions).astype(np.float64) for x in (self.points, self.low, self.high)
        )
        self.squares = (self.points * self.points).sum(axis=1)


class Block:
    """Queries of one length with the k best of each so far, heaps of (score, -id)."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, settings: Settings):
        self.ids, self.queries, self.k = ids, queries, settings.k
        with np.errstate(over="ignore", invalid="ignore"):
            self.squares = (queries * queries).sum(axis=1)
            projected = queries @ directions(queries.shape[1], settings)[:-1]
        self.projected = np.where(np.isfinite(projected).all(axis=1, keepdims=True), projected, 0.0)
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in ids]
        self.floor = np.full(len(ids), -np.inf)  # score of the k-th best
        self.verified = np.zeros(len(ids), np.int64)

    def reach(self, rows: np.ndarray, index: Opened, limit: float) -> np.ndarray:
        """Squared projected distance from which on the test holds, for each of the queries."""
        with np.errstate(over="ignore", invalid="ignore"):
            whole = self.squares[rows] + index.most
            out = limit * np.maximum(whole - 2 * self.floor[rows], 0.0) + 1e-9 * whole
        return np.where(np.isfinite(out), out, np.inf)

    def verify(self, rows: np.ndarray, index: Opened, start: int, stop: int, near: np.ndarray) -> None:
        """Exact scores of the near ones of a leaf (queries x points) with the queries."""
        self.verified[rows] += near.sum(axis=1)
        with np.errstate(over="ignore", invalid="ignore"):
            scores = self.queries[rows] @ index.vectors[start:stop].T
            slack = 1e-12 * (1 + np.sqrt(self.squares[rows] * index.most))
            floor = np.where(np.isfinite(slack), self.floor[rows] - slack, -np.inf)
            # Only what can be among the best is scored again, in an order of its own numbers alone.
            hits, places = np.nonzero(near & ~(scores < floor[:, None]))
            places += start
            hits = rows[hits]
            other = index.ids[places] != self.ids[hits]
            hits, places = hits[other], places[other]
            exact = (index.vectors[places] * self.queries[hits]).sum(axis=1)
        exact = np.where(np.isnan(exact), -np.inf, exact)
        for i, score, found in zip(hits.tolist(), exact.tolist(), index.ids[places].tolist()):
            heap, entry = self.heaps[i], (score, -found)
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
        for i in np.unique(hits).tolist():
            if len(self.heaps[i]) == self.k:
                self.floor[i] = self.heaps[i][0][0]


def box_distances(index: Opened, projected: np.ndarray) -> np.ndarray:
    """Squared distance of each query (row) to the box of each leaf."""
    out = np.zeros((len(projected), len(index.low)))
    for j in range(projected.shape[1]):
        x = projected[:, j, None]
        gap = np.maximum(np.maximum(index.low[None, :, j] - x, x - index.high[None, :, j]), 0)
        out += gap * gap
    return out


def search(index: Opened, block: Block, rows: np.ndarray, limit: float) -> None:
    """Each query opens the leaves in ascending distance of their boxes until the test holds.

    The next projected neighbour is at least as far as the next box.  Of an open leaf, what lies
    beyond the reach is left out: the reach only falls.
    """
    projected = block.projected[rows] if math.isfinite(index.most) else np.zeros_like(block.projected[rows])
    bounds = box_distances(index, projected)
    order = np.argsort(bounds, axis=1, kind="stable")
    open_ = np.arange(len(rows))
    for turn in range(order.shape[1]):
        leaf = order[open_, turn]
        on = bounds[open_, leaf] <= block.reach(rows[open_], index, limit)
        open_, leaf = open_[on], leaf[on]
        for one in np.unique(leaf):
            own = open_[leaf == one]
            start, stop = index.ends[one : one + 2]
            gaps = (projected[own] ** 2).sum(axis=1)[:, None] + index.squares[None, start:stop]
            gaps -= 2 * projected[own] @ index.points[start:stop].T
            near = gaps <= block.reach(rows[own], index, limit)[:, None]
            block.verify(rows[own], index, start, stop, near)


def answer(shards: list[Opened], ids: np.ndarray, queries: np.ndarray, settings: Settings) -> Block:
    """The best of a group of shards for each query of a block."""
    limit = chi_square_limit(settings.confidence, settings.directions)
    block = Block(ids, queries, settings)
    for index in shards:
        for start in range(0, len(ids), 512):
            search(index, block, np.arange(start, min(start + 512, len(ids))), limit)
    return block


# --- tables ----------------------------------------------------------------------

def usable(table: DataFrame) -> DataFrame:
    """vec_id and v (the vector as it is) of all rows that take part."""
    x = F.col("embedding")
    number = lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) < float("inf"))
    return (
        clash_free(table, ["vec_id", "embedding"])
        .where(F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0))
        .where(F.forall(x, number) & F.exists(x, lambda e: e.cast("double") != 0))
        .select("vec_id", x.alias("v"))
    )


def _kind(vectors: DataFrame) -> np.dtype:
    """Single precision where the table has it: its numbers are doubles without a loss."""
    return np.dtype(np.float32 if vectors.schema["v"].dataType.elementType.typeName() == "float" else np.float64)


def build_index(vectors: DataFrame, settings: Settings) -> DataFrame:
    """One row for each shard; shards of a group are searched one after another."""
    kind = _kind(vectors)

    def build(group: pd.DataFrame) -> pd.DataFrame:
        index = Index(np.array(group["v"].tolist(), kind), group["vec_id"].to_numpy(np.int64), settings)
        parts = {name: np.ascontiguousarray(getattr(index, name), t).tobytes() for name, t in PARTS.items()}
        row = {"grp": int(group["shard"].iloc[0]) // settings.group_shards, "size": index.vectors.shape[1]}
        row |= {"width": kind.itemsize, "most": index.most, "vectors": index.vectors.tobytes()}
        return pd.DataFrame([row | parts])

    total = vectors.agg(F.sum(8 * F.size("v"))).first()[0] or 0
    shards = max(1, -(-total // settings.shard_bytes))
    # Row numbers of a written table are the same whenever it is read.
    shard = F.pmod(F.xxhash64(F.lit(settings.seed), F.monotonically_increasing_id()), F.lit(shards))
    return vectors.withColumn("shard", shard).groupBy(F.size("v"), "shard").applyInPandas(build, INDEX)


def query_blocks(asked: DataFrame, blocks: int, settings: Settings) -> DataFrame:
    """One row for each block of queries of equal length."""

    def gather(group: pd.DataFrame) -> pd.DataFrame:
        queries = np.array(group["v"].tolist(), np.float64)
        ids = group["vec_id"].to_numpy(np.int64)
        row = {"block": int(group["block"].iloc[0]), "size": queries.shape[1]}
        return pd.DataFrame([row | {"query_ids": ids.tobytes(), "queries": queries.tobytes()}])

    block = F.pmod(F.xxhash64(F.lit(settings.seed), "vec_id", "v"), F.lit(blocks)).cast("int")
    return asked.withColumn("block", block).groupBy(F.size("v"), "block").applyInPandas(gather, QUERIES)


def nearest(table: DataFrame, query: F.Column, settings: Settings = Settings()) -> DataFrame:
    """query_id, rank, vec_id, score for every row of ``table`` where ``query`` holds, among all rows."""
    spark = prepare(table.sparkSession)
    vectors = written(usable(table), "vectors")
    shards = written(build_index(vectors, settings), "projected-index")
    asked = written(vectors.where(query).distinct(), "asked")
    groups = (shards.agg(F.max("grp")).first()[0] or 0) + 1
    n = asked.count()
    # Large blocks move the shards less often; there must be enough pairs for all cores.
    wanted = -(-2 * spark.sparkContext.defaultParallelism // groups)
    blocks = max(1, -(-n // settings.most_block), min(wanted, -(-n // settings.least_block)))
    queries = written(query_blocks(asked, blocks, settings), "query-blocks")
    schema = "block int, query int, query_id long, vec_id long, score double"

    def search_pair(key, index: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out = []
        for q in block.itertuples():
            own = [Opened(row, settings) for row in index.itertuples() if row.size == q.size]
            if not own:
                continue
            ids = np.frombuffer(q.query_ids, np.int64)
            found = answer(own, ids, np.frombuffer(q.queries, np.float64).reshape(-1, q.size), settings)
            out += [
                (int(q.size), i, own_id, -e[1], e[0])
                for i, (own_id, heap) in enumerate(zip(ids.tolist(), found.heaps))
                for e in heap
            ]
        frame = pd.DataFrame(out, columns=["size", "query", "query_id", "vec_id", "score"])
        return frame.assign(block=int(key[1]))

    schema += ", size int"
    to_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    to_group = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("grp")
    pairs = max(groups * blocks, 1)
    left = shards.select("*", to_block).repartition(pairs, "grp", "block")
    right = queries.select("*", to_group).repartition(pairs, "grp", "block")
    found = left.groupBy("grp", "block").cogroup(right.groupBy("grp", "block")).applyInPandas(search_pair, schema)
    order = Window.partitionBy("size", "block", "query").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= settings.k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
