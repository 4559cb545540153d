"""Near-duplicate groups by SuperMinHash signatures, banding, verification and union-find.

* A document's set is its distinct k-word shingles, as 64-bit hashes.
  SuperMinHash gives each element one value j + r_j for each of the m slots, the
  slot order being the element's own random permutation; a slot keeps the
  smallest value over the set.  Rounds j stop as soon as every slot of a
  document holds a value below j + 1, which later rounds cannot lower.
* Documents with the same set are one class; only its first document goes on.
* Bands of ``rows`` slots are bucket keys.  With 30 bands of 5 rows a pair at
  the limit of 0.8 shares no bucket 7 times in 10^6 pairs, at 0.85 twice in 10^8.
* Links are found bucket by bucket without listing the pairs of a bucket.  First
  each member is compared to one centre, the member of its buckets that meets
  most others there, and confirmed on the full sets; that joins most groups.
  Buckets that still span several groups are cut into blocks, and each cell of
  two blocks intersects the full sets of its members at once inside a task, so
  that no link between different texts is lost.  Only links that join groups
  leave a task.

The signature estimate leaves out a pair only if it is more than five standard
deviations below the limit.

Defined results: null, empty and blank texts have an empty set and are linked
with nothing; repeated rows are members of one class; a row with a null
``doc_id`` is a document of its own, kept, with a null component; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components
from .support import GOLDEN, WordHashes, clash_free, mix, prepare, utf8, written

ASCII_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


@dataclass(frozen=True)
class Settings:
    shingle: int = 5
    #: Links need 100 * intersection >= percent * union.
    percent: int = 80
    bands: int = 30
    rows: int = 5
    stars: int = 1
    #: Members of a bucket that one block of the last search holds.
    block: int = 256

    @property
    def slots(self) -> int:
        return self.bands * self.rows

    @property
    def least_equal(self) -> int:
        """Equal slots below which a pair is five standard deviations under the limit."""
        limit = self.percent / 100
        return int(self.slots * (limit - 5 * (limit * (1 - limit) / self.slots) ** 0.5))


def shingle_sets(texts: list[str | None], size: int, hashes: WordHashes) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; shorter texts are one shingle of all their words."""
    out = []
    for text in texts:
        words = utf8(text).translate(ASCII_LOWER).split()
        n = min(size, len(words))
        if not n:
            out.append(np.zeros(0, np.uint64))
            continue
        h = hashes.array(words)
        total = np.full(len(h) - n + 1, n, np.uint64) * GOLDEN
        for i in range(n):
            total = mix(total ^ h[i : len(h) - n + 1 + i]) if i else mix(h[: len(h) - n + 1] + total)
        out.append(np.unique(total))
    return out


def super_minhash(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """Signatures (sets x slots, uint32): whole part (8 bits) the round, fraction (24 bits) the value drawn there."""
    if not 0 < slots <= 255:
        raise ValueError("slots must be from 1 to 255")
    out = np.full((len(sets), slots), 0xFFFFFFFF, np.uint32)
    run: list[int] = []
    held = 0
    for i, s in enumerate(sets):
        if run and held + len(s) > 100_000:
            out[run] = _signatures([sets[j] for j in run], slots)
            run, held = [], 0
        if len(s):
            run.append(i)
            held += len(s)
    if run:
        out[run] = _signatures([sets[j] for j in run], slots)
    return out


def _signatures(sets: list[np.ndarray], m: int) -> np.ndarray:
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    doc = np.repeat(np.arange(len(sets)), sizes)
    element = np.concatenate(sets)
    best = np.full(len(sets) * m, 0xFFFFFFFF, np.uint32)
    order = None  # of each element, as far as it has been drawn
    for j in range(m):
        with np.errstate(over="ignore"):
            draw = mix(element + GOLDEN * np.uint64(2 * j + 1))
            at = j + ((mix(draw + GOLDEN) >> np.uint64(32)) % np.uint64(m - j)).astype(np.int64)
        if j == 0:
            slot = at
        else:
            if order is None:
                order = np.tile(np.arange(m, dtype=np.uint8), (len(element), 1))
                order[rows, first] = 0  # the exchange of round 0
                order[:, 0] = first
            slot = order[rows, at].astype(np.int64)
            order[rows, at] = order[:, j]
        np.minimum.at(best, doc * m + slot, (draw >> np.uint64(40)).astype(np.uint32) + np.uint32(j << 24))
        # Texts of which no slot can become smaller are done.
        open_docs = best.reshape(len(sets), m).max(axis=1) >= np.uint32(min(255, j + 1)) << np.uint32(24)
        if j + 1 == m or not open_docs.any():
            break
        go_on = open_docs[doc]
        if j == 0:
            element, doc, first = element[go_on], doc[go_on], at[go_on]
        elif not go_on.all():
            element, doc, order = element[go_on], doc[go_on], order[go_on]
        rows = np.arange(len(element))
    return best.reshape(len(sets), m)


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band of each signature."""
    parts = signatures[:, : bands * rows].reshape(len(signatures), bands, rows).astype(np.uint64)
    with np.errstate(over="ignore"):
        key = np.broadcast_to(GOLDEN * np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2])
        for i in range(rows):
            key = mix(key ^ parts[:, :, i]) + GOLDEN
    return key.view(np.int64)


def signatures(docs: DataFrame, settings: Settings) -> DataFrame:
    """doc_id, n_shingles, set_a and set_b (fingerprint of the set), bands and the slots' low bytes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            sets = shingle_sets(batch["text"].tolist(), settings.shingle, hashes)
            found = super_minhash(sets, settings.slots)
            keys = band_keys(found, settings.bands, settings.rows)
            some = [len(s) > 0 for s in sets]
            with np.errstate(over="ignore"):
                yield pd.DataFrame({
                    "doc_id": batch["doc_id"].astype("Int64"),
                    "n_shingles": [len(s) for s in sets],
                    "set_a": [int(s.sum(dtype=np.uint64).view(np.int64)) for s in sets],
                    "set_b": [int(mix(s + GOLDEN).sum(dtype=np.uint64).view(np.int64)) for s in sets],
                    "bands": [list(k) if x else [] for k, x in zip(keys, some)],
                    "slots": [bytes(f) for f in (found & 0xFF).astype(np.uint8)],
                })

    schema = "doc_id long, n_shingles long, set_a long, set_b long, bands array<bigint>, slots binary"
    return clash_free(docs, ["doc_id", "text"]).mapInPandas(run, schema)


def confirmed(pairs: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """The pairs (src, dst) whose full sets meet the limit."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            kept = []
            sets = shingle_sets(batch["src_text"].tolist(), settings.shingle, hashes)
            for src, dst, own, text in zip(batch["src"], batch["dst"], sets, batch["dst_text"]):
                if dst not in held:  # the rows of a centre come together
                    held = {dst: shingle_sets([text], settings.shingle, hashes)[0]}
                other = held[dst]
                both = np.concatenate([own, other])
                both.sort()
                same = int((both[1:] == both[:-1]).sum())
                if 100 * same >= settings.percent * (len(both) - same):
                    kept.append((src, dst))
            yield pd.DataFrame(kept, columns=["src", "dst"], dtype="int64")

    src = texts.select(F.col("doc_id").alias("src"), F.col("text").alias("src_text"))
    dst = texts.select(F.col("doc_id").alias("dst"), F.col("text").alias("dst_text"))
    return pairs.join(src, "src").join(dst, "dst").mapInPandas(run, "src long, dst long")


def likely(pairs: DataFrame, slots: DataFrame, settings: Settings) -> DataFrame:
    """The pairs (src, dst) whose signatures allow the limit."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            a, b = (_matrix(batch[c], settings) for c in ("src_slots", "dst_slots"))
            yield batch.loc[(a == b).sum(axis=1) >= settings.least_equal, ["src", "dst"]]

    src = slots.select(F.col("doc_id").alias("src"), F.col("slots").alias("src_slots"), F.col("n_shingles").alias("n"))
    dst = slots.select(F.col("doc_id").alias("dst"), F.col("slots").alias("dst_slots"), F.col("n_shingles").alias("m"))
    near = 100 * F.least("n", "m") >= settings.percent * F.greatest("n", "m")
    joined = pairs.join(src, "src").join(dst, "dst").where(near).select("src", "dst", "src_slots", "dst_slots")
    return joined.mapInPandas(run, "src long, dst long")


def _matrix(column: pd.Series, settings: Settings) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(-1, settings.slots)


def star_pairs(member: DataFrame, step: int) -> DataFrame:
    """One pair for each member of a bucket that spans several groups: with the centre it shares most buckets with.

    A bucket's centre is the member that meets most others over all its buckets:
    an original meets its copies more often than they meet each other.
    """
    sizes = member.groupBy("bucket").agg(
        F.min("grp").alias("low"), F.max("grp").alias("high"), F.count("*").alias("n")
    )
    sizes = written(sizes.where("low < high").select("bucket", "n"), "bucket-sizes")
    mixed = written(member.join(sizes, "bucket"), "open-buckets")
    meets = mixed.groupBy("doc_id").agg(F.sum("n").alias("meets"))
    rank = F.struct("meets", F.xxhash64(F.lit(step), "doc_id").alias("h"), "doc_id", "grp")
    centre = mixed.join(meets, "doc_id").groupBy("bucket").agg(F.max(rank).alias("centre"))
    centre = centre.select("bucket", "centre.doc_id", "centre.grp").toDF("bucket", "dst", "dst_grp")
    centre = written(centre, "centres")
    pairs = mixed.join(centre, "bucket").where("grp <> dst_grp").groupBy(F.col("doc_id").alias("src"), "dst").count()
    best = pairs.groupBy("src").agg(F.max(F.struct("count", "dst")).alias("best"))
    return best.select("src", F.col("best.dst").alias("dst"))


CELL = ["bucket", "i", "j"]
CARRIED = "doc_id long, grp long, band int, n_shingles long, slots binary, bands array<bigint>"


def by_cell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of each cell, from batches of rows sorted by cell."""
    held = None
    for batch in batches:
        held = batch if held is None else pd.concat([held, batch], ignore_index=True)
        key = held[CELL].to_numpy()
        cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
        for x, y in zip([0, *cuts[:-1]], cuts):
            yield held.iloc[x:y]
        if len(cuts):
            held = held.iloc[cuts[-1] :].reset_index(drop=True)
    if held is not None and len(held):
        yield held


def in_cells(rows: DataFrame) -> DataFrame:
    return rows.repartition(*CELL).sortWithinPartitions(*CELL)


def likely_members(cell: pd.DataFrame, settings: Settings) -> np.ndarray:
    """Which rows of a cell have a partner in another group whose signature allows the limit.

    A pair counts in the first band that it shares, so that it is looked at once.
    """
    rest = cell["rest"].to_numpy()
    out = np.zeros(len(cell), bool)
    own, other = np.flatnonzero(rest), np.flatnonzero(~rest)
    if not len(own) or not len(other):
        return out
    slots = _matrix(cell["slots"], settings)
    band = int(cell["band"].iloc[0])
    earlier = np.stack(cell["bands"].to_numpy())[:, :band]
    size, grp = cell["n_shingles"].to_numpy(), cell["grp"].to_numpy()
    for k in own:
        # Sets of too different sizes cannot meet the limit.
        near = 100 * np.minimum(size[other], size[k]) >= settings.percent * np.maximum(size[other], size[k])
        hits = other[near & (grp[other] != grp[k])]
        hits = hits[(slots[hits] == slots[k]).sum(axis=1) >= settings.least_equal]
        hits = hits[~(earlier[hits] == earlier[k]).any(axis=1)]
        if len(hits):
            out[k] = out[hits] = True
    return out


def shared_counts(own: list[np.ndarray], other: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of all intersections: products of 0/1 matrices over the elements found in several sets."""
    every = own + other
    lengths = [len(s) for s in every]
    _, place, times = np.unique(np.concatenate(every), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(every)), lengths)
    shared = times[place] > 1
    column = (np.cumsum(times > 1) - 1)[place[shared]]
    row = row[shared]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = np.zeros((len(own), len(other)), np.float64)
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, columns):
        a, b = np.searchsorted(column, [first, first + columns])
        part = np.zeros((len(every), columns), np.float32)
        part[row[a:b], column[a:b] - first] = 1
        total += part[: len(own)] @ part[len(own) :].T
    return total


def cell_links(cell: pd.DataFrame, settings: Settings, hashes: WordHashes) -> list[tuple[int, int]]:
    """Links inside a cell on the full sets; of those that join the same groups, one."""
    own, other = cell[cell["rest"]], cell[~cell["rest"]]
    if own.empty or other.empty:
        return []
    a, b = (shingle_sets(x["text"].tolist(), settings.shingle, hashes) for x in (own, other))
    same = shared_counts(a, b)
    both = np.array([len(s) for s in a])[:, None] + np.array([len(s) for s in b])
    grp, grps = own["grp"].to_numpy(), other["grp"].to_numpy()
    linked = (100 * same >= settings.percent * (both - same)) & (grp[:, None] != grps)
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    out = []
    src, dst = own["doc_id"].to_numpy(), other["doc_id"].to_numpy()
    for i, j in zip(*np.nonzero(linked)):
        p, q = find(int(grp[i])), find(int(grps[j]))
        if p != q:
            parent[p] = q
            out.append((int(src[i]), int(dst[j])))
    return out


def rest_links(member: DataFrame, slots: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """Links between different groups in one bucket, found cell by cell.

    Members outside the largest group of a bucket meet all members, in cells of
    two blocks.  Signatures tell which rows of a cell need their texts; with
    those, all sets of a cell are intersected at once inside its task.  Only
    links that join groups leave it, no pairs.
    """
    sizes = member.groupBy("bucket", "grp").count()
    bucket = sizes.groupBy("bucket").agg(
        F.sum("count").alias("n"), F.max(F.struct("count", "grp")).alias("main"), F.count("*").alias("groups")
    )
    blocks = written(bucket.where("groups > 1").select(
        "bucket",
        F.col("main.grp").alias("main"),
        F.ceil(F.col("n") / settings.block).cast("int").alias("all_blocks"),
        F.ceil((F.col("n") - F.col("main.count")) / settings.block).cast("int").alias("rest_blocks"),
    ), "blocks")
    open_rows = member.join(blocks, "bucket").join(slots, "doc_id")
    block = lambda count, salt: F.pmod(F.xxhash64(F.lit(salt), "doc_id"), F.col(count)).cast("int")
    carried = [c.split()[0] for c in CARRIED.split(", ")]
    every = open_rows.select(
        "bucket", F.explode(F.sequence(F.lit(0), F.col("rest_blocks") - 1)).alias("i"),
        block("all_blocks", 1).alias("j"), F.lit(False).alias("rest"), *carried,
    )
    rest = open_rows.where("grp <> main").select(
        "bucket", block("rest_blocks", 2).alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("all_blocks") - 1)).alias("j"), F.lit(True).alias("rest"), *carried,
    )

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for cell in by_cell(batches):
            needed = likely_members(cell, settings)
            if needed.any():
                yield cell.loc[needed, [*CELL, "rest", "doc_id", "grp"]]

    def confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for cell in by_cell(batches):
            found = cell_links(cell, settings, hashes)
            if found:
                yield pd.DataFrame(found, columns=["src", "dst"], dtype="int64")

    cells = in_cells(every.unionByName(rest))
    needed = cells.mapInPandas(choose, "bucket long, i int, j int, rest boolean, doc_id long, grp long")
    needed = written(needed, "cells")
    return in_cells(needed.join(texts, "doc_id")).mapInPandas(confirm, "src long, dst long")


def class_links(member: DataFrame, slots: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """Confirmed links between members (doc_id, band, bucket) that decide the groups."""
    open_member = member.withColumn("grp", F.col("doc_id"))
    links = None
    for step in range(settings.stars):
        pairs = likely(star_pairs(open_member, step), slots, settings)
        new = written(confirmed(pairs, texts, settings), "links")
        links = new if links is None else links.unionByName(new)
        groups = written(components(links), "groups").withColumnRenamed("node", "doc_id")
        open_member = member.join(groups, "doc_id", "left").select(
            "doc_id", "band", "bucket", F.coalesce("component", "doc_id").alias("grp")
        )
    last = rest_links(open_member, slots, texts, settings)
    return last if links is None else links.unionByName(last)


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (smallest doc_id that links reach), kept."""
    prepare(docs.sparkSession)
    found = written(signatures(docs, settings), "signatures")
    known = found.where("doc_id is not null and n_shingles > 0")
    sets = ["n_shingles", "set_a", "set_b"]
    classes = written(known.groupBy(*sets).agg(F.min("doc_id").alias("first")), "classes")
    one = known.join(classes.withColumnRenamed("first", "doc_id"), [*sets, "doc_id"], "left_semi")
    one = one.dropDuplicates(["doc_id", *sets])
    member = one.select("doc_id", F.posexplode("bands").alias("band", "bucket"))
    # Written, so that the join deals both sides anew and splits the rows of a common bucket.
    shared = written(member.groupBy("bucket").count().where("count > 1").select("bucket"), "shared-buckets")
    member = written(member.join(shared, "bucket", "left_semi"), "buckets")
    members = written(member.select("doc_id").distinct(), "members")
    slots = written(one.select("doc_id", "n_shingles", "slots", "bands").join(members, "doc_id", "left_semi"), "slots")
    texts = written(
        clash_free(docs, ["doc_id", "text"])
        .join(members, "doc_id", "left_semi")
        .withColumn("h", F.xxhash64("text"))
        .dropDuplicates(["doc_id", "h"])
        .drop("h"),
        "texts",
    )
    links = class_links(member, slots, texts, settings)
    joined = known.join(classes, sets).select(F.col("doc_id").alias("src"), F.col("first").alias("dst"))
    groups = components(links.unionByName(joined))
    return found.join(groups, found["doc_id"] == groups["node"], "left").select(
        "doc_id",
        F.col("n_shingles").cast("long").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component", "doc_id"), F.lit(True)).alias("kept"),
    )
