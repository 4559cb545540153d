"""Vector best-fit packing of document pieces into sequences.

A piece is a vector of tokens, documents (1) and attention cost (its length
squared); a sequence has a capacity for each.  Inside a shard pieces are taken
from the largest to the smallest, and each goes to the open sequence that fits
it under every capacity and scores best: the smallest weighted norm of what
would be left (``residual``), or the largest weighted dot product of the piece
and what is left (``dot``).  Shards are made by row number, so no key decides
their size; sequences that stay under-filled are packed once more, as wholes,
across shards.  A shard is a few thousand rows of numbers; texts and ids never
travel.

Defined results: a null text is an empty document (its end id alone); a null
``doc_id`` is kept as null; repeated rows are packed once each; an empty table
gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .support import clash_free, prepare, written
from .tokens import default_path, encoder, ids_crc32

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@dataclass(frozen=True)
class Capacity:
    """Capacities of a sequence and the weights of the three dimensions in the score."""

    tokens: int = 4096
    documents: int | None = None  # none: as many as there are tokens
    attention: int | None = None  # none: the square of the tokens
    weights: tuple[float, float, float] = (1.0, 0.02, 0.02)
    score: str = "residual"

    def vector(self) -> np.ndarray:
        return np.array(
            [self.tokens, self.documents or self.tokens, self.attention or self.tokens**2], np.float64
        )


def token_pieces(
    docs: DataFrame, vocabulary: str | None = None, end_id: int = 1, capacity: Capacity = Capacity()
) -> DataFrame:
    """Pieces of every document: its ids and the end id, cut only where longer than a sequence."""
    path = vocabulary or default_path("word_bpe_49k.json")
    largest = min(capacity.tokens, int((capacity.attention or capacity.tokens**2) ** 0.5))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = encoder(path, "word")
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch["doc_id"].tolist(), words.encode(batch["text"].tolist(), end_id)):
                for piece, start in enumerate(range(0, len(ids), largest)):
                    part = ids[start : start + largest]
                    rows.append((doc_id, piece, start, len(part), ids_crc32(part)))
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    prepare(docs.sparkSession)
    return clash_free(docs, ["doc_id", "text"]).mapInPandas(run, PIECES)


def best_fit(items: np.ndarray, capacity: Capacity) -> tuple[np.ndarray, np.ndarray]:
    """Bin of each item and the tokens before it there; ``items`` has a row of three numbers each."""
    if capacity.score not in ("residual", "dot"):
        raise ValueError(f"unknown score: {capacity.score}")
    limit = capacity.vector()
    scaled = items / limit
    if (scaled > 1).any():
        raise ValueError("an item exceeds the capacity of a sequence")
    weights = np.array(capacity.weights)
    order = np.lexsort((np.arange(len(items)), -scaled.max(axis=1), -(scaled * weights).sum(axis=1)))
    left = np.empty((len(items), 3))  # of each open bin, in shares of the capacity
    label = np.empty(len(items), np.int64)
    bins, offsets = np.empty(len(items), np.int64), np.empty(len(items), np.int64)
    filled = np.zeros(len(items), np.int64)
    smallest = np.minimum.accumulate(scaled[order][::-1], axis=0)[::-1]  # of the items still to come
    opened = used = 0
    for step, i in enumerate(order):
        item = scaled[i]
        rest = left[:opened] - item
        fits = np.flatnonzero((rest >= -1e-12).all(axis=1))
        if len(fits):
            if capacity.score == "residual":
                at = fits[np.argmin((weights * rest[fits] ** 2).sum(axis=1))]
            else:
                at = fits[np.argmax((weights * left[fits] * item).sum(axis=1))]
        else:
            at, opened = opened, opened + 1
            left[at], label[at], used = 1.0, used, used + 1
        left[at] -= item
        bins[i], offsets[i] = label[at], filled[label[at]]
        filled[label[at]] += int(items[i, 0])
        if step + 1 < len(order) and (left[at] < smallest[step + 1] - 1e-12).any():
            opened -= 1  # nothing to come fits here: close it
            left[at], label[at] = left[opened], label[opened]
    return bins, offsets


def pack(pieces: DataFrame, capacity: Capacity = Capacity(), shard_rows: int = 4000, full: float = 0.98) -> DataFrame:
    """``sequence_id`` and ``offset`` for every piece (a table with ``length``; other columns are kept)."""
    spark = prepare(pieces.sparkSession)
    limit = capacity.vector()
    table = written(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    shards = max(1, -(-table.count() // shard_rows))

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        bins, offsets = best_fit(group[["tokens", "documents", "attention"]].to_numpy(np.float64), capacity)
        return pd.DataFrame({"item": group["item"], "shard": group["shard"], "bin": bins, "offset": offsets})

    def packed(items: DataFrame, parts: int) -> DataFrame:
        dealt = items.withColumn("shard", F.pmod(F.xxhash64("item"), F.lit(parts)))
        return dealt.groupBy("shard").applyInPandas(fit, "item long, shard long, bin long, offset long")

    alone = F.col("length") == int(limit[0])
    length = F.col("length").cast("double")
    items = table.where(~alone).select(
        F.col("row").alias("item"),
        length.alias("tokens"),
        F.lit(1.0).alias("documents"),
        (length * length).alias("attention"),
    )
    first = written(
        packed(items, shards).join(items, "item").select(
            F.col("item").alias("row"), "tokens", "attention", F.col("offset").alias("inner"),
            F.shiftleft(F.col("shard") + 1, 32).bitwiseOR(F.col("bin")).alias("bin_id"),
        ),
        "packed-once",
    )
    bins = first.groupBy(F.col("bin_id").alias("item")).agg(
        F.sum("tokens").alias("tokens"),
        F.count("*").cast("double").alias("documents"),
        F.sum("attention").alias("attention"),
    )
    loose = written(bins.where(F.col("tokens") < full * float(limit[0])), "loose-bins")
    again = packed(loose, max(1, -(-loose.count() // shard_rows))).select(
        F.col("item").alias("bin_id"),
        (-F.shiftleft(F.col("shard") + 1, 32).bitwiseOR(F.col("bin"))).alias("new_id"),
        F.col("offset").alias("outer"),
    )
    placed = first.join(again, "bin_id", "left").select(
        "row",
        F.coalesce("new_id", "bin_id").alias("sequence_id"),
        (F.coalesce("outer", F.lit(0)) + F.col("inner")).alias("offset"),
    )
    kept = [c for c in table.columns if c not in ("row", "sequence_id", "offset")]
    rest = table.where(~alone).join(placed, "row").select(*kept, "sequence_id", "offset")
    # A piece that fills a sequence needs no search; its row number names the sequence.
    whole = table.where(alone).select(
        *kept, (F.lit(1 << 62) + F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return rest.unionByName(whole)


def pack_documents(
    docs: DataFrame, vocabulary: str | None = None, end_id: int = 1, capacity: Capacity = Capacity()
) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    return pack(token_pieces(docs, vocabulary, end_id, capacity), capacity)
