"""How filters interact: what each removes in any order, from sorted posting lists of failing ids.

Every part of the corpus is cut into ranges of ids.  A range keeps, for each filter, the
sorted list of its failing documents, and likewise the lists of good and of toxic ones.
Unions of filters and the difference of a filter and a union are worked out range by
range: the lists are walked block by block, each list gallops (doubling steps, then a
binary search) to the block's range, and only what lies there is merged.  Sizes add up
over ranges, so a part as large as the corpus is as many rows as it has ranges.

An order of the filters needs only the sizes of F \\ U(S) for the filter F of each step
and the set S of filters before it: 80 numbers a part give all 120 orders of five.

The registered filters, on words ``[^\\x20\\x09-\\x0D]+`` of whole texts:

====  ==============================================================
A     under 100 words
B     100 * distinct words < 80 * words
C     100 * characters A-Z > 10 * code points
D     holds any of ``#$%&*|``
E     the same text as a document with a smaller id, anywhere
====  ==============================================================

Texts count as the same if the first 128 bits of their sha256 are.

Defined results: a null text is empty; a null part is the empty string; a null ``doc_id``
has no label, no smaller id and is smaller than none, so it never fails E; each repeated
row is a document of its own; documents of the same id and text do not make each other
fail E; a document is good (toxic) if any of its labels says so; an empty table has no
parts and gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .support import clash_free, prepare, shuffle_partitions, written

FILTERS = "ABCDE"
DUPLICATE = "E"
RANGE_ROWS = 1 << 16
#: Ids of one step of a walk over several lists.
BLOCK = 4096

UPPER = bytes(range(ord("A"), ord("Z") + 1))
SIGNS = b"#$%&*|"
FLAGS = "part string, doc_id long, fails int, same binary"
POSTINGS = (
    "part string, n_docs long, doc_ids array<bigint>, fails array<array<int>>, good array<int>, toxic array<int>"
)
#: One row for each filter and set of filters before it.
SIZES = "part string, letter int, before int, n_docs long, gone long, removed long, redundant long, good_lost long, toxic_lost long"


# --- sorted lists ----------------------------------------------------------------

def gallop(ids: np.ndarray, start: int, bound: int) -> int:
    """First place from ``start`` on that holds ``bound`` or more: doubling steps, then a binary search."""
    step, end = 1, start
    while end < len(ids) and ids[end] < bound:
        start, end = end + 1, end + step
        step *= 2
    return start + int(np.searchsorted(ids[start : min(end, len(ids))], bound))


def union(lists: list[np.ndarray]) -> np.ndarray:
    """Merge of sorted lists without repeats, block by block."""
    lists = [x for x in lists if len(x)]
    if len(lists) <= 1:
        return lists[0] if lists else np.empty(0, np.int32)
    at, out = [0] * len(lists), []
    while any(a < len(x) for a, x in zip(at, lists)):
        # Up to here at most a block of each list has to be looked at.
        bound = min(int(x[min(a + BLOCK, len(x)) - 1]) + 1 for a, x in zip(at, lists) if a < len(x))
        ends = [gallop(x, a, bound) for a, x in zip(at, lists)]
        runs = [x[a:e] for a, e, x in zip(at, ends, lists) if e > a]
        out.append(runs[0] if len(runs) == 1 else np.unique(np.concatenate(runs)))
        at = ends
    return np.concatenate(out)


def difference(ids: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Ids of the first list that are not in the second."""
    out, at = [np.empty(0, ids.dtype)], 0
    for start in range(0, len(ids), BLOCK):
        block = ids[start : start + BLOCK]
        at = gallop(others, at, int(block[0]))
        end = gallop(others, at, int(block[-1]) + 1)
        near = others[at:end]
        if not len(near):
            out.append(block)
            continue
        place = np.minimum(np.searchsorted(near, block), len(near) - 1)
        out.append(block[near[place] != block])
        at = end
    return np.concatenate(out)


# --- failing ids -----------------------------------------------------------------

def failures(text: bytes) -> int:
    """Bits of the filters that a text fails by itself, A lowest."""
    words = text.split()  # of bytes: exactly at space and U+0009..U+000D
    points = int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))
    upper = len(text) - len(text.translate(None, UPPER))
    return (
        (len(words) < 100)
        | (100 * len(set(words)) < 80 * len(words)) << 1
        | (100 * upper > 10 * points) << 2
        | (len(text.translate(None, SIGNS)) < len(text)) << 3
    )


def flag_documents(docs: DataFrame, part: str = "lang") -> DataFrame:
    """part, doc_id, the filters that a document fails as bits, and the hash of its text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [bytes(t) for t in batch["text"]]
            yield pd.DataFrame({
                "part": batch["part"],
                "doc_id": pd.array([None if pd.isna(x) else int(x) for x in batch["doc_id"]], "Int64"),
                "fails": [failures(t) for t in texts],
                "same": [hashlib.sha256(t).digest()[:16] for t in texts],
            })

    rows = clash_free(docs, ["doc_id", "text", part])
    return rows.select(
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        F.col("doc_id").cast("string").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
    ).mapInPandas(run, FLAGS)


def posting_lists(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """One row for each range of a part: its ids in order, and for each filter the sorted places of the failing ones.

    Places are positions in ``doc_ids``, so that documents of one id stay apart.
    """
    spark = prepare(docs.sparkSession)
    flags = written(flag_documents(docs, part), "filter-flags")
    # The smallest id of a text: summed in each task first.  Joined by id, so that no text is a hot key.
    first = flags.groupBy("same").agg(F.min("doc_id").alias("doc_id"))
    first = first.where("doc_id is not null").select(
        F.col("doc_id").alias("first_id"), F.col("same").alias("first_same"), F.lit(True).alias("is_first")
    )
    marks = clash_free(labels, ["doc_id", "quality", "toxic"]).groupBy(F.col("doc_id").alias("label_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    later = F.col("is_first").isNull() & F.col("doc_id").isNotNull()
    marked = (
        flags.join(first, (F.col("doc_id") == F.col("first_id")) & (F.col("same") == F.col("first_same")), "left")
        .join(marks, F.col("doc_id") == F.col("label_id"), "left")
        .select(
            "part", "doc_id", "same",
            F.col("fails").bitwiseOR(F.when(later, 1 << FILTERS.index(DUPLICATE)).otherwise(0)).alias("fails"),
            F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"),
        )
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0

        def rows(ready: pd.DataFrame) -> pd.DataFrame:
            out = []
            for name, own in ready.groupby("part", sort=False):
                for start in range(0, len(own), RANGE_ROWS):
                    one = own.iloc[start : start + RANGE_ROWS]
                    bits = one["fails"].to_numpy()
                    lists = [np.flatnonzero(bits >> i & 1).astype(np.int32) for i in range(len(FILTERS))]
                    good, toxic = (np.flatnonzero(one[c].to_numpy() == 1).astype(np.int32) for c in ("good", "toxic"))
                    ids = [None if pd.isna(x) else int(x) for x in one["doc_id"]]
                    out.append((name, len(one), ids, lists, good, toxic))
            return pd.DataFrame(out, columns=["part", "n_docs", "doc_ids", "fails", "good", "toxic"])

        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size >= RANGE_ROWS:
                yield rows(pd.concat(held))
                held, size = [], 0
        if held:
            yield rows(pd.concat(held))

    # Ranges over part, id and hash: neither a part nor an id with very many texts is one task.
    dealt = marked.repartitionByRange(shuffle_partitions(spark), "part", "doc_id", "same")
    ordered = dealt.sortWithinPartitions("part", "doc_id", "same").drop("same")
    text_ids = ordered.withColumn("doc_id", F.col("doc_id").cast("string"))
    return text_ids.mapInPandas(run, POSTINGS)


# --- sizes -----------------------------------------------------------------------

def range_sizes(fails: list[np.ndarray], good: np.ndarray, toxic: np.ndarray) -> list[tuple[int, ...]]:
    """letter, before, gone, removed, redundant, good_lost, toxic_lost for each filter and set of others."""
    every = range(1 << len(fails))
    unions = [union([x for i, x in enumerate(fails) if s >> i & 1]) for s in every]
    out = []
    for i, own in enumerate(fails):
        for s in every:
            if s >> i & 1:
                continue
            new = difference(own, unions[s])
            good_lost, toxic_lost = (len(new) - len(difference(new, x)) for x in (good, toxic))
            out.append((i, s, len(unions[s]), len(new), len(own) - len(new), good_lost, toxic_lost))
    return out


def set_sizes(postings: DataFrame) -> DataFrame:
    """For each part, filter and set of filters before it: the sizes summed over all ranges."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for r in batch.itertuples():
                lists = [np.asarray(x, np.int32) for x in r.fails]
                for one in range_sizes(lists, np.asarray(r.good, np.int32), np.asarray(r.toxic, np.int32)):
                    rows.append((r.part, *one[:2], r.n_docs, *one[2:]))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in SIZES.split(", ")])

    lists = postings.select("part", "n_docs", "fails", "good", "toxic")
    names = ("n_docs", "gone", "removed", "redundant", "good_lost", "toxic_lost")
    sizes = lists.mapInPandas(run, SIZES).groupBy("part", "letter", "before")
    return sizes.agg(*[F.sum(n).alias(n) for n in names])


def steps(n: int = len(FILTERS)) -> list[tuple[str, int, int, int]]:
    """filter_order, step, letter, before of every step of every order."""
    out = []
    for order in itertools.permutations(range(n)):
        name, before = "".join(FILTERS[i] for i in order), 0
        for step, letter in enumerate(order, 1):
            out.append((name, step, letter, before))
            before |= 1 << letter
    return out


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """One row for each part, order of the filters and step."""
    spark = prepare(docs.sparkSession)
    sizes = written(set_sizes(written(posting_lists(docs, labels, part), "postings")), "filter-sizes")
    # In how many orders exactly the filters of a set come before a filter.
    ways = F.element_at(
        F.array(*[F.lit(math.factorial(k) * math.factorial(len(FILTERS) - 1 - k)) for k in range(len(FILTERS))]),
        F.bit_count("before") + 1,
    )
    alone = F.when(F.bit_count("before") == len(FILTERS) - 1, F.col("removed"))
    # Five rows a part.
    own = sizes.groupBy("part", "letter").agg(
        F.max(alone).alias("unique_fails"), F.sum(F.col("removed") * ways).alias("shapley")
    )
    # 600 rows.
    order = spark.createDataFrame(steps(), "filter_order string, step int, letter int, before int")
    return (
        sizes.join(F.broadcast(order), ["letter", "before"])
        .join(own, ["part", "letter"])
        .select(
            "part", "filter_order", "step",
            (F.col("n_docs") - F.col("gone") - F.col("removed")).alias("kept"),
            "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley",
        )
    )
