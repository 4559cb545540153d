"""Removal of repeated passages with one compressed FM-index per shard.

A window is ``window`` consecutive words of one document.  Windows whose word
sequence starts anywhere else are found as follows; no pair of documents is
ever formed and nothing is sampled:

1. Every window owns an anchor: its smallest ``gram``-word hash.  Equal windows
   own equal anchors.  Runs of windows with one anchor are a *context*: their
   words, at most 2 * window - gram of them.  Each window start lies in one context.
2. Anchors that occur once cannot hold a repeated window.  Of the others, equal
   contexts become one, with a weight.
3. Contexts are dealt to shards by anchor, so that equal windows meet.  A shard
   builds an FM-index of its contexts and streams the contexts against it:
   backward search gives matching statistics, and runs of starts whose windows
   have weight two or more are reported.
4. Anchors with more than ``hot`` different contexts are dealt window by window,
   by the hash of the whole window, equal windows summed before the shuffle.
5. The runs go back to the documents, whose covered words are removed.

Documents are told apart by a 64-bit hash of id and text.

Defined results: null and blank texts have no words and keep none; documents
shorter than a window keep all; every occurrence of a repeated window is
removed, in repeated rows too; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .fm_index import FMIndex, repeated_starts
from .support import GOLDEN, WordHashes, byte_chunks, clash_free, mix, prepare, utf8, written

#: Low bits of a window's smallest hash that hold its place.
PLACE_BITS = 28


@dataclass(frozen=True)
class Settings:
    window: int = 35
    gram: int = 6
    #: Different contexts that one anchor may bring to a shard as a whole.
    hot: int = 400
    #: Words of one FM-index, about.
    shard_words: int = 250_000


def contexts_of(words: list[list[bytes]], settings: Settings, hashes: WordHashes):
    """Contexts of some documents: document, first window, number of windows, anchor, hash of the words."""
    size, gram = settings.window, settings.gram
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    h = hashes.array([w for one in words for w in one])
    n = len(h)
    empty = np.zeros(0, np.int64)
    if n < size:
        return empty, empty, empty, empty, empty
    ends = np.cumsum(lengths)
    starts = ends - lengths
    with np.errstate(over="ignore"):
        g = np.zeros(n - gram + 1, np.uint64)
        for i in range(gram):
            g = g * GOLDEN + h[i : n - gram + 1 + i]
        g = mix(g)
        low = np.uint64((1 << PLACE_BITS) - 1)
        packed = (g & ~low) | np.arange(len(g), dtype=np.uint64)
        # Smallest of the grams of each window, by doubling; the leftmost of equal ones.
        count, width = size - gram + 1, 1
        least = packed
        while 2 * width <= count:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < count:
            least = np.minimum(least[: n - size + 1], least[count - width : count - width + n - size + 1])
    owner = np.repeat(np.arange(len(words)), lengths)[: n - size + 1]
    whole = np.arange(n - size + 1) + size <= ends[owner]  # windows inside one document
    at = np.flatnonzero(whole)
    if not len(at):
        return empty, empty, empty, empty, empty
    place = (least[at] & low).astype(np.int64)
    cut = np.flatnonzero((place[1:] != place[:-1]) | (owner[at][1:] != owner[at][:-1])) + 1
    first = at[np.concatenate([[0], cut])]
    last = at[np.concatenate([cut - 1, [len(at) - 1]])]
    anchor = g[place[np.concatenate([[0], cut])]]
    with np.errstate(over="ignore"):
        # Polynomial hash of the context's words, independent of where they stand.
        odd = np.full(n, GOLDEN, np.uint64)
        back = np.full(n, pow(int(GOLDEN), -1, 1 << 64), np.uint64)
        odd[0] = back[0] = 1
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * np.cumprod(odd), dtype=np.uint64)])
        text = mix((total[last + size] - total[first]) * np.cumprod(back)[first] + (last - first).astype(np.uint64))
    return owner[first], first - starts[owner[first]], last - first + 1, anchor.view(np.int64), text.view(np.int64)


def find_contexts(keyed: DataFrame, settings: Settings) -> DataFrame:
    """k, lo, n, anchor, ctx: the contexts of every document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            keys = batch["k"].to_numpy()
            done = 0
            for texts in byte_chunks(map(utf8, batch["text"])):
                part = keys[done : done + len(texts)]
                done += len(texts)
                doc, lo, n, anchor, ctx = contexts_of([t.split() for t in texts], settings, hashes)
                if len(doc):
                    yield pd.DataFrame({"k": part[doc], "lo": lo, "n": n, "anchor": anchor, "ctx": ctx})

    return keyed.select("k", "text").mapInPandas(run, "k long, lo int, n int, anchor long, ctx long")


def context_words(docs: DataFrame, settings: Settings) -> DataFrame:
    """The words of the contexts that are asked for (``asked``: lo, n, anchor, ctx, weight, hot) of each document.

    Contexts of hot anchors are given window by window, ``at`` being the
    window's place in the context; for others it is -1.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["anchor", "ctx", "weight", "n", "at", "words"]
        for batch in batches:
            rows = []
            for text, asked in zip(batch["text"], batch["asked"]):
                words = utf8(text).split()
                for x in asked:
                    lo, n = x["lo"], x["n"]
                    head = (x["anchor"], x["ctx"], x["weight"])
                    if x["hot"]:
                        for i in range(n):
                            rows.append((*head, 1, i, b" ".join(words[lo + i : lo + i + settings.window])))
                    else:
                        rows.append((*head, n, -1, b" ".join(words[lo : lo + n + settings.window - 1])))
                if len(rows) > 20_000:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=names)

    return docs.mapInPandas(run, "anchor long, ctx long, weight long, n int, at int, words binary")


def search_shards(rows: DataFrame, settings: Settings) -> DataFrame:
    """anchor, ctx, first, last: runs of repeated windows in contexts (anchor, ctx, weight, n, words)."""

    def search(part: pd.DataFrame) -> pd.DataFrame:
        numbers: dict[bytes, int] = {}
        sequences = [
            np.array([numbers.setdefault(w, len(numbers) + 1) for w in words.split(b" ")], np.int64)
            for words in part["words"]
        ]
        index = FMIndex(sequences, part["weight"].to_numpy(), 2 * settings.window)
        first = index.starts[:-1]
        runs = repeated_starts(index, index.text, first, first + part["n"].to_numpy() - 1, settings.window, 2)
        q, x, y = (np.concatenate([r[i] for r in runs]) for i in range(3))
        return pd.DataFrame({
            "anchor": part["anchor"].to_numpy()[q], "ctx": part["ctx"].to_numpy()[q],
            "first": x - first[q], "last": y - first[q],
        })

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += int(batch["words"].map(len).sum()) // 6
            if size < settings.shard_words:
                continue
            rows = pd.concat(held, ignore_index=True).drop_duplicates(["anchor", "ctx"])
            own = rows["anchor"] == rows["anchor"].iloc[-1]  # may go on in the next batch
            if not own.all():
                yield search(rows[~own].reset_index(drop=True))
            held = [rows[own]]
            size = int(held[0]["words"].map(len).sum()) // 6
        if held:
            yield search(pd.concat(held, ignore_index=True).drop_duplicates(["anchor", "ctx"]).reset_index(drop=True))

    dealt = rows.select("anchor", "ctx", "weight", "n", "words").repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInPandas(run, "anchor long, ctx long, first int, last int")


def repeated_runs(keyed: DataFrame, settings: Settings) -> DataFrame:
    """k, runs (array of first and last window start): the repeated windows of documents that have some."""
    found = written(find_contexts(keyed, settings), "contexts")
    # Written, so that the join deals both sides anew and splits the rows of a common anchor.
    twice = written(found.groupBy("anchor").count().where("count > 1").select("anchor"), "repeated-anchors")
    found = written(found.join(twice, "anchor", "left_semi"), "shared-contexts")
    different = found.groupBy("anchor", "ctx").agg(
        F.count("*").alias("weight"), F.min(F.struct("k", "lo", "n")).alias("place")
    )
    different = written(different, "different-contexts")
    crowded = different.groupBy("anchor").count().where(F.col("count") > settings.hot).select("anchor")
    crowded = written(crowded.withColumn("hot", F.lit(True)), "hot-anchors")
    flagged = different.join(crowded, "anchor", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    flagged = written(flagged, "asked")

    def words_of(asked: DataFrame) -> DataFrame:
        by_document = asked.groupBy(F.col("place.k").alias("k")).agg(
            F.collect_list(F.struct("place.lo", "place.n", "anchor", "ctx", "weight", "hot")).alias("asked")
        )
        # All columns of the documents are passed on, so that each use reads one and the same exchange.
        return context_words(keyed.join(by_document, "k"), settings)

    plain = words_of(flagged.where("not hot"))
    windows = words_of(flagged.where("hot")).withColumn("whole", F.xxhash64("words"))
    summed = windows.groupBy("whole").agg(F.sum("weight").alias("weight"), F.min("words").alias("words"))
    whole = summed.select(
        F.col("whole").alias("anchor"), F.col("whole").alias("ctx"), "weight", F.lit(1).alias("n"), "words"
    )
    hits = search_shards(whole, settings).select(F.col("anchor").alias("whole"))
    single = windows.join(hits, "whole", "left_semi")
    runs = search_shards(plain, settings).unionByName(
        single.select("anchor", "ctx", F.col("at").alias("first"), F.col("at").alias("last"))
    )
    placed = found.join(runs, ["anchor", "ctx"]).select(
        "k", F.struct((F.col("lo") + F.col("first")).alias("first"), (F.col("lo") + F.col("last")).alias("last")).alias("r")
    )
    return placed.groupBy("k").agg(F.collect_set("r").alias("runs"))


def remove_repeated(docs: DataFrame, settings: Settings = Settings(), with_text: bool = False) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256 and, if asked for, kept_text (kept words, one space)."""
    prepare(docs.sparkSession)
    keyed = clash_free(docs, ["doc_id", "text"]).withColumn("k", F.xxhash64("doc_id", "text"))
    runs = repeated_runs(keyed, settings)
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text, found in zip(batch["doc_id"].tolist(), batch["text"], batch["runs"]):
                words = utf8(text).split()
                kept = words
                if found is not None and len(found):
                    change = np.zeros(len(words) + 1, np.int64)
                    for r in found:
                        change[r["first"]] += 1
                        change[r["last"] + settings.window] -= 1
                    covered = np.cumsum(change[:-1]) > 0
                    kept = [w for w, c in zip(words, covered.tolist()) if not c]
                joined = b" ".join(kept)
                row = (doc_id, len(words), len(words) - len(kept), hashlib.sha256(joined).hexdigest())
                rows.append((*row, joined.decode("utf-8", "surrogatepass")) if with_text else row)
            out = pd.DataFrame(rows, columns=[x.split()[0] for x in schema.split(", ")])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return keyed.join(runs, "k", "left").mapInPandas(run, schema)
