"""Small tables and plain helpers for the operator tests."""

from __future__ import annotations

import random
import re

from pyspark.sql import types as T

GAP = re.compile(r"[^\x20\x09-\x0D]+")
#: Columns that operators use inside; inputs may have them too.
CLASHING = ("k", "row", "size", "grp", "node", "bin", "h", "place", "piece", "shard", "component", "taken", "score", "text_")

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *[T.StructField(c, T.StringType()) for c in CLASHING],
    ]
)


def documents(spark, rows):
    """Documents from (doc_id, text, lang, source), with extra columns of clashing names."""
    full = [(i, t, lang, s, None if t is None else len(t), *["x"] * len(CLASHING)) for i, t, lang, s in rows]
    return spark.createDataFrame(full, DOCUMENTS)


def words(text):
    return GAP.findall(text or "")


def prose(rng: random.Random, n: int, vocabulary: int = 4000) -> str:
    return " ".join("w" + str(rng.randrange(vocabulary)) for _ in range(n))


def awkward_rows():
    """Nulls in every column, empty, blank and very long texts, repeated rows and ids."""
    rng = random.Random(5)
    long_text = prose(rng, 30_000)
    normal = prose(rng, 120)
    return [
        (1, normal, "en", "a"),
        (1, normal, "en", "a"),
        (2, None, "en", "a"),
        (3, "", None, None),
        (4, " \t\n ", "de", "b"),
        (None, normal, "en", "b"),
        (None, None, None, None),
        (5, long_text, "en", "c"),
        (6, long_text + " tail", "en", "c"),
        (7, "  café \U0001f600 \u0000 x", "fr", "d"),
        (8, "one", "en", "a"),
        (9, "1234 5678", "en", "a"),
    ]
