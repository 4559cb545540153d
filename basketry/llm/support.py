"""Helpers shared by the operators: shipping code, the shared folder, words and their hashes.

A word is a maximal run of characters other than space and U+0009..U+000D.  On
UTF-8 bytes that is exactly what ``bytes.split()`` yields.
"""

from __future__ import annotations

import io
import os
import zipfile
from collections.abc import Iterable, Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, new_path, tune

#: Rows of one Arrow batch: a batch of average documents is a few MB.
ARROW_ROWS = 1000
#: Entries after which a worker's cache of words is emptied.
CACHE_WORDS = 200_000

GOLDEN = np.uint64(0x9E3779B97F4A7C15)

_shipped: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the operators; also gives the executors this package."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        _shipped.add(context.applicationId)
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w") as out:
            for folder, _, names in os.walk(package):
                for name in sorted(names):
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        out.write(path, os.path.relpath(path, os.path.dirname(package)))
        archive = new_path(spark, "code") + ".zip"
        place = context._jvm.org.apache.hadoop.fs.Path(archive)
        stream = place.getFileSystem(context._jsc.hadoopConfiguration()).create(place)
        stream.write(bytearray(packed.getvalue()))
        stream.close()
        context.addPyFile(archive)  # from the shared folder to every executor
    return spark


def written(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared folder and read back, so that lost executors cost nothing."""
    return materialize(df, name)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def clash_free(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """Only the wanted columns, by exact name; columns that the operators add cannot clash with others."""
    return df.select(*[F.col(f"`{name}`") for name in wanted])


def is_held_out(doc_id: str = "doc_id") -> Column:
    """Documents whose crc32 of the id as text has remainder 1 by three."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


class WordHashes(dict):
    """64-bit hash of each word, remembered while there is room."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over all output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashed(seed: int, *columns: str) -> Column:
    """Seeded hash of some columns, the same on every run."""
    return F.xxhash64(F.lit(seed), *[F.col(c) for c in columns])


def byte_chunks(texts: Iterable[bytes], limit: int = 8_000_000) -> Iterator[list[bytes]]:
    """Runs of texts of about ``limit`` bytes; a longer text is a run of its own."""
    run: list[bytes] = []
    held = 0
    for text in texts:
        if run and held + len(text) > limit:
            yield run
            run, held = [], 0
        run.append(text)
        held += len(text)
    if run:
        yield run
