"""Token id files with Elias-Fano document boundaries.

The ids of all documents in ascending ``doc_id`` order are one long array, cut
into blocks.  A block is one row of a Parquet table, so any store that Spark
writes to will do, a lost task is written again, and a reader takes the blocks
that it needs:

* ``part``, ``block``: place of the block; ``part`` follows the id ranges;
* ``doc_ids``: the ids of its documents;
* ``before``: token ids of the part before the block;
* ``n_docs``, ``n_ids``, ``low_bits``, ``low``, ``high``, ``samples``: the n + 1
  boundaries 0 .. n_ids as an Elias-Fano sequence: the lower ``low_bits`` bits of
  each boundary side by side, the upper ones in unary, and the place of every
  64th one bit, from which ``select`` starts;
* ``width``, ``ids``: the token ids, little-endian, 2 or 4 bytes each.

Defined results: a null text is an empty document; a null ``doc_id`` sorts first
and stays null; repeated rows are written once each, ties in order of the text;
an empty table gives no blocks and no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import new_path
from .support import clash_free, prepare, shuffle_partitions
from .tokens import default_path, encoder, ids_crc32

SAMPLE = 64
BLOCK = (
    "part int, block int, before long, n_docs int, n_ids long, low_bits int, width int, "
    "doc_ids array<bigint>, low binary, high binary, samples binary, ids binary"
)


def encode_boundaries(bounds: np.ndarray) -> tuple[int, bytes, bytes, bytes]:
    """Elias-Fano form of an ascending sequence from 0: low_bits, low, high, samples."""
    n, top = len(bounds), int(bounds[-1])
    low_bits = max(0, (top // n).bit_length() - 1) if n else 0
    lower = (bounds[:, None] >> np.arange(low_bits)) & 1
    ones = (bounds >> low_bits) + np.arange(n)
    unary = np.zeros(int(ones[-1]) + 1, np.uint8)
    unary[ones] = 1
    return (
        low_bits,
        np.packbits(lower.astype(np.uint8).ravel(), bitorder="little").tobytes(),
        np.packbits(unary, bitorder="little").tobytes(),
        ones[::SAMPLE].astype("<u4").tobytes(),
    )


class Boundaries:
    """Reads single boundaries of a block without a table of offsets."""

    def __init__(self, low_bits: int, low: bytes, high: bytes, samples: bytes):
        self.low_bits, self.low, self.high = low_bits, bytes(low), bytes(high)
        self.samples = np.frombuffer(samples, "<u4")

    def select(self, i: int) -> int:
        """The i-th boundary: the place of the i-th one bit, from the sample before it on."""
        place, skip = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte = place // 8
        rest = self.high[byte] >> (place % 8) << (place % 8)
        while (count := rest.bit_count()) <= skip:
            skip -= count
            byte += 1
            rest = self.high[byte]
        for _ in range(skip):
            rest &= rest - 1
        place = byte * 8 + (rest & -rest).bit_length() - 1
        bit = i * self.low_bits
        raw = int.from_bytes(self.low[bit // 8 : (bit + self.low_bits + 7) // 8], "little") >> bit % 8
        return (place - i) << self.low_bits | raw & ((1 << self.low_bits) - 1)

    def range(self, i: int) -> tuple[int, int]:
        """Where the ids of the i-th document of the block begin and end."""
        return self.select(i), self.select(i + 1)


def write_token_files(
    docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = 0, block_ids: int = 1 << 20
) -> None:
    """Write the ids of all documents to ``path``, in ascending order of ``doc_id``."""
    spark = prepare(docs.sparkSession)
    file = vocabulary or default_path("byte_bpe_50k.json")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_of = encoder(file, "byte")
        part = TaskContext.get().partitionId()
        doc_ids: list = []
        held: list[np.ndarray] = []
        size = before = block = 0

        def row() -> pd.DataFrame:
            bounds = np.cumsum([0, *map(len, held)])
            low_bits, low, high, samples = encode_boundaries(bounds)
            ids = np.concatenate(held)
            return pd.DataFrame([{
                "part": part, "block": block, "before": before, "n_docs": len(held), "n_ids": size,
                "low_bits": low_bits, "width": ids.dtype.itemsize, "doc_ids": doc_ids, "low": low, "high": high,
                "samples": samples, "ids": ids.tobytes(),
            }])

        for batch in batches:
            for doc_id, ids in zip(batch["doc_id"].tolist(), ids_of.encode(batch["text"].tolist(), end_id)):
                doc_ids.append(None if pd.isna(doc_id) else int(doc_id))
                held.append(ids)
                size += len(ids)
                if size >= block_ids:
                    yield row()
                    before, block = before + size, block + 1
                    doc_ids, held, size = [], [], 0
        if held:
            yield row()

    # Ranges of ids; the text's hash spreads the rows of an id that many rows share.
    ranges = shuffle_partitions(spark)
    ordered = (
        clash_free(docs, ["doc_id", "text"])
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(ranges, "doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie", "text")
        .drop("tie")
    )
    ordered.mapInPandas(run, BLOCK).write.parquet(path)


def part_starts(blocks: DataFrame) -> DataFrame:
    """Token ids before each part; one row for each written part, not for each document."""
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).alias("part_start"))


def read_token_files(
    spark: SparkSession, path: str, with_ids: bool = False, doc_ids: list[int] | None = None
) -> DataFrame:
    """Per document: doc_id, start, n_tokens, ids_crc32 and, if asked for, the token ids.

    Boundaries come one by one from ``select`` on the blocks; no table of offsets is made.
    With ``doc_ids`` only blocks that hold one of them are opened, and only their ids are cut out.
    """
    prepare(spark)
    blocks = spark.read.schema(BLOCK).parquet(path)
    # One number for each part: as many as the writer had tasks.
    placed = blocks.join(F.broadcast(part_starts(blocks)), "part")
    wanted = None
    if doc_ids is not None:
        wanted = set(doc_ids)
        placed = placed.where(F.arrays_overlap("doc_ids", F.array(*[F.lit(i).cast("long") for i in sorted(wanted)])))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<bigint>" * with_ids

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for b in batch.itertuples():
                bounds = Boundaries(b.low_bits, b.low, b.high, b.samples)
                ids = np.frombuffer(b.ids, f"<u{b.width}")
                rows = []
                for i, doc_id in enumerate(b.doc_ids):
                    doc_id = None if pd.isna(doc_id) else int(doc_id)
                    if wanted is not None and doc_id not in wanted:
                        continue
                    start, end = bounds.range(i)
                    own = ids[start:end]
                    row = (doc_id, b.part_start + b.before + start, end - start, ids_crc32(own))
                    rows.append((*row, own.astype(np.int64)) if with_ids else row)
                out = pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids])
                yield out.astype({"doc_id": "Int64"})

    return placed.mapInPandas(run, schema)


def token_boundaries(docs: DataFrame, vocabulary: str | None = None, end_id: int = 0) -> DataFrame:
    """Write the documents to files in the shared folder and read their boundaries and checksums back."""
    spark = docs.sparkSession
    path = new_path(spark, "token-files")
    write_token_files(docs, path, vocabulary, end_id)
    return read_token_files(spark, path)
