"""Fill-in-middle rearrangement of documents by piece tables.

A document's text is an immutable buffer of UTF-8 bytes; the sentinels are another.
The document itself is a list of descriptors (buffer, start, length).  Cutting splits
descriptors, an arrangement puts them in another order with sentinel descriptors
between them, and the inverse permutation puts the pieces of an output back.  No text
is copied until an output is asked for; hashes run over the descriptors one by one.

Cuts fall between units, by default lines (``[^\\n]*\\n|[^\\n]+``).  The numbers h1 to
h4 are the first four 8-digit groups of the sha256 of ``<seed>:<doc_id>``: the prefix
ends after the smaller of h1 and h2 modulo units + 1, the middle after the larger; h3
decides whether a document is rearranged at all and h4 in which of the two orders:

* ``psm``: ``<P>`` prefix ``<S>`` suffix ``<M>`` middle;
* ``spm``: ``<S>`` suffix ``<P>`` prefix ``<M>`` middle;
* ``plain``: the text as it is; so are empty texts and those that hold a sentinel.

Defined results: a null text is an empty one (no units, plain); a null ``doc_id`` is
hashed as an empty number and stays null; repeated rows are rearranged once each, all
alike; an empty table gives no rows; other columns are ignored, whatever their names;
a text is one descriptor however long it is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .support import clash_free, prepare

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = PREFIX + SUFFIX + MIDDLE
#: Parts of each order; the sentinel stands before its part.
ORDERS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
TEXT_ORDER = (PREFIX, MIDDLE, SUFFIX)

REARRANGED = (
    "doc_id long, n long, form string, prefix_chars long, middle_chars long, "
    "pieces array<struct<buffer:int,start:long,length:long>>, output binary, output_sha256 string"
)
RESTORED = "doc_id long, form string, text binary, restored_sha256 string"


@dataclass(frozen=True)
class Settings:
    seed: int = 7
    rearranged_percent: int = 100
    spm_percent: int = 50


class Pieces:
    """Descriptors (buffer, start, length) over immutable buffers."""

    def __init__(self, buffers: tuple[bytes, ...], table: list[tuple[int, int, int]]):
        self.buffers, self.table = buffers, table

    @classmethod
    def of(cls, text: bytes) -> "Pieces":
        """Buffer 0 holds the sentinels, buffer 1 the text."""
        return cls((SENTINELS, text), [(1, 0, len(text))])

    def cut(self, places: Iterable[int]) -> "Pieces":
        """Split so that a piece begins at each of the ascending places (offsets in the whole)."""
        out, at, left = [], 0, list(places)
        for buffer, start, length in self.table:
            end = at + length
            while left and left[0] <= end:
                place = left.pop(0)
                out.append((buffer, start, place - at))
                start, at = start + place - at, place
            out.append((buffer, start, end - at))
            at = end
        return Pieces(self.buffers, out)

    def permuted(self, order: Iterable[int]) -> "Pieces":
        return Pieces(self.buffers, [self.table[i] for i in order])

    def chunks(self) -> Iterator[memoryview]:
        views = [memoryview(b) for b in self.buffers]
        for buffer, start, length in self.table:
            yield views[buffer][start : start + length]

    def sha256(self) -> str:
        """Hash of the whole, streamed piece by piece."""
        digest = hashlib.sha256()
        for chunk in self.chunks():
            digest.update(chunk)
        return digest.hexdigest()

    def whole(self) -> bytes:
        return b"".join(self.chunks())


def arranged(parts: Pieces, form: str) -> Pieces:
    """Prefix, middle and suffix in the order of the form, each after its sentinel."""
    out = []
    for sentinel in ORDERS[form]:
        out.append((0, SENTINELS.index(sentinel), len(sentinel)))
        out.append(parts.table[TEXT_ORDER.index(sentinel)])
    return Pieces(parts.buffers, out)


def restored(output: bytes, form: str) -> Pieces:
    """The text's pieces, found in an output of the form: cut at the sentinels and put back in order.

    A text that holds a sentinel is never rearranged, and none can arise across a border of
    two parts, so the first place where a sentinel stands is its own.
    """
    whole = Pieces.of(output)
    if form == "plain":
        return whole
    order = ORDERS[form]
    starts, at = [], 0
    for sentinel in order:
        at = output.index(sentinel, at)
        starts.append(at)
        at += len(sentinel)
    places = [p for start, sentinel in zip(starts, order) for p in (start, start + len(sentinel))]
    cut = whole.cut(places)  # the piece before the first sentinel is empty, then sentinel and part in turn
    return cut.permuted(2 + 2 * order.index(part) for part in TEXT_ORDER)


def n_units(text: bytes) -> int:
    """Lines, the last without a line end included."""
    return text.count(b"\n") + (text[-1:] not in (b"", b"\n"))


def unit_end(text: bytes, units: int) -> int:
    """Offset after so many lines."""
    if units == 0:
        return 0
    parts = text.split(b"\n", units)
    return len(text) - len(parts[units]) if len(parts) > units else len(text)


def code_points(text: bytes | memoryview) -> int:
    """Bytes that do not continue a character."""
    return int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))


def draws(doc_id: int | None, seed: int) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def infill(doc_id: int | None, text: bytes, settings: Settings) -> tuple[int, str, Pieces, Pieces | None]:
    """Units, form, the arranged pieces, and the three parts they came from (none if plain)."""
    h1, h2, h3, h4 = draws(doc_id, settings.seed)
    n, whole = n_units(text), Pieces.of(text)
    if not text or any(s in text for s in ORDERS["psm"]) or h3 % 100 >= settings.rearranged_percent:
        return n, "plain", whole, None
    form = "spm" if h4 % 100 < settings.spm_percent else "psm"
    ends = sorted((h1 % (n + 1), h2 % (n + 1)))
    parts = whole.cut(unit_end(text, end) for end in ends)
    return n, form, arranged(parts, form), parts


def rearrange(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row for each document: its form, its descriptors, the output (UTF-8) and the output's hash."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].tolist(), batch["text"].tolist()):
                doc_id = None if pd.isna(doc_id) else int(doc_id)
                n, form, pieces, parts = infill(doc_id, bytes(text), settings)
                prefix, middle = (code_points(c) for c in list(parts.chunks())[:2]) if parts else (None, None)
                table = [dict(zip(("buffer", "start", "length"), d)) for d in pieces.table]
                rows.append((doc_id, n, form, prefix, middle, table, pieces.whole(), pieces.sha256()))
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in REARRANGED.split(", ")])
            yield out.astype({c: "Int64" for c in ("doc_id", "n", "prefix_chars", "middle_chars")})

    prepare(docs.sparkSession)
    rows = clash_free(docs, ["doc_id", "text"])
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")
    # The id crosses as text: a column of numbers with nulls would lose digits.
    return rows.select(F.col("doc_id").cast("string").alias("doc_id"), text).mapInPandas(run, REARRANGED)


def restore(outputs: DataFrame) -> DataFrame:
    """doc_id, form, the text rebuilt from ``output`` and ``form`` (UTF-8), and its hash."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, form, output in zip(batch["doc_id"].tolist(), batch["form"], batch["output"]):
                pieces = restored(bytes(output), form)
                rows.append((None if pd.isna(doc_id) else int(doc_id), form, pieces.whole(), pieces.sha256()))
            yield pd.DataFrame(rows, columns=["doc_id", "form", "text", "restored_sha256"]).astype({"doc_id": "Int64"})

    rows = clash_free(outputs, ["doc_id", "form", "output"])
    return rows.select(F.col("doc_id").cast("string").alias("doc_id"), "form", "output").mapInPandas(run, RESTORED)


DIGESTS = (
    "doc_id long, n long, form string, prefix_chars long, middle_chars long, "
    "output_sha256 string, restored_sha256 string"
)


def round_trip(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Digests of ``rearrange`` and of what ``restored`` makes of each output, in one pass."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            back = [restored(bytes(o), form).sha256() for o, form in zip(batch["output"], batch["form"])]
            kept = batch[["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256"]]
            kept = kept.assign(restored_sha256=back)
            yield kept.astype({c: "Int64" for c in ("doc_id", "n", "prefix_chars", "middle_chars")})

    made = rearrange(docs, settings)
    columns = [F.col("doc_id").cast("string").alias("doc_id"), "n", "form"]
    columns += [F.col(c).cast("string").alias(c) for c in ("prefix_chars", "middle_chars")]
    return made.select(*columns, "output_sha256", "output").mapInPandas(run, DIGESTS)
