"""Token ids of whole texts by the tokenizers library, each distinct piece of text encoded once.

Both vocabularies cut a text into pieces before any merge is applied.  So the ids of a
text are the ids of its pieces one after another, and a worker encodes each distinct
piece once.  Texts are cut, many at a time, where a piece is sure to begin; a place that is
not sure is no cut, and the library finds the rest:

* ``word``: at both ends of ASCII white space, which has no ids;
* ``byte``: before a single space between two other characters, which belongs to the
  piece that it starts, and on both sides of such a line feed;
* both: between a letter and ASCII punctuation after it.

Runs of letters are encoded many to a call; where one ends is told by the bytes that each
id stands for.
"""

from __future__ import annotations

import os
import string
import unicodedata
import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa

from .support import byte_chunks, utf8

#: Pieces of one generation of a worker's cache; there are two.
CACHE_PIECES = 250_000
RUNS = 500

LETTER, MARK, GAP, HIGH = 1, 2, 4, 8
#: Class of each byte: ASCII letters, ASCII punctuation, white space and separators, bytes of longer characters.
CLASSES = np.zeros(256, np.uint8)
CLASSES[list(string.ascii_letters.encode())] = LETTER
CLASSES[list(string.punctuation.encode())] = MARK
CLASSES[[*range(9, 14), *range(28, 33)]] = GAP
CLASSES[128:] = HIGH
SPACES = np.zeros(256, bool)
SPACES[[*range(9, 14), 32]] = True

_encoders: dict[tuple[str, str], "Encoder"] = {}


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str, kind: str) -> "Encoder":
    """The worker's encoder for a vocabulary file; its cache outlives the task."""
    if (path, kind) not in _encoders:
        _encoders[path, kind] = Encoder(path, kind)
    return _encoders[path, kind]


class Encoder:
    def __init__(self, path: str, kind: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task a core
        from tokenizers import Tokenizer

        if kind not in ("word", "byte"):
            raise ValueError(f"unknown kind of vocabulary: {kind}")
        self.tokenizer = Tokenizer.from_file(path)
        self.kind = kind
        width = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2") if width <= 1 << 16 else np.dtype("<u4")
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Bytes that each id stands for: a character of its string is a byte.
        self.bytes = np.zeros(width, np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.bytes[i] = len(token.removesuffix("</w>") if kind == "word" else token)
        self.cache = Generations()

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.dtype) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_runs(self, runs: list[str], gap: str, leads: bool) -> list[bytes]:
        """Ids of runs of letters with a gap between them; with ``leads`` the gap belongs to the run that follows."""
        word = self.kind == "word"
        normal = (unicodedata.normalize("NFC", r).lower() if word else r for r in runs)
        sizes = np.fromiter((len(r.encode("utf-8", "surrogatepass")) for r in normal), np.int64, len(runs))
        ids = self._ids([gap + gap.join(runs) if leads else gap.join(runs)])[0]
        at = np.concatenate([[0], np.cumsum(self.bytes[ids])])
        # Bytes before each run and after it; in ``byte`` the gap has an id of its own, or is a run's first byte.
        step = sizes + (0 if word else 1)
        ends = np.cumsum(step) - (0 if word or leads else 1)
        starts = ends - sizes - (1 if leads else 0)
        a, b = np.searchsorted(at, starts), np.searchsorted(at, ends)
        whole = (a < len(at)) & (b < len(at))
        whole[whole] = (at[a[whole]] == starts[whole]) & (at[b[whole]] == ends[whole])
        if not whole.all() or at[-1] != ends[-1]:  # letters that the normalizer turns into something else
            return [x.tobytes() for x in self._ids([" " + r if leads else r for r in runs])]
        return [ids[x:y].tobytes() for x, y in zip(a.tolist(), b.tolist())]

    def _learn(self, pieces: Iterable[bytes]) -> None:
        young, word = self.cache.young, self.kind == "word"
        spaced, plain, others = [], [], []
        for piece in pieces:
            text = piece.decode("utf-8", "surrogatepass")
            if text.isalpha():
                plain.append((piece, text))
            elif not word and text[0] == " " and text[1:].isalpha():
                spaced.append((piece, text[1:]))
            else:
                others.append((piece, text))
        for runs, gap in ((spaced, " "), (plain, " " if word else "\n")):
            for i in range(0, len(runs), RUNS):
                keys, texts = zip(*runs[i : i + RUNS])
                young.update(zip(keys, self._encode_runs(list(texts), gap, bool(runs is spaced))))
        for (piece, _), ids in zip(others, self._ids([t for _, t in others])):
            young[piece] = ids.tobytes()

    def _encode_run(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of texts that are not empty, all in one pass over their bytes."""
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        data = np.frombuffer(b"".join(texts), np.uint8)
        begins = (word_cuts if self.kind == "word" else byte_cuts)(data)
        begins[0] = True
        begins[ends[:-1]] = True
        offsets = np.append(np.flatnonzero(begins), len(data))
        buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)]
        coded = pa.BinaryArray.from_buffers(pa.binary(), len(offsets) - 1, buffers).dictionary_encode()
        distinct, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        self._learn(self.cache.missing(distinct))
        known = list(map(self.cache.young.__getitem__, distinct))
        flat = np.frombuffer(b"".join(known), self.dtype)
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // self.dtype.itemsize
        starts = np.cumsum(sizes) - sizes
        own = sizes[codes]
        upto = np.cumsum(own)
        ids = flat[np.repeat(starts[codes] - (upto - own), own) + np.arange(upto[-1])]
        # The pieces that end where a text ends.
        return np.split(ids, upto[np.searchsorted(offsets, ends[:-1]) - 1])

    def encode(self, texts: list[str | None], end_id: int) -> list[np.ndarray]:
        """Ids of each text (null: none) and the end id."""
        end = np.array([end_id], self.dtype)
        raw = [utf8(t) for t in texts]
        # Texts in which a special token's string occurs are encoded whole.
        whole = [any(s in b for s in self.special) for b in raw]
        done: list[np.ndarray] = []
        for run in byte_chunks([b for b, special in zip(raw, whole) if b and not special]):
            self.cache.turn()
            done += self._encode_run(run)
        found = iter(done)
        out = []
        for text, b, special in zip(texts, raw, whole):
            ids = self._ids([text])[0] if special else next(found) if b else end[:0]
            out.append(np.append(ids, end))
        return out


def word_cuts(data: np.ndarray) -> np.ndarray:
    """Where runs of ASCII white space, the runs between them, and punctuation after letters begin."""
    space = SPACES[data]
    out = tail_cuts(data)
    out[1:] |= space[1:] != space[:-1]
    return out


def tail_cuts(data: np.ndarray) -> np.ndarray:
    """ASCII punctuation after an ASCII letter or one of U+00C0 to U+00FF."""
    kind = CLASSES[data]
    out = np.zeros(len(data), bool)
    out[1:] = (kind[1:] == MARK) & (kind[:-1] == LETTER)
    at = np.flatnonzero((kind[2:] == MARK) & (data[:-2] == 0xC3)) + 2
    out[at[~np.isin(data[at - 1], (0x97, 0xB7))]] = True  # the signs of multiplication and division are no letters
    return out


def byte_cuts(data: np.ndarray) -> np.ndarray:
    """Where a piece of the byte vocabulary is sure to begin."""
    out = tail_cuts(data)
    at = np.flatnonzero((data == 32) | (data == 10))
    at = at[(at > 0) & (at < len(data) - 1)]
    before, after = data[at - 1], data[at + 1]
    sure = (CLASSES[before] != GAP) & (CLASSES[after] != GAP)
    high = before >= 128
    one, two, three = (data[np.maximum(at[high] - i, 0)] for i in (1, 2, 3))
    sure[high] &= np.where(two >= 0xC0, solid(two, one, one), solid(three, two, one))
    high = after >= 128
    sure[high] &= solid(*(data[np.minimum(at[high] + i, len(data) - 1)] for i in (1, 2, 3)))
    at = at[sure]
    out[at] = True
    out[at[data[at] == 10] + 1] = True
    return out


def solid(lead: np.ndarray, second: np.ndarray, third: np.ndarray) -> np.ndarray:
    """Characters that are sure not to be white space: U+00A1 to U+07FF and U+2010 to U+2027."""
    return (
        (lead >= 0xC3) & (lead <= 0xDF)
        | (lead == 0xC2) & (second >= 0xA1)
        | (lead == 0xE2) & (second == 0x80) & (third >= 0x90) & (third <= 0xA7)
    )


class Generations:
    """A bounded cache: when the young generation is full, the old one goes, unless its entries are asked for again."""

    def __init__(self):
        self.young: dict = {}
        self.old: dict = {}

    def turn(self) -> None:
        if len(self.young) > CACHE_PIECES:
            self.young, self.old = {}, self.young

    def missing(self, keys: Iterable) -> set:
        """Which of the keys are in neither generation; those of the old one become young again."""
        out = set(keys).difference(self.young)
        if self.old:
            again = out.intersection(self.old)
            self.young.update(zip(again, map(self.old.__getitem__, again)))
            out -= again
        return out


def ids_crc32(ids: np.ndarray) -> int:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())
