"""Language spans of mixed-language text: script ranges, then Viterbi over word scores.

* Training counts byte bigrams to 4-grams of words (space around each word),
  folded into hash slots, for each language, on a bounded sample of the labelled
  rows, and the scripts of each language's letters.  Repeated texts count once.
* A word's score for a language is the sum of the log-probabilities of its
  grams.  The scripts of its letters narrow the candidates: languages that never
  use a script in training are out for words in it.
* Viterbi over the words of a text, with a penalty for each change of language,
  gives the spans.  The document's language is the one with most letters;
  ``score`` is that share times the mean confidence of its words.

Texts of any length are cut into runs of whole words for scoring, with the
Viterbi state carried on; all texts of a batch advance together, word by word.

Defined results: null texts and texts without a letter are ``und`` with score 0
and no spans; without labelled rows every text is ``und``; repeated rows are
labelled alike; ties go to the first language in code point order; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .support import clash_free, hashed, prepare, utf8, written

UND = "und"
SLOTS = 1 << 16
GRAMS = (2, 3, 4)

# Script ranges (first and last code point), fixed values of the Unicode blocks.
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x1E00, 0x1EFF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F)],
    "armenian": [(0x531, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FA1F)],
}
OTHER = len(SCRIPTS)


@dataclass(frozen=True)
class Settings:
    rows_per_language: int = 2000  # of the labelled sample, expected number
    switch_penalty: float = 12.0
    seed: int = 7


@dataclass
class Model:
    languages: list[str]
    grams: np.ndarray  # SLOTS x languages, log-probability above the mean of the languages
    scripts: np.ndarray  # scripts x languages, whether the language uses the script


def script_table() -> np.ndarray:
    """Script number of every code point of the basic plane (others: by range)."""
    table = np.full(0x30000, OTHER, np.uint8)
    for number, ranges in enumerate(SCRIPTS.values()):
        for a, b in ranges:
            table[a : b + 1] = number
    return table


_scripts = script_table()
_letters = re.compile(r"[^\W\d_]")


def letters_by_script(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Per word: number of letters, and a bit set of the scripts of its letters."""
    counts, bits = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    for i, word in enumerate(words):
        if word.isascii():
            if word.isalpha():
                counts[i], bits[i] = len(word), 1
                continue
            letters = [c for c in word if c.isalpha()]
        else:
            letters = [c for c in word if c.isalpha()]
        counts[i] = len(letters)
        for c in letters:
            bits[i] |= 1 << int(_scripts[ord(c)] if ord(c) < 0x30000 else OTHER)
    return counts, bits


def gram_slots(raw: bytes) -> list[tuple[int, np.ndarray]]:
    """Slot of the gram that starts at each byte, for each gram length."""
    x = np.frombuffer(raw, np.uint8).astype(np.uint32)
    out = []
    value = np.zeros(len(x), np.uint32)
    for n in range(1, max(GRAMS) + 1):
        value = value[: len(x) - n + 1] * np.uint32(0x01000193) + x[n - 1 :] + np.uint32(n)
        if n in GRAMS:
            spread = (value ^ (value >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            out.append((n, (spread >> np.uint32(16)).astype(np.int64)))
    return out


def word_scores(model: Model, words: list[bytes]) -> np.ndarray:
    """words x languages: sums of gram scores inside the space around each word."""
    raw = b" " + b" ".join(words) + b" "
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])  # of the space before each word
    total = np.zeros((len(words), len(model.languages)), np.float64)
    for n, slots in gram_slots(raw):
        sums = np.zeros((len(slots) + 1, len(model.languages)), np.float64)
        np.cumsum(model.grams[slots], axis=0, out=sums[1:], dtype=np.float64)
        last = np.maximum(np.minimum(starts[1:] + 1 - n + 1, len(slots)), starts[:-1])
        total += sums[last] - sums[starts[:-1]]
    return total


class WordTable:
    """Scores, letters and scripts of words, each distinct word worked out once while there is room."""

    LIMIT = 150_000

    def __init__(self, model: Model):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.places: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.model.languages)), np.float32)
        self.letters = np.zeros(0, np.int32)

    def rows(self, texts: list[str]) -> list[np.ndarray]:
        split = [utf8(t.lower()).split() for t in texts]
        if len(self.places) > self.LIMIT:
            self.clear()
        known = self.places
        new = list(dict.fromkeys(w for words in split for w in words if w not in known))
        if new:
            counts, bits = letters_by_script([w.decode("utf-8", "surrogatepass") for w in new])
            scores = word_scores(self.model, new)
            for bit in range(len(SCRIPTS) + 1):  # a script that training never saw narrows nothing
                allowed = self.model.scripts[bit]
                if allowed.any() and not allowed.all():
                    scores[np.ix_((bits >> bit & 1).astype(bool), ~allowed)] -= 50.0
            scores[counts == 0] = 0
            scores -= scores.max(axis=1, keepdims=True)
            known.update(zip(new, range(len(known), len(known) + len(new))))
            self.scores = np.concatenate([self.scores, scores.astype(np.float32)])
            self.letters = np.concatenate([self.letters, counts.astype(np.int32)])
        return [np.fromiter(map(known.__getitem__, words), np.int64, len(words)) for words in split]


def viterbi(scores: list[np.ndarray], penalty: float) -> list[np.ndarray]:
    """Best language of each word of each text; all texts advance together."""
    order = sorted(range(len(scores)), key=lambda i: -len(scores[i]))
    lengths = np.array([len(scores[i]) for i in order])
    if not len(lengths) or not lengths[0]:
        return [np.zeros(len(s), np.uint8) for s in scores]
    width = scores[0].shape[1]
    kind = np.min_scalar_type(width - 1)  # holds the number of every language
    active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")  # texts with a word at each step
    starts = np.concatenate([[0], np.cumsum(active)])
    # By step, then by text: the step's scores lie side by side.
    flat = np.empty((int(starts[-1]), width), np.float32)
    for row, i in enumerate(order):
        if lengths[row]:
            flat[starts[: lengths[row]] + row] = scores[i]
    state = np.zeros((len(order), width), np.float32)
    back = np.empty((len(flat), width), kind)
    own = np.arange(width, dtype=kind)
    for t in range(len(active)):
        n, a = active[t], starts[t]
        s = state[:n]
        best = s.argmax(axis=1)
        switched = s[np.arange(n), best][:, None] - penalty
        stay = s >= switched
        back[a : a + n] = np.where(stay, own, best[:, None].astype(kind))
        s = np.where(stay, s, switched) + flat[a : a + n]
        state[:n] = s - s.max(axis=1, keepdims=True)  # stays near 0 on texts of any length
    path = np.empty(len(flat), kind)
    now = state.argmax(axis=1)
    for t in range(len(active) - 1, -1, -1):
        n, a = active[t], starts[t]
        path[a : a + n] = now[:n]
        now[:n] = back[a + np.arange(n), now[:n]]
    out: list[np.ndarray] = [np.zeros(0, kind)] * len(scores)
    for row, i in enumerate(order):
        out[i] = path[starts[: lengths[row]] + row]
    return out


def train(docs: DataFrame, learn_from: Column, settings: Settings = Settings()) -> Model:
    """Model from rows where ``learn_from`` holds and lang is not null.

    The sample is the rows whose seeded text hash is below a limit set for each
    language, so that about ``rows_per_language`` rows are below it; equal texts
    count once.  The driver receives eight tables of counts for each language.
    """
    spark = prepare(docs.sparkSession)
    labelled = docs.where(learn_from & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("lang").alias("lang"), hashed(settings.seed, "text").alias("h"), "text"
    )
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return Model([], np.zeros((SLOTS, 0)), np.zeros((OTHER + 1, 0), bool))
    limits = {k: min(1.0, settings.rows_per_language / n) for k, n in counts.items()}
    limit = F.create_map(*[F.lit(x) for k, v in limits.items() for x in (k, int(v * ((1 << 31) - 1)))])[F.col("lang")]
    rows = (
        labelled.where(F.shiftrightunsigned("h", 33) <= limit)
        .dropDuplicates(["lang", "h"])
        .groupBy("lang", F.pmod("h", F.lit(8)).alias("share"))
        .applyInPandas(_count, "lang string, slots array<bigint>, scripts array<bigint>")
        .collect()
    )
    languages = sorted(counts)
    totals = np.zeros((SLOTS, len(languages)))
    scripts = np.zeros((OTHER + 1, len(languages)), np.int64)
    for row in rows:
        totals[:, languages.index(row["lang"])] += row["slots"]
        scripts[:, languages.index(row["lang"])] += row["scripts"]
    smooth = totals + 0.5
    logs = np.log(smooth / smooth.sum(axis=0))
    share = scripts / np.maximum(1, scripts.sum(axis=0))
    return Model(languages, (logs - logs.mean(axis=1, keepdims=True)).astype(np.float32), share > 1e-4)


def _count(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    slots = np.zeros(SLOTS, np.int64)
    scripts = np.zeros(OTHER + 1, np.int64)
    for text in group["text"]:
        words = utf8(text.lower()).split()
        raw = b" " + b" ".join(words) + b" "
        for _, found in gram_slots(raw):
            slots += np.bincount(found, minlength=SLOTS)
        letters = [c for c in text if c.isalpha()]
        points = np.array([min(ord(c), 0x2FFFF) for c in letters], np.int64)
        scripts += np.bincount(_scripts[points], minlength=OTHER + 1)
    return pd.DataFrame({"lang": [key[0]], "slots": [slots], "scripts": [scripts]})


def label(docs: DataFrame, model: Model, settings: Settings = Settings(), spans: bool = False) -> DataFrame:
    """doc_id, lang_pred, score and, if asked for, spans (first word, words, language) of every row; no other columns."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # SLOTS x languages numbers, whatever the input
    penalty = settings.switch_penalty
    fields = "lang_pred string, score double"
    if spans:
        fields += ", spans array<struct<first:int,words:int,lang:string>>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = word_table(shared.value)
        for batch in batches:
            texts = [t or "" for t in batch["text"].tolist()]
            results = []
            for a in range(0, len(texts), 500):
                results += document_labels(table, texts[a : a + 500], penalty, spans)
            out = batch[["doc_id"]].copy()
            out["lang_pred"] = [r[0] for r in results]
            out["score"] = [r[1] for r in results]
            if spans:
                out["spans"] = [r[2] for r in results]
            yield out

    return clash_free(docs, ["doc_id", "text"]).mapInPandas(run, f"doc_id long, {fields}")


def keep_known(
    docs: DataFrame, model: Model, settings: Settings = Settings(), least_score: float = 0.2
) -> DataFrame:
    """The rows of ``docs`` with a recognized language, all columns as they are.

    Rows that are ``und`` or score below ``least_score`` go; a null ``lang`` is filled with the prediction.
    """
    import pyarrow as pa

    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    penalty = settings.switch_penalty
    text_at, lang_at = (docs.columns.index(c) for c in ("text", "lang"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = word_table(shared.value)
        for batch in batches:
            texts = [t or "" for t in batch.column(text_at).to_pylist()]
            found = []
            for a in range(0, len(texts), 500):
                found += document_labels(table, texts[a : a + 500], penalty, False)
            known = batch.column(lang_at).to_pylist()
            langs = pa.array([r[0] if x is None else x for r, x in zip(found, known)], batch.schema.field(lang_at).type)
            columns = [langs if i == lang_at else c for i, c in enumerate(batch.columns)]
            good = pa.array([r[0] != UND and r[1] >= least_score for r in found], pa.bool_())
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema).filter(good)

    return docs.mapInArrow(run, docs.schema)


def word_table(model: Model) -> WordTable:
    """The worker's table for a model that was broadcast once."""
    held = getattr(model, "table", None)
    if held is None:
        held = WordTable(model)
        model.table = held
    return held


def document_labels(table: WordTable, texts: list[str], penalty: float, spans: bool) -> list[tuple]:
    languages = table.model.languages
    if not languages:
        return [(UND, 0.0, [])] * len(texts)
    rows = table.rows(texts)
    paths = viterbi([table.scores[r] for r in rows], penalty)
    out = []
    for places, path in zip(rows, paths):
        letters = table.letters[places]
        total = int(letters.sum())
        if not total:
            out.append((UND, 0.0, []))
            continue
        by = np.bincount(path, weights=letters, minlength=len(languages))
        best = int(by.argmax())
        own = (path == best) & (letters > 0)
        scores = table.scores[places[own]]
        margin = np.exp(np.clip(scores - scores.max(axis=1, keepdims=True), -30, 0))
        sure = float((margin[:, best] / margin.sum(axis=1)).mean())
        found = []
        if spans:
            cuts = np.flatnonzero(np.diff(path)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(path)]):
                found.append((int(a), int(b - a), languages[path[a]]))
        out.append((languages[best], min(1.0, sure * by[best] / total), found))
    return out
