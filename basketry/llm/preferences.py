"""Quality scores learned from preference pairs (Bradley-Terry).

A document with label 1 is preferred to one with label 0.  The score of a
document is linear in its standardized features and their squares; the weights
minimize the logistic loss of the score differences of all pairs, with a
small ridge.  The threshold is the quantile of the training scores that has the
training share of label 0 below it; the reported score is the logistic function
of the distance to it, so 0.5 is the threshold.

Every labelled document is learned from, with each one of the other label, though no pair
is ever formed: the loss's slope depends on a pair by a smooth function of its two scores.
Scores are cut into cells of width 1 and that function is interpolated in both of them at
``NODES`` places of a cell, which is exact to rounding.  A pass sums the rows of each cell and
node, so it is linear in the rows; the driver gets a few sums for each cell and partition,
pairs up cells in place of documents, and takes Newton's step.

Defined results: null and empty texts have the features of no words and get a
score as well; without labels of both kinds every score is 0.5; rows with a null
label are not learned from; repeated rows are scored alike; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .support import prepare, utf8, written

#: Labelled rows of a partition.
PART_ROWS = 50_000
#: Places of a cell where functions of a score are interpolated; scores this far apart count as infinitely far.
NODES, FAR = 14, 40
SUMS = "part int, kind int, cell long, sums array<double>"


@dataclass(frozen=True)
class Settings:
    pairs: int | None = None  # ``fit`` on arrays can learn from so many drawn pairs instead of all
    ridge: float = 1e-2
    rounds: int = 30
    seed: int = 11


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def scores(self, features: np.ndarray) -> np.ndarray:
        if not len(self.weights):
            return np.full(len(features), 0.5)
        raw = expand(features, self.mean, self.scale) @ self.weights - self.threshold
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def _without(chars: str) -> bytes:
    return chars.encode()


UPPER = _without("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
DIGITS = _without("0123456789")
SYMBOLS = _without("#*$%&|<>{}[]\\^~_=+@/")
STOPS = _without(".,;:")
CALLS = _without("!?")
HIGH = bytes(range(128, 256))


def features_of(text: str | None) -> list[float]:
    """Shape, symbols and repetition of one text; no vocabulary."""
    raw = utf8(text)
    words = raw.split()
    n = len(words)
    size = max(1, len(raw))
    count = lambda chars: size - len(raw.translate(None, chars)) if raw else 0
    lines = [x for x in raw.split(b"\n") if x.strip()]
    distinct = len(set(words))
    triples = len(set(zip(words, words[1:], words[2:])))
    longest = max(map(len, words), default=0)
    letters = size - len(raw.translate(None, UPPER + DIGITS + SYMBOLS + STOPS + CALLS + b" \n"))
    return [
        math.log1p(n),
        sum(map(len, words)) / max(1, n),
        math.log1p(longest),
        math.log1p(100 * count(UPPER) / size),
        math.log1p(100 * count(DIGITS) / size),
        math.log1p(100 * count(SYMBOLS) / size),
        math.log1p(100 * count(STOPS) / size),
        math.log1p(100 * count(CALLS) / size),
        math.log1p(100 * count(HIGH) / size),
        math.log1p(100 * letters / size),
        distinct / max(1, n),
        triples / max(1, n - 2),
        (len(lines) - len(set(lines))) / max(1, len(lines)),
        math.log1p(n / max(1, len(lines))),
    ]


def expand(features: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    z = np.clip((features - mean) / scale, -6, 6)
    return np.hstack([z, z * z])


def fit(features: np.ndarray, labels: np.ndarray, settings: Settings = Settings()) -> Model:
    """The model of rows at hand."""
    if settings.pairs is None:
        return _learn(lambda of: [list(of([(features, labels)]))], lambda low, model: _quantile(features, model, low), settings)
    good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    if not len(good) or not len(bad):
        return _none()
    mean, scale = features.mean(axis=0), np.maximum(features.std(axis=0), 1e-3)
    x = expand(features, mean, scale)
    rng = np.random.default_rng(settings.seed)
    pairs = x[rng.choice(good, settings.pairs)] - x[rng.choice(bad, settings.pairs)]

    def slopes(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(np.clip(pairs @ weights, -30, 30)))  # of the wrong order
        return -(pairs * p[:, None]).mean(axis=0), (pairs * (p * (1 - p))[:, None]).T @ pairs / len(pairs)

    weights = _newton(slopes, x.shape[1], settings)
    return Model(mean, scale, weights, _quantile(features, Model(mean, scale, weights, 0.0), len(bad)))


def _none() -> Model:
    none = np.zeros(0)
    return Model(none, none, none, 0.0)


def _quantile(features: np.ndarray, model: Model, below: int) -> float:
    """Half way between two training scores."""
    scores = np.sort(expand(features, model.mean, model.scale) @ model.weights)
    return float((scores[below - 1] + scores[below]) / 2)


def _newton(slopes: Callable, size: int, settings: Settings) -> np.ndarray:
    """The weights where the slope of loss and ridge is 0; ``slopes`` gives the loss's gradient and Hessian."""
    weights = np.zeros(size)
    for _ in range(settings.rounds):
        gradient, hessian = slopes(weights)
        step = np.linalg.solve(hessian + settings.ridge * np.eye(size), gradient + settings.ridge * weights)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return weights


# --- all pairs, by cells of scores -------------------------------------------------------

Rows = Iterable[tuple[np.ndarray, np.ndarray]]  # features and labels, some rows at a time
Sums = list[tuple[int, int, np.ndarray]]  # kind, cell, sums

_ANGLES = (2 * np.arange(NODES) + 1) * np.pi / (2 * NODES)
_PLACES = (np.cos(_ANGLES) + 1) / 2
_BASIS = np.cos(np.arange(NODES)[:, None] * _ANGLES) * np.where(np.arange(NODES) == 0, 1, 2)[:, None] / NODES


def _cells(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cell of each score and its share in each node of that cell (Chebyshev interpolation)."""
    cell = np.floor(scores)
    return cell.astype(np.int64), np.polynomial.chebyshev.chebvander(2 * (scores - cell) - 1, NODES - 1) @ _BASIS


def _moments(rows: Rows) -> Sums:
    """Rows, good and bad ones; mean and squared deviations of each feature."""
    held = None
    for features, labels in rows:
        if len(labels):
            mean = features.mean(axis=0)
            here = np.concatenate([[len(labels), (labels == 1).sum(), (labels == 0).sum()], mean, ((features - mean) ** 2).sum(axis=0)])
            held = here if held is None else _add_moments(held, here)
    return [] if held is None else [(0, 0, held)]


def _add_moments(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    n = 3 + (len(a) - 3) // 2
    total, gap = a[0] + b[0], b[3:n] - a[3:n]
    return np.concatenate([a[:3] + b[:3], a[3:n] + gap * (b[0] / total), a[n:] + b[n:] + gap * gap * (a[0] * b[0] / total)])


def _node_sums(model: Model) -> Callable[[Rows], Sums]:
    """Of each label and cell: count and sum of the expanded features at each node."""

    def run(rows: Rows) -> Sums:
        held: dict[tuple[int, int], np.ndarray] = {}
        for features, labels in rows:
            x = expand(features, model.mean, model.scale)
            cell, share = _cells(x @ model.weights)
            x = np.hstack([np.ones((len(x), 1)), x])
            for kind in (0, 1):
                own = np.flatnonzero(labels == kind)
                for c in np.unique(cell[own]).tolist():
                    some = own[cell[own] == c]
                    found = share[some].T @ x[some]
                    held[kind, c] = held[kind, c] + found if (kind, c) in held else found
        return [(kind, c, sums.ravel()) for (kind, c), sums in sorted(held.items(), key=lambda item: item[0])]

    return run


def _squares(model: Model, weights: tuple[dict[int, np.ndarray], dict[int, np.ndarray]]) -> Callable[[Rows], Sums]:
    """Sum of x x' over all rows, each with the weight that ``weights`` has at the nodes of its label and cell."""

    def run(rows: Rows) -> Sums:
        size = len(model.weights)
        held = np.zeros((size, size))
        for features, labels in rows:
            x = expand(features, model.mean, model.scale)
            cell, share = _cells(x @ model.weights)
            for kind in (0, 1):
                own = np.flatnonzero(labels == kind)
                if len(own):
                    at = np.stack([weights[kind][c] for c in cell[own].tolist()])
                    held += (x[own] * (share[own] * at).sum(axis=1)[:, None]).T @ x[own]
        return [(0, 0, held.ravel())]

    return run


def _wrong(gap: np.ndarray) -> np.ndarray:
    """Chance that the bad one of a pair is preferred, from its score less that of the good one."""
    return 1 / (1 + np.exp(-gap))


def _doubt(gap: np.ndarray) -> np.ndarray:
    p = _wrong(gap)
    return p * (1 - p)


def _across(of: Callable, to: list[int], sources: dict[int, np.ndarray], above: bool) -> dict[int, np.ndarray]:
    """At each node of the cells ``to``: the sum over all nodes of ``sources`` of ``of`` (score there - score here) times its row.

    With ``above`` sources far above count in full; far ones count nothing otherwise.
    """
    cells = np.array(sorted(sources))
    rows = np.stack([sources[c] for c in cells.tolist()])
    whole = np.cumsum(rows.sum(axis=1)[::-1], axis=0)[::-1]  # of a cell and all above it
    out = {}
    for c in to:
        low, high = np.searchsorted(cells, [c - FAR, c + FAR + 1])
        places = (cells[low:high, None] + _PLACES).ravel()
        out[c] = of(places[None, :] - (c + _PLACES)[:, None]) @ rows[low:high].reshape(len(places), rows.shape[2])
        if above and high < len(cells):
            out[c] = out[c] + whole[high]
    return out


def _learn(each: Callable, quantile: Callable, settings: Settings) -> Model:
    """``each`` applies a function of rows to every part and gives their sums in a fixed order."""
    moments = None
    for part in each(_moments):
        for _, _, found in part:
            moments = found if moments is None else _add_moments(moments, found)
    if moments is None or not moments[1] or not moments[2]:
        return _none()
    n = 3 + (len(moments) - 3) // 2
    mean, scale = moments[3:n], np.maximum(np.sqrt(moments[n:] / moments[0]), 1e-3)
    size, pairs = 2 * len(mean), moments[1] * moments[2]

    def slopes(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        model = Model(mean, scale, weights, 0.0)
        bad, good = sums = ({}, {})
        for part in each(_node_sums(model)):
            for kind, cell, found in part:
                found = found.reshape(NODES, 1 + size)
                sums[kind][cell] = sums[kind][cell] + found if cell in sums[kind] else found
        wrong, doubt = _across(_wrong, sorted(good), bad, True), _across(_doubt, sorted(good), bad, False)
        of_bad = _across(_doubt, sorted(bad), {c: x[:, :1] for c, x in good.items()}, False)
        gradient, cross = np.zeros(size), np.zeros((size, size))
        for c, x in sorted(good.items()):
            gradient -= wrong[c][:, 0] @ x[:, 1:] - x[:, 0] @ wrong[c][:, 1:]
            cross += x[:, 1:].T @ doubt[c][:, 1:]
        weight = ({c: x[:, 0] for c, x in of_bad.items()}, {c: x[:, 0] for c, x in doubt.items()})
        hessian = -cross - cross.T
        for part in each(_squares(model, weight)):
            for _, _, found in part:
                hessian += found.reshape(size, size)
        return gradient / pairs, hessian / pairs

    weights = _newton(slopes, size, settings)
    return Model(mean, scale, weights, quantile(int(moments[2]), Model(mean, scale, weights, 0.0)))


# --- tables ------------------------------------------------------------------------------

def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _arrays(batches: Iterator[pa.RecordBatch]) -> Rows:
    for batch in batches:
        if batch.num_rows:
            yield _matrix(batch.column("x"), batch.num_rows), batch.column("quality").to_numpy(zero_copy_only=False)


def described(docs: DataFrame) -> DataFrame:
    """doc_id and features (x) of every row, written: a text is looked at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features_of(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(pa.float64()))], ["doc_id", "x"])

    prepare(docs.sparkSession)
    texts = docs.select(F.col("`doc_id`").cast("long").alias("doc_id"), F.col("`text`").cast("string").alias("text"))
    return written(texts.mapInArrow(run, "doc_id long, x array<double>"), "features")


def train(docs: DataFrame, labels: DataFrame, learn_from: Column, settings: Settings = Settings()) -> Model:
    return train_described(described(docs), labels, learn_from, settings)


def train_described(features: DataFrame, labels: DataFrame, learn_from: Column, settings: Settings = Settings()) -> Model:
    """The model of all labelled documents that ``learn_from`` names."""
    if settings.pairs is not None:
        raise ValueError("a table is learned from by all of its pairs")
    prepare(features.sparkSession)
    chosen = (
        labels.where(learn_from & F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .select("doc_id", F.col("quality").cast("int").alias("quality"))
        .distinct()
    )
    rows = written(features.join(chosen, "doc_id").select("doc_id", "quality", "x").dropDuplicates(), "labelled")
    parts = max(1, -(-rows.count() // PART_ROWS))
    # The same rows in the same order whenever a part is made, so that sums do not differ between runs.
    held = rows.repartition(parts, "doc_id", "quality", "x").sortWithinPartitions("doc_id", "quality", "x")
    held = held.persist(StorageLevel.MEMORY_AND_DISK)

    def each(of: Callable[[Rows], Sums]) -> list[Sums]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part = TaskContext.get().partitionId()
            for kind, cell, sums in of(_arrays(batches)):
                columns = [pa.array([part], pa.int32()), pa.array([kind], pa.int32()), pa.array([cell], pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([sums], pa.list_(pa.float64()))], ["part", "kind", "cell", "sums"])

        found: dict[int, Sums] = {}
        for r in held.mapInArrow(run, SUMS).collect():
            found.setdefault(r["part"], []).append((r["kind"], r["cell"], np.array(r["sums"])))
        return [found[part] for part in sorted(found)]

    try:
        return _learn(each, lambda below, model: _table_quantile(held, model, below), settings)
    finally:
        held.unpersist()


def _table_quantile(rows: DataFrame, model: Model, below: int) -> float:
    """``_quantile`` without a sort: the bits of both scores, 16 at a time, by counting."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for features, _ in _arrays(batches):
            scores = expand(features, model.mean, model.scale) @ model.weights
            yield pa.RecordBatch.from_arrays([pa.array(_places(scores.view(np.int64)))], ["place"])

    places = written(rows.mapInArrow(run, "place long"), "places")
    wanted = [(None, below - 1), (None, below)]  # leading bits known so far, rows before it among those that share them
    for shift in (48, 32, 16, 0):
        known = {head for head, _ in wanted} - {None}
        among = places.where(F.shiftright("place", shift + 16).isin(*known)) if known else places
        # At most 65,536 for each.
        counts = sorted(tuple(r) for r in among.groupBy(F.shiftright("place", shift)).count().collect())
        after = []
        for head, rank in wanted:
            for value, n in counts:
                if head is not None and value >> 16 != head:
                    continue
                if rank < n:
                    after.append((value, rank))
                    break
                rank -= n
        wanted = after
    low, high = _places(np.array([value for value, _ in wanted], np.int64)).view(np.float64)
    return float((low + high) / 2)


def _places(bits: np.ndarray) -> np.ndarray:
    """Bits of doubles as integers of the same order, and back."""
    return bits ^ ((bits >> 63) & np.int64(2**63 - 1))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted of every row."""
    return score_described(described(docs), model)


def score_described(features: DataFrame, model: Model) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = model.scores(_matrix(batch.column("x"), batch.num_rows))
                columns = [batch.column("doc_id"), pa.array(found), pa.array((found >= 0.5).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "predicted"])

    prepare(features.sparkSession)
    return features.mapInArrow(run, "doc_id long, score double, predicted int")
