"""Robust multivariate outliers: minimum-covariance-determinant estimates per language and source.

Everything is DataFrame expressions.  Each text gives five statistics; those
that pass the base rules become vectors of transformed statistics in fixed
point (1/4096), so that all sums are exact and reruns agree.  For each group a
concentration step bins the squared Mahalanobis distances of its rows, takes
the bins that hold the nearest ``share`` of them, and estimates mean and
covariance from those: one aggregation over (group, bin), a bounded number of
rows for each group however many rows the group has.  The share is one half, so
that copies of a junk text may hold up to two fifths of a group.  The last bin
is taken whole only if no more than ``most_share`` of the group is near then;
of a bin with more tied rows the missing part counts, its sums scaled.

Two deterministic starts (sum and maximum of the deviations from the medians, in
median absolute deviations) are carried through the steps; the one whose
covariance has the smaller determinant wins.  Distances are scaled so that the
share's quantile has its value under normality; vectors beyond ``cutoff`` are
rejected.

Variances get a floor, since most groups have statistics that are 0 throughout.
Groups under ``least_rows`` rows are pooled by language, then over all
languages; a pool that is still smaller rejects nothing.

Defined results: null, empty and blank texts have no words and fail the base
rules; null languages and sources are groups of their own; repeated rows count
once each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .support import clash_free, prepare, written

WORD_GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"
UNIT = 4096
DIMENSIONS = ("log_words", "word_length", "symbol_rate", "line_rate", "repeat_rate")
STARTS = ("sum", "max")


@dataclass(frozen=True)
class Settings:
    #: Share of a group that the estimate rests on, and the chi-square value (5 dimensions) of that share.
    share: float = 0.5
    share_value: float = 4.3515
    #: Share that the estimate may reach by taking its last bin whole.
    most_share: float = 0.6
    #: Chi-square value (5 dimensions) beyond which a vector is rejected: probability 0.99999.
    cutoff: float = 30.856
    #: Standard deviation that each dimension has at least.
    floors: tuple[float, ...] = (0.5, 0.4, 0.4, 0.6, 0.8)
    steps: int = 4
    least_rows: int = 50


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once for each row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_words(words: Column, window: int = 8) -> Column:
    """Words that lie in a window of eight words found twice or more."""
    assert window == 8, "windows are hashed by doubling"

    def doubled(h: Column, gap: int) -> Column:
        return F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + gap)))

    def covered(windows: Column) -> Column:
        placed = F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

        def twice(s: Column) -> Column:
            both = F.filter(s, lambda e, k: (F.get(s, k - 1)["x"] == e["x"]) | (F.get(s, k + 1)["x"] == e["x"]))
            return F.sort_array(F.transform(both, lambda e: e["i"]))

        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        return F.aggregate(
            let(placed, twice),
            start,
            lambda s, p: F.struct(
                (s["n"] + p + window - F.greatest(p, s["end"])).alias("n"), (p + window).alias("end")
            ),
            lambda s: s["n"],
        )

    def count(h: Column) -> Column:
        windows = let(doubled(h, 1), lambda h2: let(doubled(h2, 2), lambda h4: doubled(h4, 4)))
        whole = F.slice(windows, F.lit(1), F.size(h) - (window - 1))
        return let(
            whole, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(covered(w))
        )

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) <= window, F.lit(0)).otherwise(let(hashes, count))


def statistics(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long)."""

    def of_text(t: Column) -> Column:
        lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        dup_lines = let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
        symbols = F.length(t) - F.length(F.regexp_replace(t, SYMBOLS, ""))
        return let(
            F.array_remove(F.split(t, WORD_GAP), ""),
            lambda words: F.struct(
                F.size(words).cast("long").alias("n_words"),
                F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
                symbols.cast("long").alias("n_symbols"),
                dup_lines.cast("long").alias("n_dup_lines"),
                repeated_words(words).cast("long").alias("n_repeat_words"),
            ),
        )

    return let(F.coalesce(text, F.lit("")), of_text)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def transformed() -> list[Column]:
    """The vector of a row in fixed point, one column for each of DIMENSIONS."""
    words = F.col("n_words").cast("double")
    rate = lambda n, of: F.log1p(100.0 * F.col(n) / of)
    values = (
        F.log(words),
        F.col("word_chars") / words,
        rate("n_symbols", F.col("word_chars").cast("double")),
        rate("n_dup_lines", words),
        rate("n_repeat_words", words),
    )
    return [F.floor(v * UNIT + 0.5).cast("long").alias(name) for name, v in zip(DIMENSIONS, values)]


def grouped(rows: DataFrame, least: int) -> DataFrame:
    """Rows with ``grp``: language and source, or a pool where those are few; null where the pool is small."""
    name = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("null"))
    rows = rows.withColumn("lang_key", name("lang")).withColumn("source_key", name("source"))
    counts = written(rows.groupBy("lang_key", "source_key").count(), "group-sizes")
    small = counts.where(F.col("count") < least)
    pools = small.groupBy("lang_key").agg(F.sum("count").alias("pool"))
    rest = pools.where(F.col("pool") < least).agg(F.sum("pool")).first()[0] or 0
    everyone = F.lit("all") if rest >= least else F.lit(None).cast("string")
    names = counts.join(pools, "lang_key", "left").select(
        "lang_key",
        "source_key",
        F.when(F.col("count") >= least, F.to_json(F.struct("lang_key", "source_key")))
        .when(F.col("pool") >= least, F.to_json(F.struct("lang_key")))
        .otherwise(everyone)
        .alias("grp"),
    )
    return rows.join(names, ["lang_key", "source_key"]).drop("lang_key", "source_key")


def bin_of(distance: Column) -> Column:
    """Bins of about two percent of 1 + distance."""
    return F.floor(F.log2(1 + distance) * 32).cast("int")


def middle(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``grp`` and the median of each column, taken from counts by value in steps of 1/64."""
    step = UNIT // 64
    out = None
    for c in columns:
        counts = rows.groupBy("grp", F.floor(F.col(c) / step).cast("long").alias("v")).agg(F.count("*").alias("n"))
        upto = F.sum("n").over(Window.partitionBy("grp").orderBy("v"))
        size = F.sum("n").over(Window.partitionBy("grp"))
        found = counts.withColumn("upto", upto).withColumn("size", size).where("2 * upto >= size")
        one = found.groupBy("grp").agg((F.min("v") * step).alias(c))
        out = one if out is None else out.join(one, "grp")
    return out


def estimate(binned: DataFrame, settings: Settings) -> DataFrame:
    """Mean, inverse Cholesky factor, log determinant and share quantile of each (grp, start)."""
    own = Window.partitionBy("grp", "start")
    upto = F.sum("n").over(own.orderBy("bin"))
    size = F.sum("n").over(own)
    pairs = list(combinations_with_replacement(DIMENSIONS, 2))
    wanted = F.ceil(F.col("size") * settings.share)
    before = F.col("upto") - F.col("n")
    near = (
        binned.withColumn("upto", upto)
        .withColumn("size", size)
        .where(before < wanted)
        .withColumn("cut", F.col("upto") > F.greatest(wanted, F.col("size") * settings.most_share))
        .withColumn("part", (wanted - before) / F.col("n"))
    )

    def taken(c: str) -> Column:
        """Sum over the whole bins, and the missing part of a last bin that is cut; each sum is exact."""
        whole, last = (F.sum(F.when(side, F.col(c))).cast("double") for side in (~F.col("cut"), F.col("cut")))
        part = F.max(F.when(F.col("cut"), F.col("part")))
        return (F.coalesce(whole, F.lit(0.0)) + F.coalesce(last * part, F.lit(0.0))).alias(c)

    sums = near.groupBy("grp", "start").agg(
        taken("n"),
        F.max("bin").alias("last_bin"),
        *[taken(f"s_{a}") for a in DIMENSIONS],
        *[taken(f"p_{a}_{b}") for a, b in pairs],
    )
    table = sums.select(
        "grp", "start", "last_bin",
        *[(F.col(f"s_{a}") / F.col("n") / UNIT).alias(f"m_{a}") for a in DIMENSIONS],
        *[
            (
                (F.col(f"p_{a}_{b}") - F.col(f"s_{a}") * F.col(f"s_{b}") / F.col("n")) / F.col("n") / UNIT**2
                + (settings.floors[DIMENSIONS.index(a)] ** 2 if a == b else 0.0)
            ).alias(f"c_{a}_{b}")
            for a, b in pairs
        ],
    )
    table = written(table, "covariance")
    # Cholesky factor l of the covariance, and its inverse w, entry by entry.
    d = range(len(DIMENSIONS))
    cov = lambda i, j: F.col(f"c_{DIMENSIONS[min(i, j)]}_{DIMENSIONS[max(i, j)]}")
    for j in d:
        left = sum((F.col(f"l_{j}_{k}") * F.col(f"l_{j}_{k}") for k in range(j)), F.lit(0.0))
        table = table.withColumn(f"l_{j}_{j}", F.sqrt(cov(j, j) - left))
        below = {}
        for i in range(j + 1, len(DIMENSIONS)):
            left = sum((F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}") for k in range(j)), F.lit(0.0))
            below[f"l_{i}_{j}"] = (cov(i, j) - left) / F.col(f"l_{j}_{j}")
        table = table.withColumns(below) if below else table
    for i in d:
        row = {f"w_{i}_{i}": 1.0 / F.col(f"l_{i}_{i}")}
        for j in range(i):
            known = sum((F.col(f"l_{i}_{k}") * F.col(f"w_{k}_{j}") for k in range(j, i)), F.lit(0.0))
            row[f"w_{i}_{j}"] = -known / F.col(f"l_{i}_{i}")
        table = table.withColumns(row)
    table = table.withColumn("log_det", sum((F.log(F.col(f"l_{i}_{i}")) for i in d), F.lit(0.0)))
    kept = [c for c in table.columns if not c.startswith(("c_", "l_"))]
    return written(table.select(*kept), "estimates")


def distance() -> Column:
    """Squared Mahalanobis distance of a row to the estimate joined to it."""
    total = F.lit(0.0)
    for i in range(len(DIMENSIONS)):
        part = F.lit(0.0)
        for j in range(i + 1):
            a = DIMENSIONS[j]
            part = part + F.col(f"w_{i}_{j}") * (F.col(a) / float(UNIT) - F.col(f"m_{a}"))
        total = total + part * part
    return total


def binned_sums(rows: DataFrame) -> DataFrame:
    """Counts, sums and sums of products of rows (grp, start, bin and the dimensions); sums are exact."""
    exact = lambda c: F.sum(c.cast("decimal(20,0)"))
    return rows.groupBy("grp", "start", "bin").agg(
        F.count("*").alias("n"),
        *[exact(F.col(a)).alias(f"s_{a}") for a in DIMENSIONS],
        *[exact(F.col(a) * F.col(b)).alias(f"p_{a}_{b}") for a, b in combinations_with_replacement(DIMENSIONS, 2)],
    )


def minimum_determinant(rows: DataFrame, settings: Settings) -> DataFrame:
    """The estimate of each group of ``rows`` (grp and the dimensions)."""
    centre = middle(rows, list(DIMENSIONS)).toDF("grp", *[f"mid_{a}" for a in DIMENSIONS])
    off = rows.join(centre, "grp").withColumns({f"off_{a}": F.abs(F.col(a) - F.col(f"mid_{a}")) for a in DIMENSIONS})
    off = written(off, "deviations")
    spread = middle(off, [f"off_{a}" for a in DIMENSIONS])
    spread = spread.toDF("grp", *[f"mad_{a}" for a in DIMENSIONS])
    scaled = [
        F.pow(F.col(f"off_{a}") / F.greatest(1.4826 * F.col(f"mad_{a}"), F.lit(f * UNIT)), 2)
        for a, f in zip(DIMENSIONS, settings.floors)
    ]
    total = sum(scaled[1:], scaled[0])
    starts = F.array(
        F.struct(F.lit("sum").alias("start"), bin_of(total).alias("bin")),
        F.struct(F.lit("max").alias("start"), bin_of(F.greatest(*scaled)).alias("bin")),
    )
    first = off.join(spread, "grp").select("grp", *DIMENSIONS, F.inline(starts))
    found = estimate(binned_sums(first), settings)
    for _ in range(settings.steps):
        near = rows.join(found, "grp").select("grp", "start", *DIMENSIONS, bin_of(distance()).alias("bin"))
        found = estimate(binned_sums(near), settings)
    # Once more for the distances that belong to the last estimate.
    near = rows.join(found, "grp").select("grp", "start", bin_of(distance()).alias("bin"))
    counts = near.groupBy("grp", "start", "bin").agg(F.count("*").alias("n"))
    own = Window.partitionBy("grp", "start")
    upto, size = F.sum("n").over(own.orderBy("bin")), F.sum("n").over(own)
    reach = counts.withColumn("upto", upto).withColumn("size", size)
    reach = reach.where(F.col("upto") >= F.ceil(F.col("size") * settings.share))
    edge = reach.groupBy("grp", "start").agg((F.pow(F.lit(2.0), (F.min("bin") + 1) / 32) - 1).alias("edge"))
    best = F.min(F.struct("log_det", F.col("start").alias("name"))).over(Window.partitionBy("grp"))
    found = found.join(edge, ["grp", "start"]).withColumn("best", best)
    # Floors make the estimate wider than the data: a group is scaled up, never down.
    factor = F.greatest(F.lit(1.0), F.col("edge") / settings.share_value)
    return found.where(F.col("start") == F.col("best")["name"]).withColumn("factor", factor).drop("best", "edge")


def reject_outliers(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per document: doc_id, the five statistics, base_failed, kept and the scaled squared distance."""
    prepare(docs.sparkSession)
    found = clash_free(docs, ["doc_id", "lang", "source", "text"]).select(
        "doc_id", "lang", "source", statistics(F.col("text")).alias("stats")
    )
    found = written(found.select("doc_id", "lang", "source", "stats.*"), "statistics")
    found = found.withColumn("base_failed", base_failed())
    numbers = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    passed = found.where(~F.col("base_failed")).select(*numbers, "lang", "source", *transformed())
    passed = written(grouped(passed, settings.least_rows), "vectors")
    best = minimum_determinant(passed.where("grp is not null").select("grp", *DIMENSIONS), settings)
    judged = passed.join(best, "grp", "left").withColumn("distance", distance() / F.col("factor"))
    kept = F.coalesce(F.col("distance") <= settings.cutoff, F.lit(True))
    return judged.select(*numbers, kept.alias("kept"), "distance").unionByName(
        found.where("base_failed").select(
            *numbers, F.lit(False).alias("kept"), F.lit(None).cast("double").alias("distance")
        )
    )
