"""Drift and data quality between a reference table and a current table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..session import materialize
from . import categories
from .cleaning import null_profile
from .prefix import running_totals, unpivot
from .profile import bin_index

BINS = 10
EMPTY_SHARE = 0.0001


def value_counts_by(df: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """(keys..., column, value, n); nulls are values of their own.  Additive over parts of a table."""
    return unpivot(df, columns, keys).groupBy(*keys, "column", "value").agg(F.count(F.lit(1)).alias("n"))


def side_counts(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, ref, cur): one pass over each table, written once; all figures follow from it."""
    ref = value_counts_by(reference, columns, []).withColumnRenamed("n", "ref").withColumn("cur", F.lit(0))
    cur = value_counts_by(current, columns, []).withColumnRenamed("n", "cur").withColumn("ref", F.lit(0))
    both = ref.unionByName(cur).groupBy("column", "value").agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur"))
    return materialize(both, "drift-counts")


def psi(
    reference: DataFrame, current: DataFrame, columns: list[str], bins: int = BINS
) -> DataFrame:
    """Population stability index over equal-width bins spanning both samples."""
    return psi_of(side_counts(reference, current, columns), bins)


def psi_of(counts: DataFrame, bins: int = BINS) -> DataFrame:
    known = counts.where(F.col("value").isNotNull())
    # One row per column: as small as the column list.
    limits = known.groupBy("column").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    binned = known.join(F.broadcast(limits), "column").withColumn(
        "bin", bin_index(F.col("value"), F.col("lo"), F.col("hi"), bins)
    )

    per_bin = binned.groupBy("column", "bin").agg(
        F.sum("ref").alias("ref"),
        F.sum("cur").alias("cur"),
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
    )
    # At most ``bins`` rows per column; a bin empty on both sides adds nothing.
    of_column = Window.partitionBy("column")

    def share(m: str) -> Column:
        p = F.try_divide(F.col(m), F.sum(m).over(of_column))
        return F.when(F.coalesce(p, F.lit(0.0)) == 0, EMPTY_SHARE).otherwise(p)

    shares = per_bin.select("column", "lo", "hi", share("ref").alias("r"), share("cur").alias("c"))
    term = (F.col("c") - F.col("r")) * F.log(F.col("c") / F.col("r"))
    return shares.groupBy("column").agg(
        F.when(F.min("lo") == F.max("hi"), 0.0).otherwise(F.sum(term)).alias("psi")
    )


def _distribution_rows(counts: DataFrame) -> DataFrame:
    """Distinct values with both cumulative shares (inclusive) and the next value."""
    running = running_totals(counts.where(F.col("value").isNotNull()), ["ref", "cur"])

    def cumulative(m: str) -> Column:
        return F.try_divide(F.col(f"{m}_before") + F.col(m), F.col(f"{m}_total"))

    return running.withColumn("gap", F.abs(cumulative("ref") - cumulative("cur")))


def kolmogorov_p(statistic: Column, n_ref: Column, n_cur: Column) -> Column:
    """Asymptotic two-sided p-value: the first hundred terms of the Kolmogorov series."""
    x = F.sqrt(n_ref * n_cur / (n_ref + n_cur)) * statistic
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda acc, k: acc
        + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * x * x),
    )
    # Below 0.2 the series converges slowly and the value is 1 to twelve digits.
    return F.when(x < 0.2, 1.0).otherwise(F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0)))


def distances(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """KS statistic, its p-value and the Wasserstein distance from one set of totals."""
    return distances_of(side_counts(reference, current, columns))


def distances_of(counts: DataFrame) -> DataFrame:
    rows = _distribution_rows(counts)
    return (
        rows.groupBy("column")
        .agg(
            F.max("gap").alias("ks_statistic"),
            F.coalesce(
                F.sum(F.col("gap") * (F.col("next_value") - F.col("value"))),
                F.when(F.max("gap").isNotNull(), 0.0),
            ).alias("wasserstein"),
            F.max("ref_total").cast("double").alias("_ref"),
            F.max("cur_total").cast("double").alias("_cur"),
        )
        .select(
            "column",
            "ks_statistic",
            kolmogorov_p(F.col("ks_statistic"), F.col("_ref"), F.col("_cur")).alias("ks_p_value"),
            "wasserstein",
        )
    )


def ks_test(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    return distances(reference, current, columns).drop("wasserstein")


def wasserstein_1d(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    return distances(reference, current, columns).select("column", "wasserstein")


def missing_rate_change(
    reference: DataFrame, current: DataFrame, columns: list[str]
) -> DataFrame:
    def rates(df: DataFrame, name: str) -> DataFrame:
        return null_profile(df, columns).select("column", (F.col("null_pct") / 100).alias(name))

    return rates(reference, "reference_rate").join(rates(current, "current_rate"), "column").select(
        "column",
        "reference_rate",
        "current_rate",
        (F.col("current_rate") - F.col("reference_rate")).alias("difference"),
    )


def side_statistics(counts: DataFrame) -> DataFrame:
    """Minimum, maximum, mean, deviation and missing share of both sides, one row per column."""
    sides = {"reference": "ref", "current": "cur"}
    value, known = F.col("value"), F.col("value").isNotNull()

    def present(m: str, of: Column) -> Column:
        return F.when(F.col(m) > 0, of)

    means = counts.groupBy("column").agg(
        *[
            F.try_divide(F.sum(value * F.col(m)), F.sum(F.when(known, F.col(m)))).alias(f"{side}_mean")
            for side, m in sides.items()
        ]
    )
    figures = []
    for side, m in sides.items():
        gap = value - F.col(f"{side}_mean")
        n = F.sum(F.when(known, F.col(m)))
        figures += [
            F.min(present(m, value)).alias(f"{side}_min"),
            F.max(present(m, value)).alias(f"{side}_max"),
            F.max(f"{side}_mean").alias(f"{side}_mean"),
            F.sqrt(F.try_divide(F.sum(F.col(m) * gap * gap), F.nullif(n - 1, F.lit(0)))).alias(f"{side}_std"),
            F.try_divide(F.sum(F.when(~known, F.col(m)).otherwise(0)), F.sum(m)).alias(f"{side}_rate"),
        ]
    # One row per column.
    return counts.join(F.broadcast(means), "column").groupBy("column").agg(*figures)


def range_violations(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """Statistics of both sides, a violation flag and the mean change in percent."""
    statistics = side_statistics(side_counts(reference, current, columns))
    return violations_of(statistics.drop("reference_rate", "current_rate"))


def violations_of(statistics: DataFrame) -> DataFrame:
    ref_mean, cur_mean = F.col("reference_mean"), F.col("current_mean")
    outside = (F.col("current_min") < F.col("reference_min")) | (
        F.col("current_max") > F.col("reference_max")
    )
    change = F.abs((cur_mean - ref_mean) / F.nullif(ref_mean, F.lit(0.0))) * 100
    return statistics.withColumn("violation", F.when(outside, 1).otherwise(0)).withColumn(
        "mean_change_pct", F.coalesce(change, F.lit(0.0))
    )


def drift_detail(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """All distances and the statistics of both sides, one row per column; one pass over each table."""
    counts = side_counts(reference, current, columns)
    statistics = violations_of(side_statistics(counts))
    return (
        psi_of(counts)
        .join(distances_of(counts), "column")
        .join(statistics, "column")
        .withColumn("difference", F.col("current_rate") - F.col("reference_rate"))
    )


def drift_summary(
    reference: DataFrame,
    current: DataFrame,
    columns: list[str],
    psi_limit: float = V.PSI_LIMIT,
    ks_limit: float = V.KS_LIMIT,
    categorical: list[str] = (),
    js_limit: float = V.JS_LIMIT,
) -> DataFrame:
    """One row: score (largest PSI), drifted columns, dataset flag, missing, ranges, new categories.

    A numeric column drifts by PSI or KS, a column of ``categorical`` by its
    Jensen-Shannon distance; both kinds count alike for the data set.
    """
    figures = drift_detail(reference, current, columns).select(
        "psi",
        ((F.col("psi") > psi_limit) | (F.col("ks_statistic") > ks_limit)).alias("drifted"),
        "current_rate",
        "violation",
        F.lit(0).cast("long").alias("new_categories"),
    )
    if categorical:
        figures = figures.unionByName(
            categories.categorical_drift(reference, current, categorical, js_limit).select(
                F.lit(None).cast("double").alias("psi"),
                (F.col("drifted") == 1).alias("drifted"),
                "current_rate",
                F.lit(0).alias("violation"),
                "new_categories",
            )
        )
    return figures.agg(
        F.max("psi").alias("drift_score"),
        F.count_if("drifted").alias("drifted_columns"),
        F.count(F.lit(1)).alias("total_columns"),
        F.max("current_rate").alias("max_missing_rate"),
        F.coalesce(F.sum("violation"), F.lit(0)).alias("range_violations"),
        F.coalesce(F.sum("new_categories"), F.lit(0)).alias("new_categories"),
    ).withColumn(
        "dataset_drift",
        F.when(F.col("drifted_columns") * 2 >= F.col("total_columns"), 1).otherwise(0),
    )


RANK_BUCKETS = 1024


def daily_ks(reference: DataFrame, current: DataFrame) -> DataFrame:
    """(day, column, ks_statistic): exact, from (column, value, n) and (day, column, value, n) without nulls.

    Between two values of a day its own share stands still and the reference's only
    grows, so the largest gap lies at a value of the day or just before one.  Every
    distinct value therefore gets the reference's share up to it once, and days are
    joined to that; no day meets the values of the reference.  A day's running
    count is taken inside buckets of neighbouring values and shifted by what the
    buckets before hold, so a day with very many values is many groups.  A day
    without values, or a column without reference, has no row.
    """
    none = F.lit(0).cast("long")
    values = (
        reference.select("column", "value", F.col("n").alias("ref"))
        .unionByName(current.select("column", "value", none.alias("ref")))
        .groupBy("column", "value")
        .agg(F.sum("ref").alias("ref"), F.lit(1).cast("long").alias("one"))
    )
    ranked = running_totals(values, ["ref", "one"])
    below = F.try_divide(F.col("ref_before"), F.col("ref_total"))
    upto = F.try_divide(F.col("ref_before") + F.col("ref"), F.col("ref_total"))
    bucket = F.floor(F.col("one_before") * RANK_BUCKETS / F.col("one_total")).cast("int")
    places = materialize(
        ranked.select("column", "value", below.alias("below"), upto.alias("upto"), bucket.alias("bucket")), "ranks"
    )
    placed = materialize(current.select("day", "column", "value", "n").join(places, ["column", "value"]), "placed")

    # At most ``RANK_BUCKETS`` rows per day and column.
    own = Window.partitionBy("day", "column")
    earlier = own.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("day", "column", "bucket").agg(F.sum("n").alias("rows")).select(
        "day",
        "column",
        "bucket",
        F.coalesce(F.sum("rows").over(earlier), none).alias("offset"),
        F.sum("rows").over(own).alias("total"),
    )
    inside = Window.partitionBy("day", "column", "bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    counted = placed.withColumn("local", F.sum("n").over(inside)).join(offsets, ["day", "column", "bucket"])
    through = F.col("offset") + F.col("local")
    gap = F.greatest(
        F.abs(F.col("upto") - through / F.col("total")),
        F.abs(F.col("below") - (through - F.col("n")) / F.col("total")),
    )
    return counted.groupBy("day", "column").agg(F.max(gap).alias("ks_statistic")).where(F.col("ks_statistic").isNotNull())


def daily_summary(
    reference: DataFrame,
    current: DataFrame,
    total_columns: int,
    psi_limit: float = V.PSI_LIMIT,
    ks_limit: float = V.KS_LIMIT,
) -> DataFrame:
    """Drift of each day in ``current`` (day, column, value, n) from ``reference`` (column, value, n).

    KS is exact.  PSI is taken over tenths of the reference's range; values beyond
    the range fall into the outer tenths.
    """
    reference, current = materialize(reference, "reference-counts"), materialize(current, "day-counts")
    known = F.col("value").isNotNull()
    limits = reference.groupBy("column").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    place = F.least(F.greatest(F.col("value"), F.col("lo")), F.col("hi"))
    # One row per column.
    binned = lambda df: df.where(known).join(F.broadcast(limits), "column").withColumn(
        "bin", bin_index(place, F.col("lo"), F.col("hi"), BINS)
    )
    ref = binned(reference).groupBy("column", "bin").agg(F.sum("n").alias("ref"))
    cur = binned(current).groupBy("day", "column", "bin").agg(F.sum("n").alias("cur"))
    days = current.select("day", "column").distinct()
    # At most ``BINS`` rows per day and column.
    cells = (
        days.join(ref, "column")
        .select("day", "column", "bin", "ref", F.lit(0).cast("long").alias("cur"))
        .unionByName(cur.withColumn("ref", F.lit(0).cast("long")))
        .groupBy("day", "column", "bin")
        .agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur"))
    )
    own = Window.partitionBy("day", "column")
    part = lambda m: F.try_divide(F.col(m), F.sum(m).over(own))
    filled = lambda m: F.when(F.coalesce(part(m), F.lit(0.0)) == 0, EMPTY_SHARE).otherwise(part(m))
    shares = cells.select("day", "column", filled("ref").alias("r"), filled("cur").alias("c"))
    term = (F.col("c") - F.col("r")) * F.log(F.col("c") / F.col("r"))
    index = shares.groupBy("day", "column").agg(F.sum(term).alias("psi"))
    ks = daily_ks(reference.where(known), current.where(known))
    figures = current.join(F.broadcast(limits), "column").groupBy("day", "column").agg(
        F.try_divide(F.sum(F.when(~known, F.col("n")).otherwise(0)), F.sum("n")).alias("missing"),
        F.max(F.when((F.col("value") < F.col("lo")) | (F.col("value") > F.col("hi")), 1).otherwise(0)).alias("outside"),
    )
    drifted = (F.col("psi") > psi_limit) | (F.col("ks_statistic") > ks_limit)
    return (
        figures.join(index, ["day", "column"], "left")
        .join(ks, ["day", "column"], "left")
        .groupBy("day")
        .agg(
            F.max("psi").alias("drift_score"),
            F.count_if(drifted).alias("drifted_columns"),
            F.lit(total_columns).cast("long").alias("total_columns"),
            F.max("missing").alias("max_missing_rate"),
            F.sum("outside").alias("range_violations"),
            F.max("ks_statistic").alias("max_ks"),
        )
        .withColumn(
            "dataset_drift",
            F.when(F.col("drifted_columns") * 2 >= F.col("total_columns"), 1).otherwise(0),
        )
    )


def quality_tests(
    reference: DataFrame,
    current: DataFrame,
    columns: list[str],
    tolerance: float = 0.1,
) -> DataFrame:
    """(test, column, expected, actual, passed): current figures within the tolerance
    of the reference, for the table and for its first three numeric columns."""
    first = columns[:3]

    def figures(df: DataFrame, name: str) -> DataFrame:
        aggregates = [
            ("row_count", "*", F.count(F.lit(1)).cast("double")),
            ("column_count", "*", F.max(F.lit(float(len(df.columns))))),
        ]
        for c in first:
            v = F.col(c).cast("double")
            aggregates += [
                ("min", c, F.min(v)),
                ("max", c, F.max(v)),
                ("mean", c, F.avg(v)),
                ("std", c, F.stddev_samp(v)),
                ("null_count", c, F.count_if(v.isNull()).cast("double")),
                ("null_share", c, F.avg(F.when(v.isNull(), 1.0).otherwise(0.0))),
            ]
        row = df.agg(*[value.alias(f"m{i}") for i, (_, _, value) in enumerate(aggregates)])
        entries = F.array(
            *[
                F.struct(F.lit(t).alias("test"), F.lit(c).alias("column"), F.col(f"m{i}").alias(name))
                for i, (t, c, _) in enumerate(aggregates)
            ]
        )
        return row.select(F.inline(entries))

    within = F.abs(F.col("actual") - F.col("expected")) <= tolerance * F.abs(F.col("expected"))
    return (
        figures(reference, "expected")
        .join(figures(current, "actual"), ["test", "column"])
        .withColumn("passed", F.coalesce(within, F.col("expected").isNull() & F.col("actual").isNull()))
    )


def concept_drift(
    df: DataFrame, columns: list[str], label: str, prediction: str, limit: float = V.CONCEPT_LIMIT
) -> DataFrame:
    """Correlation of every feature with the error flag, and whether it is large."""
    error = F.when(F.col(label) != F.col(prediction), 1.0).otherwise(0.0)
    row = df.agg(
        *[F.corr(F.col(c).cast("double"), F.when(F.col(c).isNotNull(), error)).alias(c) for c in columns]
    )
    return row.unpivot([], columns, "column", "error_correlation").withColumn(
        "drift", F.when(F.abs("error_correlation") > limit, 1).otherwise(0)
    )
