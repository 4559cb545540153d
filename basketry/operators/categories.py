"""Drift of categorical columns: distances, a test of equal shares, new and vanished categories.

Everything follows from one count per (column, category) and side.  Counts add up
over parts of a table, so days or micro-batches can be merged before use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..session import materialize

# Beyond this exponent of the tail bound the p-value is below 1e-17.
TAIL_EXPONENT = 40.0


def category_counts(df: DataFrame, columns: list[str], keys: list[str] = ()) -> DataFrame:
    """(keys..., column, category, n); a missing value is a null category, an empty text one of its own."""
    long = df.select(*keys, *[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        list(keys), columns, "column", "category"
    )
    return long.groupBy(*keys, "column", "category").agg(F.count(F.lit(1)).alias("n"))


def side_counts(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """(column, category, ref, cur): one pass over each table, written once."""
    zero = F.lit(0).cast("long")
    ref = category_counts(reference, columns).withColumnRenamed("n", "ref").withColumn("cur", zero)
    cur = category_counts(current, columns).withColumnRenamed("n", "cur").withColumn("ref", zero)
    both = ref.unionByName(cur).groupBy("column", "category")
    return materialize(both.agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur")), "category-counts")


def _with_totals(counts: DataFrame) -> DataFrame:
    """Adds the known rows of both sides; the totals are one row per column."""
    known = F.col("category").isNotNull()
    totals = counts.groupBy("column").agg(
        F.sum(F.when(known, F.col("ref")).otherwise(0)).alias("ref_known"),
        F.sum(F.when(known, F.col("cur")).otherwise(0)).alias("cur_known"),
    )
    return counts.join(F.broadcast(totals), "column")


def _divergence(p: Column, q: Column) -> Column:
    """Half the bits that shares ``p`` and ``q`` of a category lie away from their mean."""
    mean = (p + q) / 2
    term = lambda s: F.when(s > 0, s * F.log2(s / mean)).otherwise(0.0)
    return (term(p) + term(q)) / 2


def category_changes(counts: DataFrame) -> DataFrame:
    """One row per known category: both shares, their difference, its part of the divergence, its status."""
    ref, cur = F.col("ref"), F.col("cur")
    p, q = F.try_divide(ref, F.col("ref_known")), F.try_divide(cur, F.col("cur_known"))
    return _with_totals(counts).where(F.col("category").isNotNull()).select(
        "column",
        "category",
        p.alias("reference_share"),
        q.alias("current_share"),
        (q - p).alias("difference"),
        _divergence(p, q).alias("divergence"),
        F.when(ref == 0, "new").when(cur == 0, "vanished").otherwise("kept").alias("status"),
    )


def log_gamma(z: Column) -> Column:
    """Logarithm of the gamma function for z > 0: Stirling's series after ten steps upwards."""
    up = z + 10.0
    series = (
        (up - 0.5) * F.log(up) - up + 0.9189385332046728
        + 1 / (12 * up) - 1 / (360 * up**3) + 1 / (1260 * up**5)
    )
    steps = sum((F.log(z + float(i)) for i in range(1, 10)), F.log(z))
    return series - steps


def chi_square_p(statistic: Column, degrees: Column) -> Column:
    """Probability of a larger chi-square value: one minus the series of the lower incomplete gamma function.

    The number of terms follows the arguments (about twenty roots of the degrees),
    and where the tail bound is below 1e-17 the value is 0 without any term.
    """
    a, x = degrees / 2.0, statistic / 2.0
    beyond = x - a
    # Chernoff's bound of the upper tail, as an exponent.
    exponent = F.when(beyond > 0, beyond - a * F.log(x / a)).otherwise(0.0)
    terms = F.ceil(F.greatest(beyond, F.lit(0.0)) + 12 * F.sqrt(F.greatest(x, a)) + 60).cast("int")
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def step(acc: Column, n: Column) -> Column:
        term = acc["term"] * x / (a + n)
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))

    # Rows that need no series get one term.
    total = F.aggregate(F.sequence(F.lit(1), F.when(exponent <= TAIL_EXPONENT, terms).otherwise(1)), start, step)["sum"]
    lower = F.exp(a * F.log(x) - x - log_gamma(a + 1)) * total
    upper = F.least(F.greatest(1 - lower, F.lit(0.0)), F.lit(1.0))
    return (
        F.when(statistic.isNull() | degrees.isNull(), F.lit(None))
        .when((degrees <= 0) | (statistic <= 0), 1.0)
        .when(exponent > TAIL_EXPONENT, 0.0)
        .otherwise(upper)
    )


def drift_of(counts: DataFrame, limit: float = V.JS_LIMIT, significance: float = V.SIGNIFICANCE) -> DataFrame:
    """One row per column from its counts.

    ``js_distance`` is the root of the Jensen-Shannon divergence in bits, from 0
    (equal shares) to 1 (no common category).  ``chi_square`` and ``p_value`` test
    that both sides have the same shares.  A column drifts if the distance is above
    the limit and the test finds it: on very large tables every difference is
    significant, on small ones many categories are apart by chance.  Without a known value on
    one side the figures are null and the column does not drift; missing values
    enter the missing rates alone.
    """
    known = F.col("category").isNotNull()
    ref, cur = F.col("ref").cast("double"), F.col("cur").cast("double")
    r, c = F.col("ref_known").cast("double"), F.col("cur_known").cast("double")
    both = (F.col("ref_known") > 0) & (F.col("cur_known") > 0) & known
    gap = cur * r - ref * c
    rates = {side: F.sum(F.when(~known, F.col(m)).otherwise(0)) for side, m in (("reference", "ref"), ("current", "cur"))}
    figures = _with_totals(counts).groupBy("column").agg(
        F.count_if(known).alias("categories"),
        F.count_if(known & (ref == 0)).alias("new_categories"),
        F.count_if(known & (cur == 0)).alias("vanished_categories"),
        F.sum(F.when(both, _divergence(ref / r, cur / c))).alias("_divergence"),
        F.sum(F.when(both, gap * gap / (r * c * (ref + cur)))).alias("chi_square"),
        F.try_divide(rates["reference"], F.sum("ref")).alias("reference_rate"),
        F.try_divide(rates["current"], F.sum("cur")).alias("current_rate"),
    )
    # Rounding can leave equal shares a hair below zero.
    distance = F.when(F.col("_divergence") > 0, F.sqrt("_divergence")).when(F.col("_divergence").isNotNull(), 0.0)
    degrees = F.greatest(F.col("categories") - 1, F.lit(0))
    p_value = chi_square_p(F.col("chi_square"), degrees.cast("double"))
    return figures.withColumn("p_value", p_value).select(
        "column",
        "categories",
        "new_categories",
        "vanished_categories",
        distance.alias("js_distance"),
        "chi_square",
        degrees.cast("long").alias("degrees"),
        "p_value",
        "reference_rate",
        "current_rate",
        F.when((distance > limit) & (F.col("p_value") < significance), 1).otherwise(0).alias("drifted"),
    )


def categorical_drift(
    reference: DataFrame, current: DataFrame, columns: list[str], limit: float = V.JS_LIMIT
) -> DataFrame:
    return drift_of(side_counts(reference, current, columns), limit)
