"""Running totals, exact quantiles and sequence numbers without a single-task sort.

A running total over a whole column would plan as one sorted partition.  Here
the column is first reduced to one row per distinct value, cut into buckets at
approximate quantiles, summed inside the buckets in parallel, and shifted by
bucket offsets.  The quantiles only decide how even the buckets are; the totals
are exact whatever they are.

``group`` names one column with few values known to the caller (profiled
columns, compared models, event types); the edge and offset tables hold at most
``len(groups) * BUCKETS`` rows, which is what makes broadcasting them safe.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 1024


def unpivot(df: DataFrame, columns: list[str], keep: list[str] = ()) -> DataFrame:
    """(keep..., column, value) with doubles; nulls are kept."""
    return df.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        list(keep), columns, "column", "value"
    )


def value_counts(long: DataFrame, group: str = "column", value: str = "value") -> DataFrame:
    return (
        long.where(F.col(value).isNotNull())
        .groupBy(group, value)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _marks(column: str) -> Column:
    """The inner edges of ``BUCKETS`` buckets of about equal size, as one array."""
    marks = ", ".join(f"{i / BUCKETS!r}D" for i in range(1, BUCKETS))
    return F.expr(f"percentile_approx({column}, array({marks}), {4 * BUCKETS})")


def _with_bucket(df: DataFrame, edges: Column, value: Column, name: str) -> DataFrame:
    """Adds the number of edges below the value: a binary search, one projection a step.

    Plain projections stay in generated code and read the edge array in place; a
    lambda over the edges would copy the whole array into every row first.
    """
    found = F.lit(0)
    step = BUCKETS
    while step > 1:
        step //= 2
        further = F.when(F.element_at(edges, found + step) < value, step).otherwise(0)
        df = df.withColumn(name, found + further)
        found = F.col(name)
    return df


def running_totals(
    counts: DataFrame, measures: list[str], group: str = "column", value: str = "value"
) -> DataFrame:
    """Per (group, value) row: ``<m>_before`` (over smaller values), ``<m>_total``
    and ``next_value``.  ``counts`` must hold one row per (group, value)."""
    edges = counts.groupBy(group).agg(_marks(value).alias("edges"))
    tagged = _with_bucket(
        counts.join(F.broadcast(edges), group), F.col("edges"), F.col(value), "bucket"
    ).drop("edges")

    in_group = Window.partitionBy(group)
    earlier = in_group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        tagged.groupBy(group, "bucket")
        .agg(*[F.sum(m).alias(m) for m in measures], F.min(value).alias("first_value"))
        .select(
            group,
            "bucket",
            F.lead("first_value").over(in_group.orderBy("bucket")).alias("next_first"),
            *[F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(f"{m}_offset") for m in measures],
            *[F.sum(m).over(in_group).alias(f"{m}_total") for m in measures],
        )
    )

    in_bucket = Window.partitionBy(group, "bucket").orderBy(value)
    up_to_here = in_bucket.rowsBetween(Window.unboundedPreceding, 0)
    local = tagged.select(
        *counts.columns,
        "bucket",
        *[(F.sum(m).over(up_to_here) - F.col(m)).alias(f"{m}_local") for m in measures],
        F.lead(value).over(in_bucket).alias("next_local"),
    )
    return local.join(F.broadcast(offsets), [group, "bucket"]).select(
        *counts.columns,
        *[(F.col(f"{m}_local") + F.col(f"{m}_offset")).alias(f"{m}_before") for m in measures],
        *[F.col(f"{m}_total") for m in measures],
        F.coalesce("next_local", "next_first").alias("next_value"),
    )


def quantiles(
    long: DataFrame, probs: dict[str, float], group: str = "column", value: str = "value"
) -> DataFrame:
    """Exact quantiles (linear interpolation) per group, one column per name."""
    running = running_totals(value_counts(long, group, value), ["n"], group, value)
    start, end, total = F.col("n_before"), F.col("n_before") + F.col("n"), F.col("n_total")

    picks = []
    for name, q in probs.items():
        position = (total - 1) * F.lit(float(q))
        for side, rank in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            hit = (start <= rank) & (rank < end)
            picks.append(F.max(F.when(hit, F.col(value))).alias(f"{name}_{side}"))
    wide = running.groupBy(group).agg(F.max("n_total").alias("n_total"), *picks)

    def interpolate(name: str, q: float) -> Column:
        position = (F.col("n_total") - 1) * F.lit(float(q))
        lo, hi = F.col(f"{name}_lo"), F.col(f"{name}_hi")
        return (lo + (position - F.floor(position)) * (hi - lo)).alias(name)

    return wide.select(group, *[interpolate(name, q) for name, q in probs.items()])


def column_quantiles(df: DataFrame, columns: list[str], probs: dict[str, float]) -> DataFrame:
    return quantiles(unpivot(df, columns), probs)


def scalar_median(df: DataFrame, column: str) -> Column:
    """Exact median as a one-row subquery."""
    return column_quantiles(df, [column], {"median": 0.5}).select("median").scalar()


def ordered_cells(df: DataFrame, order: str, identifier: str) -> DataFrame:
    """Adds ``_order`` (microseconds), ``_bucket`` and ``_part``: cells that follow (order, identifier).

    A time stamp shared by very many rows is always an edge value, and the rows
    on an edge are kept apart from the open interval before it and cut further
    along the identifier.  No cell can therefore hold a large share of the rows.
    """
    keyed = df.withColumn("_order", F.unix_micros(order))
    edges = keyed.agg(F.struct(_marks("_order").alias("times"), _marks(identifier).alias("ids"))).scalar()
    # One column holds the edges: the search steps read it, and the subquery stands in the plan once.
    keyed = keyed.withColumn("_edges", edges)
    keyed = keyed.withColumn("_times", F.col("_edges.times")).withColumn("_ids", F.col("_edges.ids"))
    placed = _with_bucket(keyed, F.col("_times"), F.col("_order"), "_bucket")
    placed = _with_bucket(placed, F.col("_ids"), F.col(identifier), "_id_bucket")
    on_edge = F.coalesce(F.try_element_at("_times", F.col("_bucket") + 1) == F.col("_order"), F.lit(False))
    return placed.withColumn(
        "_part", F.when(on_edge, F.col("_id_bucket") + 1).otherwise(0)
    ).drop("_id_bucket", "_edges", "_times", "_ids")


def sequence_numbers(df: DataFrame, order: str, identifier: str, name: str = "seq") -> DataFrame:
    """0-based position of every row in the order (order, identifier), from the sizes of ``ordered_cells``."""
    tagged = ordered_cells(df, order, identifier)

    # At most BUCKETS intervals, and one row per part of an edge value.
    sizes = tagged.groupBy("_bucket", "_part").agg(F.count(F.lit(1)).alias("_rows"))
    per_bucket = sizes.groupBy("_bucket").agg(F.sum("_rows").alias("_rows"))
    earlier_buckets = (
        Window.partitionBy(F.lit(0)).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    bucket_start = per_bucket.select(
        "_bucket", F.coalesce(F.sum("_rows").over(earlier_buckets), F.lit(0)).alias("_start")
    )
    earlier_parts = (
        Window.partitionBy("_bucket").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = sizes.join(F.broadcast(bucket_start), "_bucket").select(
        "_bucket",
        "_part",
        (F.col("_start") + F.coalesce(F.sum("_rows").over(earlier_parts), F.lit(0))).alias("_offset"),
    )
    inside = Window.partitionBy("_bucket", "_part").orderBy("_order", identifier)
    return (
        tagged.withColumn("_local", F.row_number().over(inside) - 1)
        .join(offsets, ["_bucket", "_part"])
        .withColumn(name, F.col("_local") + F.col("_offset"))
        .select(*df.columns, name)
    )
