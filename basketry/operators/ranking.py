"""Top-k reports, latest rows, leaderboards and best runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .features import product_stats, top_values
from .joins import cold_flags


def popular_values(events: DataFrame, columns: list[str], k: int = 20) -> DataFrame:
    """(column, value, n): the k most frequent values of every column."""
    out = None
    for c in columns:
        part = top_values(events, c, k).select(
            F.lit(c).alias("column"), F.col(c).cast("string").alias("value"), "n"
        )
        out = part if out is None else out.unionByName(part)
    return out


def last_n_per_group(
    df: DataFrame, group: str, n: int, time: str, identifier: str
) -> DataFrame:
    """Newest n rows per group; each task keeps n rows per group before the shuffle."""
    newest = Window.partitionBy(group).orderBy(F.desc(time), F.desc(identifier))
    return df.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= n).drop("_rank")


def latest_per_key(df: DataFrame, key: str, time: str) -> DataFrame:
    """The newest row of every key; ``time`` is unique per key."""
    others = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*others), time).alias("_row")).select(key, "_row.*")


def leaderboard(metrics: DataFrame, metric: str = "roc_auc", name: str = "model") -> DataFrame:
    """Models by metric, best first, with their rank (one row per model)."""
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc(metric), F.asc(name))
    return metrics.withColumn("rank", F.row_number().over(order))


def best_by_error(
    metrics: DataFrame, error: str = "mape", name: str = "model", limit: float = 1000.0
) -> DataFrame:
    row = F.struct(*metrics.columns)
    return (
        metrics.where(F.col(error) <= limit)
        .agg(F.min_by(row, F.struct(error, name)).alias("best"))
        .where(F.col("best").isNotNull())
        .select("best.*")
    )


def best_run_per_experiment(runs: DataFrame, prefix: str | None = None) -> DataFrame:
    """Best run of each experiment, and which of them is best overall."""
    chosen = runs.where(F.col("experiment").startswith(prefix)) if prefix else runs
    best = (
        chosen.groupBy("experiment")
        .agg(F.max_by(F.struct("run_id", "metric"), F.struct("metric", -F.col("run_id"))).alias("best"))
        .select("experiment", "best.run_id", "best.metric")
    )
    overall = best.agg(
        F.max_by("run_id", F.struct("metric", -F.col("run_id")))
    ).scalar()
    return best.withColumn("is_best_overall", (F.col("run_id") == overall).cast("int"))


def popular_fallback(
    users: DataFrame, events: DataFrame, n: int = 5, threshold: int = 3
) -> DataFrame:
    """The n most popular products, in rank order, for every cold user.

    The n products travel as one short array, so the users are only projected.
    """
    ranked = product_stats(events).orderBy(F.desc("product_popularity_score"), F.asc("product_id"))
    top = (
        ranked.limit(n)
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("product_popularity_score")).alias("s"), "product_id"))))
        .scalar()
    )
    cold = cold_flags(users, events, "user_id", threshold).where(F.col("is_cold") == 1)
    return cold.select("user_id", F.posexplode(top).alias("position", "product")).select(
        "user_id", (F.col("position") + 1).alias("rank"), F.col("product.product_id").alias("product_id")
    )


def popular_fallback_in_category(
    users: DataFrame, events: DataFrame, n: int = 5
) -> DataFrame:
    """Top n products inside each user's category (``users``: user_id, category_id)."""
    scored = product_stats(events).join(
        events.select("product_id", "category_id").distinct(), "product_id"
    )
    order = Window.partitionBy("category_id").orderBy(
        F.desc("product_popularity_score"), F.asc("product_id")
    )
    top = (
        scored.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= n)
        .select("category_id", "rank", "product_id")
    )
    return users.join(top, "category_id").select("user_id", "category_id", "rank", "product_id")


def sort_panel(panel: DataFrame) -> DataFrame:
    return panel.orderBy("product_id", "event_date")


def common_columns(reference: DataFrame, current: DataFrame) -> DataFrame:
    """(column, in_reference, in_current) with the filled rows on either side."""

    def filled(df: DataFrame, name: str) -> DataFrame:
        return df.agg(*[F.count(c).alias(c) for c in df.columns]).unpivot([], df.columns, "column", name)

    return (
        filled(reference, "reference_rows")
        .join(filled(current, "current_rows"), "column", "full")
        .select(
            "column",
            F.col("reference_rows").isNotNull().alias("in_reference"),
            F.col("current_rows").isNotNull().alias("in_current"),
            "reference_rows",
            "current_rows",
        )
    )


def union_parts(parts: list[DataFrame]) -> DataFrame:
    """Concatenate parts by column name; a missing column is an error."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=False)
    return out
