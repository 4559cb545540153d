"""Decision tables: shadow, canary, retraining, promotion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..functions import fixed_values as V
from .prefix import quantiles
from .ranking import last_n_per_group


# --- shadow ------------------------------------------------------------------

def compare_scores(df: DataFrame, production: str, shadow: str) -> DataFrame:
    """Adds the difference, its class and the binary mismatch of two scores."""
    prod, shad = F.col(production), F.col(shadow)
    difference = F.abs(prod - shad)
    return (
        df.withColumn("absolute_difference", difference)
        .withColumn("relative_difference", difference / F.greatest(prod, F.lit(0.001)))
        .withColumn("discrepancy_type", X.discrepancy_type("absolute_difference"))
        .withColumn("production_binary", X.above_half(prod))
        .withColumn("shadow_binary", X.above_half(shad))
        .withColumn("binary_mismatch", X.flag(F.col("production_binary") != F.col("shadow_binary")))
    )


def shadow_recommendation(
    major_rate: Column,
    mismatch_rate: Column,
    ready: tuple[float, float] = V.SHADOW_READY,
    testing: tuple[float, float] = V.SHADOW_TESTING,
) -> Column:
    return (
        F.when((major_rate < ready[0]) & (mismatch_rate < ready[1]), "ready_for_production")
        .when((major_rate < testing[0]) & (mismatch_rate < testing[1]), "requires_further_testing")
        .otherwise("not_ready_high_discrepancy")
    )


def shadow_rates(compared: DataFrame, by: list[str]) -> DataFrame:
    """Counts and rates per group with the recommendation."""
    total = F.col("total_requests")
    return (
        compared.groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("total_requests"),
            F.count_if(F.col("discrepancy_type") == "major").alias("major_discrepancies"),
            F.count_if(F.col("binary_mismatch") == 1).alias("binary_mismatches"),
            F.avg("absolute_difference").alias("avg_absolute_difference"),
        )
        .withColumn("major_rate", F.coalesce(F.try_divide("major_discrepancies", total), F.lit(0.0)))
        .withColumn("mismatch_rate", F.coalesce(F.try_divide("binary_mismatches", total), F.lit(0.0)))
        .withColumn("recommendation", shadow_recommendation(F.col("major_rate"), F.col("mismatch_rate")))
    )


def shadow_summary(
    compared: DataFrame, production_latency: str, shadow_latency: str
) -> DataFrame:
    """One row over the given requests, with mean and p95 latency of both models."""
    latencies = compared.select(
        F.inline(
            F.array(
                F.struct(F.lit("production").alias("side"), F.col(production_latency).alias("value")),
                F.struct(F.lit("shadow").alias("side"), F.col(shadow_latency).alias("value")),
            )
        )
    )
    p95 = (
        quantiles(latencies, {"p95": 0.95}, "side")
        .agg(F.map_from_entries(F.collect_list(F.struct("side", "p95"))).alias("p95"))
        .scalar()
    )
    means = compared.agg(
        F.struct(
            F.coalesce(F.avg(production_latency), F.lit(0.0)).alias("production"),
            F.coalesce(F.avg(shadow_latency), F.lit(0.0)).alias("shadow"),
        )
    ).scalar()
    return (
        shadow_rates(compared, [])
        .withColumn("_mean", means)
        .withColumn("_p95", p95)
        .withColumn("production_avg_latency", F.col("_mean.production"))
        .withColumn("shadow_avg_latency", F.col("_mean.shadow"))
        .withColumn("production_p95_latency", F.coalesce(F.try_element_at("_p95", F.lit("production")), F.lit(0.0)))
        .withColumn("shadow_p95_latency", F.coalesce(F.try_element_at("_p95", F.lit("shadow")), F.lit(0.0)))
        .drop("_mean", "_p95")
    )


# --- canary --------------------------------------------------------------------

def canary_assign(requests: DataFrame, percent: int, request_id: str = "request_id") -> DataFrame:
    """Sticky, repeatable routing of a share of the requests to the new model."""
    return requests.withColumn(
        "route", F.when(X.id_bucket(request_id, 100) < percent, "new").otherwise("current")
    )


def canary_decision(
    latencies: DataFrame,
    current_model: str,
    new_model: str,
    window: int = 100,
    time: str = "event_time",
    identifier: str = "event_id",
) -> DataFrame:
    """Compare mean latency over the newest requests of both models."""
    sizes = latencies.groupBy("model").agg(F.count(F.lit(1)).alias("n"))
    last = last_n_per_group(latencies, "model", window, time, identifier)
    means = last.groupBy("model").agg(F.avg("latency").alias("mean")).join(sizes, "model")

    def of(model: str, column: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("model") == model, F.col(column))), F.lit(0))

    ratio = F.when(
        F.col("current_mean_latency") > 0,
        F.try_divide(F.col("new_mean_latency"), F.col("current_mean_latency")),
    ).otherwise(1.0)
    enough = F.col("new_requests") >= 10
    return means.agg(
        of(new_model, "mean").alias("new_mean_latency"),
        of(current_model, "mean").alias("current_mean_latency"),
        of(new_model, "n").alias("new_requests"),
        of(current_model, "n").alias("current_requests"),
    ).withColumn("latency_ratio", ratio).select(
        "*",
        F.when(enough, "analysis_complete").otherwise("insufficient_data").alias("status"),
        F.when(~enough, "continue")
        .when(F.col("latency_ratio") > V.CANARY_SLOWER, "rollback")
        .when(F.col("latency_ratio") < V.CANARY_FASTER, "increase_traffic")
        .otherwise("continue")
        .alias("recommendation"),
    )


def next_split(
    recommendation: Column, percent: Column, more: int = V.CANARY_MORE, less: int = V.CANARY_LESS
) -> Column:
    return (
        F.when(recommendation == "increase_traffic", F.least(percent + more, F.lit(100)))
        .when(recommendation == "rollback", F.greatest(percent - less, F.lit(0)))
        .otherwise(percent)
    )


# --- retraining ------------------------------------------------------------------

def retrain_decision(checks: DataFrame) -> DataFrame:
    """Reasons, delay and decision per check row.

    Input: check_id, as_of, drift_score, accuracy_drop, new_rows,
    model_created_at, last_retrain_at.
    """
    as_of = F.col("as_of")
    age = F.coalesce(
        X.whole_days_between(as_of, "model_created_at"), F.lit(V.UNKNOWN_MODEL_AGE_DAYS)
    )
    since = X.whole_days_between(as_of, "last_retrain_at")

    def reason(name: str, message: Column) -> Column:
        return F.struct(F.lit(name).alias("reason"), message.alias("message"))

    reasons = F.array_compact(
        F.array(
            F.when(
                F.col("drift_score") > V.RETRAIN_DRIFT_LIMIT,
                reason("data_drift", F.format_string(
                    V.RETRAIN_DRIFT_MESSAGE, F.col("drift_score"), F.lit(str(V.RETRAIN_DRIFT_LIMIT)))),
            ),
            F.when(
                F.col("accuracy_drop") > V.RETRAIN_ACCURACY_LIMIT,
                reason("accuracy_drop", F.format_string(
                    V.RETRAIN_ACCURACY_MESSAGE, F.col("accuracy_drop"), F.lit(str(V.RETRAIN_ACCURACY_LIMIT)))),
            ),
            F.when(
                F.weekday("as_of") == V.RETRAIN_WEEKDAY,
                reason("weekly_schedule", F.lit(V.RETRAIN_WEEKLY_MESSAGE)),
            ),
            F.when(
                age > V.RETRAIN_MAX_AGE_DAYS,
                reason("model_age", F.format_string(
                    V.RETRAIN_AGE_MESSAGE, age.cast("string"), F.lit(str(V.RETRAIN_MAX_AGE_DAYS)))),
            ),
            F.when(
                F.col("new_rows") >= V.RETRAIN_MIN_NEW_ROWS,
                reason("new_data", F.format_string(
                    V.RETRAIN_NEW_DATA_MESSAGE, F.col("new_rows").cast("string"))),
            ),
        )
    )
    needed = F.size("reasons") > 0
    too_soon = F.coalesce(F.col("days_since_last_retrain") < V.RETRAIN_MIN_INTERVAL_DAYS, F.lit(False))
    return (
        checks.withColumn("reasons", reasons)
        .withColumn("model_age_days", age)
        .withColumn("days_since_last_retrain", since)
        .select(
            "check_id",
            "as_of",
            "model_age_days",
            "days_since_last_retrain",
            F.array_join(F.col("reasons.reason"), ",").alias("reasons"),
            F.array_join(F.col("reasons.message"), "; ").alias("messages"),
            X.flag(needed).alias("retrain_needed"),
            X.flag(needed & too_soon).alias("delayed"),
            X.flag(needed & ~too_soon).alias("retrain_now"),
        )
    )


def model_age(versions: DataFrame, as_of: Column, key: str = "model_id") -> DataFrame:
    """Days since the newest Production version was created, 365 without one."""
    created = F.max(F.when(F.col("stage") == "Production", F.col("created_at")))
    return versions.groupBy(key).agg(created.alias("production_created_at")).select(
        key,
        F.coalesce(
            X.whole_days_between(as_of, "production_created_at"), F.lit(V.UNKNOWN_MODEL_AGE_DAYS)
        ).cast("long").alias("model_age_days"),
    )


def promote_best(runs: DataFrame, versions: DataFrame, key: str = "model_id") -> DataFrame:
    """Versions after promotion: per model the best run becomes the new Production
    version, earlier Production versions become Archived.

    ``runs``: key, run_id, metric.  ``versions``: key, version, run_id, stage.
    """
    best = runs.groupBy(key).agg(
        F.max_by(F.struct("run_id", "metric"), F.struct("metric", -F.col("run_id"))).alias("best")
    )
    newest = versions.groupBy(key).agg(F.max("version").alias("last_version"))
    promoted = best.join(newest, key, "left").select(
        key,
        (F.coalesce("last_version", F.lit(0)) + 1).alias("version"),
        F.col("best.run_id").alias("run_id"),
        F.lit("Production").alias("stage"),
    )
    archived = versions.join(best.select(key, F.lit(1).alias("_promoted")), key, "left").select(
        key,
        "version",
        "run_id",
        F.when(
            F.col("_promoted").isNotNull() & (F.col("stage") == "Production"), "Archived"
        ).otherwise(F.col("stage")).alias("stage"),
    )
    return archived.unionByName(promoted)
