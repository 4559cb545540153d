"""Profiles of the event table: distributions, histograms, summaries, latency figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as X
from .categories import category_counts
from .prefix import column_quantiles, quantiles, sequence_numbers, unpivot


def event_distribution(df: DataFrame) -> DataFrame:
    total = df.agg(F.count(F.lit(1))).scalar()
    return df.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).select(
        "event_type", "n", (F.col("n") * 100.0 / total).alias("pct")
    )


def distinct_counts(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    rows = F.count(F.lit(1)).alias("total_rows")
    if approximate:
        return df.agg(rows, *[F.approx_count_distinct(c).alias(f"unique_{c}") for c in columns])
    # One pass: each row gives a (column, value) pair per column, summed in its task before the one exchange.
    pairs = category_counts(df, columns)
    of = lambda c, value: F.coalesce(F.sum(F.when(F.col("column") == c, value)), F.lit(0).cast("long"))
    known = F.when(F.col("category").isNotNull(), 1).otherwise(0).cast("long")
    return pairs.agg(
        of(columns[0], F.col("n")).alias("total_rows"), *[of(c, known).alias(f"unique_{c}") for c in columns]
    )


def dataset_summary(df: DataFrame) -> DataFrame:
    median = column_quantiles(df, ["price"], {"median": 0.5}).select("median").scalar()
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.min("event_time").alias("first_event"),
        F.max("event_time").alias("last_event"),
        F.count_distinct("user_id").alias("unique_users"),
        F.avg("price").alias("price_mean"),
        F.stddev_samp("price").alias("price_std"),
        F.min("price").alias("price_min"),
        F.max("price").alias("price_max"),
    ).select(
        "*",
        median.alias("price_median"),
        F.try_divide(F.col("total_rows"), F.col("unique_users")).alias("events_per_user"),
    )


def hourly_activity(df: DataFrame) -> DataFrame:
    return df.groupBy(F.hour("event_time").alias("hour")).agg(F.count(F.lit(1)).alias("n"))


def weekday_activity(df: DataFrame) -> DataFrame:
    """All seven weekdays, zero for a day without events."""
    counts = df.groupBy(X.day_of_week("event_time").alias("day_of_week")).agg(
        F.count(F.lit(1)).alias("n")
    )
    days = df.sparkSession.range(7).select(F.col("id").cast("int").alias("day_of_week"))
    return days.join(counts, "day_of_week", "left").na.fill(0, ["n"])


def daily_activity(df: DataFrame) -> DataFrame:
    return df.groupBy(F.to_date("event_time").alias("event_date")).agg(
        F.count_if(F.col("event_type") == "purchase").alias("purchases"),
        F.count_if(F.col("event_type") == "view").alias("views"),
    )


def bin_index(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Equal-width bin, the last one closed; everything in bin 0 if low = high."""
    width = (high - low) / bins
    return F.when(low == high, 0).otherwise(
        F.least(F.floor(F.try_divide(value - low, width)), F.lit(bins - 1))
    ).cast("int")


def histogram(df: DataFrame, value: Column, bins: int) -> DataFrame:
    """(bin, bin_start, bin_end, n) for the non-empty bins."""
    values = df.select(value.alias("v")).where(F.col("v").isNotNull())
    limits = values.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi"))).scalar()
    low, width = F.col("limits.lo"), (F.col("limits.hi") - F.col("limits.lo")) / bins
    return (
        values.withColumn("limits", limits)
        .groupBy(bin_index(F.col("v"), low, F.col("limits.hi"), bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("limits", limits)
        .select(
            "bin",
            (low + F.col("bin") * width).alias("bin_start"),
            (low + (F.col("bin") + 1) * width).alias("bin_end"),
            "n",
        )
    )


def price_log_histogram(df: DataFrame, bins: int = 50) -> DataFrame:
    return histogram(df.where(F.col("price") > 0), F.log1p("price"), bins)


def events_per_key_histogram(df: DataFrame, key: str, bins: int = 50) -> DataFrame:
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return histogram(per_key, F.col("n").cast("double"), bins)


def activity_segments(df: DataFrame, key: str) -> DataFrame:
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    segment = (
        F.when(F.col("n") == 1, "1 event").when(F.col("n") <= 3, "2-3 events").otherwise("more than 3")
    )
    return per_key.groupBy(segment.alias("segment")).agg(F.count(F.lit(1)).alias("users"))


def box_stats(df: DataFrame, group: str = "event_type", value: str = "price") -> DataFrame:
    """Quartiles, 1.5 IQR whiskers (outermost points inside the fences) and outliers."""
    long = df.select(group, F.col(value).cast("double").alias("value")).where("value is not null")
    quartiles = quantiles(long, {"q1": 0.25, "median": 0.5, "q3": 0.75}, group)
    iqr = F.col("q3") - F.col("q1")
    fences = quartiles.select(
        "*", (F.col("q1") - 1.5 * iqr).alias("low_fence"), (F.col("q3") + 1.5 * iqr).alias("high_fence")
    )
    inside = F.col("value").between(F.col("low_fence"), F.col("high_fence"))
    # One row per event type: bounded by the list of types in the schema.
    return (
        long.join(F.broadcast(fences), group)
        .groupBy(group)
        .agg(
            F.min("value").alias("min"),
            F.first("q1").alias("q1"),
            F.first("median").alias("median"),
            F.first("q3").alias("q3"),
            F.max("value").alias("max"),
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    )


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair (a, b), rows with a null in the pair left out."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    row = df.agg(
        *[
            F.corr(
                F.when(F.col(b).isNotNull(), F.col(a).cast("double")),
                F.when(F.col(a).isNotNull(), F.col(b).cast("double")),
            ).alias(f"{a}|{b}")
            for a, b in pairs
        ]
    )
    entries = F.array(
        *[
            F.struct(F.lit(x).alias("column_a"), F.lit(y).alias("column_b"), F.col(f"{a}|{b}").alias("corr"))
            for a, b in pairs
            for x, y in ({(a, b), (b, a)})
        ]
    )
    return row.select(F.inline(entries))


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, std, min, exact quartiles and max per column."""
    long = unpivot(df, columns)
    basics = long.groupBy("column").agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    return basics.join(quantiles(long, {"q25": 0.25, "q50": 0.5, "q75": 0.75}), "column", "left")


def class_balance(df: DataFrame, label: str = "target") -> DataFrame:
    total = df.agg(F.count(F.lit(1))).scalar()
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).select(
        label, "n", (F.col("n") / total).alias("share")
    )


def target_profile(df: DataFrame, target: str = "demand") -> DataFrame:
    y = F.col(target)
    return df.agg(
        F.avg(X.flag(y == 0)).alias("zero_share"),
        F.min(F.when(y > 0, y)).alias("positive_min"),
        F.max(F.when(y > 0, y)).alias("positive_max"),
        F.avg(F.when(y > 0, y)).alias("positive_mean"),
    )


def feature_store_stats(df: DataFrame, key: str) -> DataFrame:
    names = [c for c in df.columns if c != key]
    return df.agg(F.count(F.lit(1)).alias("total_users")).select(
        "total_users",
        F.lit(len(names)).alias("feature_count"),
        F.lit(",".join(names)).alias("features"),
    )


# --- request logs --------------------------------------------------------------

LATENCY_QUANTILES = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


def latency_summary(df: DataFrame, group: str = "model", value: str = "latency") -> DataFrame:
    long = df.select(group, F.col(value).cast("double").alias("value"))
    basics = long.groupBy(group).agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_pop("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    return basics.join(quantiles(long, LATENCY_QUANTILES, group), group)


def throughput(df: DataFrame, group: str = "model", time: str = "event_time") -> DataFrame:
    """Requests per second between first and last request; 0 without a span."""
    span = X.seconds_between("last", "first")
    return df.groupBy(group).agg(
        F.count(F.lit(1)).alias("requests"), F.min(time).alias("first"), F.max(time).alias("last")
    ).select(
        group,
        "requests",
        F.when((F.col("requests") < 2) | (span == 0), 0.0)
        .otherwise(F.try_divide(F.col("requests"), span))
        .alias("requests_per_second"),
    )


def error_rates(df: DataFrame, is_error: Column, window_size: int = 1000) -> DataFrame:
    """Errors per window capacity and per request, and the success rate."""
    return df.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(is_error).alias("errors")
    ).select(
        "total",
        "errors",
        (F.col("errors") / F.lit(window_size)).alias("errors_per_window"),
        F.coalesce(F.try_divide(F.col("errors"), F.col("total")), F.lit(0.0)).alias("error_rate"),
        F.coalesce(F.try_divide(F.col("total") - F.col("errors"), F.col("total")), F.lit(0.0)).alias(
            "success_rate"
        ),
    )


def block_throughput(
    df: DataFrame, latency_seconds: Column, time: str, identifier: str, block: int = 100
) -> DataFrame:
    """Requests per second of summed latency, per consecutive block of requests."""
    rows = df.select(time, identifier, latency_seconds.alias("latency"))
    numbered = sequence_numbers(rows, time, identifier)
    return (
        numbered.groupBy(F.floor(F.col("seq") / block).alias("block"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("latency").alias("seconds"))
        .select("block", "n", F.try_divide(F.col("n"), F.col("seconds")).alias("requests_per_second"))
    )


def error_counts(df: DataFrame, categories: list[str]) -> DataFrame:
    """Failed requests per category, every category listed."""
    row = df.select(X.error_category("message", "status").alias("category")).agg(
        *[F.count_if(F.col("category") == c).alias(c) for c in categories]
    )
    return row.unpivot([], categories, "category", "n")


def check_pass_rate(df: DataFrame, passed: str = "passed") -> DataFrame:
    ok = F.count_if(F.col(passed))
    return df.agg(F.count(F.lit(1)).alias("total"), ok.alias("passed")).select(
        "total",
        "passed",
        (F.col("total") - F.col("passed")).alias("failed"),
        F.coalesce(F.try_divide(F.col("passed") * 100.0, F.col("total")), F.lit(0.0)).alias("pass_pct"),
    )
