"""Cleaning: duplicates, nulls, row filters, projections, request validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import FeatureView, enforce_schema
from .prefix import column_quantiles


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def duplicate_report(df: DataFrame) -> DataFrame:
    """Row counts before and after, from one grouped pass over the rows."""
    return (
        df.groupBy(*df.columns)
        .agg(F.count(F.lit(1)).alias("copies"))
        .agg(
            F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_before"),
            F.count(F.lit(1)).alias("rows_after"),
            F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("removed"),
        )
    )


def distinct_entities(df: DataFrame, keys: list[str], timestamp: str) -> DataFrame:
    return df.select(*keys, timestamp).distinct()


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, null_count, null_pct) from one pass."""
    columns = columns or df.columns
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in columns],
    )
    return counts.unpivot("_rows", columns, "column", "null_count").select(
        "column",
        "null_count",
        F.coalesce(F.try_divide(F.col("null_count") * 100.0, F.col("_rows")), F.lit(0.0)).alias(
            "null_pct"
        ),
    )


def fill_constant(df: DataFrame, column: str = "brand", value: str = "unknown") -> DataFrame:
    return df.na.fill({column: value})


def fill_median(df: DataFrame, columns: list[str]) -> DataFrame:
    """Null -> exact median of the column; all medians come from one plan."""
    row = (
        column_quantiles(df, columns, {"median": 0.5})
        .agg(F.map_from_entries(F.collect_list(F.struct("column", "median"))).alias("medians"))
        .scalar()
    )
    filled = df.withColumn("_medians", row)
    for c in columns:
        filled = filled.withColumn(
            c, F.coalesce(F.col(c).cast("double"), F.try_element_at("_medians", F.lit(c)))
        )
    return filled.drop("_medians")


def fill_zero(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.na.fill(0, subset=columns)


def drop_null_rows(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def of_type(df: DataFrame, event_type: str) -> DataFrame:
    return df.where(F.col("event_type") == event_type)


def in_date_range(df: DataFrame, start: str, end: str, column: str = "event_date") -> DataFrame:
    return df.where(F.col(column).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def in_time_range(df: DataFrame, start: str, end: str, column: str = "event_time") -> DataFrame:
    """Whole days start..end inclusive, as a bound on the raw time that reaches the scan."""
    after_end = F.date_add(F.lit(end).cast("date"), 1).cast("timestamp")
    return df.where(
        (F.col(column) >= F.lit(start).cast("timestamp")) & (F.col(column) < after_end)
    )


def recent(df: DataFrame, as_of: Column, hours: float, column: str = "event_time") -> DataFrame:
    """Rows strictly newer than ``as_of`` minus the window."""
    cutoff = F.unix_micros(as_of) - F.lit(int(hours * 3_600_000_000))
    return df.where(F.col(column) > F.timestamp_micros(cutoff))


def positive(df: DataFrame, target: str = "demand") -> DataFrame:
    return df.where(F.col(target) > 0)


def select_existing(df: DataFrame, features: list[str]) -> DataFrame:
    """Project to the wanted features that exist, in the wanted order."""
    return df.select(*[c for c in features if c in df.columns])


def to_feature_view(
    df: DataFrame, view: FeatureView, renames: dict[str, str], created: Column
) -> DataFrame:
    """Rename, stamp and order columns to a feature view's schema."""
    named = df.withColumnsRenamed(renames).withColumn("created_timestamp", created)
    return enforce_schema(named, view.schema())


def schema_check(df: DataFrame, schema: T.StructType) -> DataFrame:
    """(column, expected_type, present, filled_rows) per required column, one pass."""
    entries = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("expected_type"),
                F.lit(f.name in df.columns).alias("present"),
                (F.col(f"_{f.name}") if f.name in df.columns else F.lit(0).cast("long")).alias("filled_rows"),
            )
            for f in schema.fields
        ]
    )
    shared = [f.name for f in schema.fields if f.name in df.columns]
    return df.agg(*[F.count(c).alias(f"_{c}") for c in shared]).select(F.inline(entries))


def check_requests(df: DataFrame) -> DataFrame:
    """Adds parsed columns and ``reasons``: why a scoring request is unusable."""
    user = F.expr("try_cast(user_id AS bigint)")
    amount = F.expr("try_cast(transaction_amount AS double)")
    reasons = F.array_compact(
        F.array(
            F.when(F.col("user_id").isNull(), "user_id missing"),
            F.when(F.col("user_id").isNotNull() & user.isNull(), "user_id not an integer"),
            F.when(F.col("transaction_amount").isNull(), "transaction_amount missing"),
            F.when(
                F.col("transaction_amount").isNotNull() & amount.isNull(),
                "transaction_amount not a number",
            ),
            F.when(amount < 0, "transaction_amount negative"),
        )
    )
    return df.select(
        "request_id",
        user.alias("user_id"),
        amount.alias("transaction_amount"),
        reasons.alias("reasons"),
    )


def accepted_requests(df: DataFrame) -> DataFrame:
    return check_requests(df).where(F.size("reasons") == 0).drop("reasons")


def rejected_requests(df: DataFrame) -> DataFrame:
    return (
        check_requests(df)
        .where(F.size("reasons") > 0)
        .select("request_id", F.concat_ws("; ", "reasons").alias("reason"))
    )
