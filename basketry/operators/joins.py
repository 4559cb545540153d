"""Joins: per-key lookups, as-of retrieval with time-to-live, online reads, consistency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import FeatureView
from ..session import materialize
from . import cleaning

HOT_SHARE = 1 / 256
HOUR_SECONDS = 3600


# --- many facts, one lookup row per key ---------------------------------------

def attach(facts: DataFrame, lookup: DataFrame, key: str, weight: str, row_id: str = "event_id") -> DataFrame:
    """Left join of facts with a table holding one row per key.

    ``weight`` is the lookup column with the number of fact rows of the key; it
    is not part of the result.  The lookup is written once, since it is read
    three times.  Keys owning more than ``HOT_SHARE`` of all rows (at most
    ``1 / HOT_SHARE`` of them) are broadcast; the others are joined by key, by
    broadcast or by shuffle as the planner finds their written size.  Facts that
    are already served (or have no key) are spread over as many salts as the
    session has shuffle partitions instead of meeting in one task.
    """
    spark = facts.sparkSession
    lookup = materialize(lookup, "lookup")
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    values = [c for c in lookup.columns if c not in (key, weight)]
    total = lookup.agg(F.sum(weight)).scalar()
    is_hot = F.col(weight) > total * HOT_SHARE
    hot = lookup.where(is_hot).select(
        F.col(key).alias("_hot_key"), F.struct(*values).alias("_hot")
    )
    rest = lookup.where(~is_hot).select(
        F.col(key).alias("_key"), F.lit(0).alias("_zero"), F.struct(*values).alias("_rest")
    )
    served = F.col("_hot").isNotNull() | F.col(key).isNull()
    salt = F.when(served, F.pmod(F.xxhash64(row_id), F.lit(salts)) + 1).otherwise(0).cast("int")
    return (
        facts.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left")
        .withColumn("_salt", salt)
        .join(rest, (F.col(key) == F.col("_key")) & (F.col("_salt") == F.col("_zero")), "left")
        .select(
            *facts.columns,
            *[F.coalesce(f"_hot.{v}", f"_rest.{v}").alias(v) for v in values],
        )
    )


def merge_parts(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join of feature parts that hold one row per key."""
    return left.join(right, keys, "inner")


def merge_left_fill(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join, every missing number becomes 0."""
    return left.join(right, keys, "left").na.fill(0)


# --- as-of ---------------------------------------------------------------------

def _bucketed(df: DataFrame, micros: str, seconds: int) -> DataFrame:
    return df.withColumn("_bucket", F.floor(F.col(micros) / (seconds * 1_000_000)).cast("long"))


def _carried(rows: DataFrame, keys: list[str], payload: str) -> DataFrame:
    """Per (keys, bucket): the largest payload of any earlier bucket of the key.

    Works on one row per key and non-empty bucket, which a key with very many
    rows has no more of than any other busy key.
    """
    earlier = (
        Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        rows.groupBy(*keys, "_bucket")
        .agg(F.max(payload).alias("_latest"))
        .withColumn("_carry", F.last("_latest", ignorenulls=True).over(earlier))
        .where(F.col("_carry").isNotNull())
        .drop("_latest")
    )


def asof_join(
    entities: DataFrame,
    features: DataFrame,
    keys: list[str],
    names: list[str],
    ttl_seconds: int,
    entity_time: str = "event_timestamp",
    feature_time: str = "event_timestamp",
    created: str = "created_timestamp",
    bucket_seconds: int = HOUR_SECONDS,
) -> DataFrame:
    """Latest feature row per entity row: same keys, not later, not older than the TTL.

    Entity and feature rows are unioned and walked in time order, one sort per
    (key, time bucket) instead of a join on ``<=``.  The last feature row of the
    earlier buckets enters each bucket as an extra row, so a key with a large
    share of all rows is worked on by many tasks.  Ties on the feature time go
    to the larger created time.
    """
    at, side = "_at", "_side"
    entity_rows = entities.select(
        *keys,
        F.unix_micros(entity_time).alias(at),
        F.lit(1).alias(side),
        F.struct(*entities.columns).alias("_entity"),
    )
    feature_rows = (
        features.where(F.expr(" AND ".join(f"{k} IS NOT NULL" for k in keys)))
        .select(
            *keys,
            F.unix_micros(feature_time).alias(at),
            F.lit(0).alias(side),
            F.struct(
                F.unix_micros(feature_time).alias("at"),
                F.unix_micros(created).alias("created"),
                *names,
            ).alias("_feature"),
        )
    )
    rows = _bucketed(entity_rows.unionByName(feature_rows, allowMissingColumns=True), at, bucket_seconds)
    carried = _carried(rows, keys, "_feature").select(
        *keys,
        (F.col("_bucket") * (bucket_seconds * 1_000_000)).alias(at),
        F.lit(-1).alias(side),
        F.col("_carry").alias("_feature"),
        "_bucket",
    )
    walk = (
        Window.partitionBy(*keys, "_bucket")
        .orderBy(at, side, F.col("_feature.at"), F.col("_feature.created"))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    matched = (
        rows.unionByName(carried, allowMissingColumns=True)
        .withColumn("_match", F.last("_feature", ignorenulls=True).over(walk))
        .where(F.col(side) == 1)
    )
    fresh = F.col(at) - F.col("_match.at") <= F.lit(ttl_seconds * 1_000_000)
    return matched.select(
        "_entity.*", *[F.when(fresh, F.col(f"_match.{n}")).alias(n) for n in names]
    )


def previous_time(
    df: DataFrame, keys: list[str], time: str, name: str, bucket_seconds: int = HOUR_SECONDS
) -> DataFrame:
    """Time of the previous row of the key (null for the first), walked in time buckets."""
    rows = _bucketed(
        df.withColumn("_at", F.unix_micros(time)).withColumn("_real", F.lit(1)), "_at", bucket_seconds
    )
    carried = _carried(rows, keys, "_at").select(
        *keys, F.col("_carry").alias("_at"), F.lit(0).alias("_real"), "_bucket"
    )
    walk = Window.partitionBy(*keys, "_bucket").orderBy("_at", "_real")
    return (
        rows.unionByName(carried, allowMissingColumns=True)
        .withColumn(name, F.timestamp_micros(F.lag("_at").over(walk)))
        .where(F.col("_real") == 1)
        .select(*df.columns, name)
    )


def historical_features(
    entities: DataFrame, views: list[tuple[FeatureView, DataFrame]]
) -> DataFrame:
    """Training rows: every entity row with the features of all views as of its time."""
    out = entities
    for view, table in views:
        names = view.feature_names
        out = asof_join(out, table, list(view.keys), names, view.ttl_seconds)
    return out


# --- online reads ----------------------------------------------------------------

def online_table(
    features: DataFrame,
    keys: list[str],
    start: Column | None = None,
    end: Column | None = None,
    time: str = "event_timestamp",
    created: str = "created_timestamp",
) -> DataFrame:
    """Latest row per key inside the materialization range, by partial aggregation."""
    rows = features
    if start is not None:
        rows = rows.where(F.col(time) >= start)
    if end is not None:
        rows = rows.where(F.col(time) <= end)
    others = [c for c in features.columns if c not in keys]
    return (
        rows.groupBy(*keys)
        .agg(F.max_by(F.struct(*others), F.struct(time, created)).alias("_row"))
        .select(*keys, "_row.*")
    )


def online_lookup(
    entities: DataFrame, online: DataFrame, keys: list[str], names: list[str]
) -> DataFrame:
    return entities.join(online.select(*keys, *names), keys, "left").select(
        *entities.columns, *names
    )


def lookup_default_mean(requests: DataFrame, features: DataFrame, key: str) -> DataFrame:
    """Features of the user, or the column means for a user without any."""
    names = [c for c in features.columns if c != key]
    means = features.agg(F.struct(*[F.avg(n).alias(n) for n in names])).scalar()
    known = features.select(key, F.struct(*[F.col(n).cast("double").alias(n) for n in names]).alias("_own"))
    own = F.col("_own")
    return (
        requests.join(known, key, "left")
        .withColumn("_means", means)
        .select(
            *requests.columns,
            *[
                F.when(own.isNotNull(), F.col(f"_own.{n}")).otherwise(F.col(f"_means.{n}")).alias(n)
                for n in names
            ],
            F.when(own.isNull(), 1).otherwise(0).alias("is_default"),
        )
    )


def enrich_requests(requests: DataFrame, features: DataFrame) -> DataFrame:
    """Accepted requests with the user's features and the amount as the last column."""
    names = [c for c in features.columns if c != "user_id"]
    accepted = cleaning.accepted_requests(requests)
    return lookup_default_mean(accepted, features, "user_id").select(
        "request_id", "user_id", *names, "transaction_amount", "is_default"
    )


# --- comparisons -------------------------------------------------------------------

def consistency_check(
    offline: DataFrame,
    online: DataFrame,
    keys: list[str],
    names: list[str],
    rtol: float = 1e-5,
    atol: float = 0.0,
) -> DataFrame:
    """(keys, feature, offline, online, difference, passed) per entity and feature.

    Values match if ``|a - b| <= atol + rtol * |b|``; two nulls match, one does not.
    """
    a = offline.select(*keys, F.struct(*[F.col(n).cast("double").alias(n) for n in names]).alias("_a"))
    b = online.select(*keys, F.struct(*[F.col(n).cast("double").alias(n) for n in names]).alias("_b"))
    cells = F.array(
        *[
            F.struct(
                F.lit(n).alias("feature"), F.col(f"_a.{n}").alias("offline"), F.col(f"_b.{n}").alias("online")
            )
            for n in names
        ]
    )
    off, on = F.col("offline"), F.col("online")
    return (
        a.join(b, keys, "full")
        .select(*keys, F.inline(cells))
        .withColumn("difference", F.abs(off - on))
        .withColumn(
            "passed",
            F.when(off.isNull() & on.isNull(), True)
            .when(off.isNull() | on.isNull(), False)
            .otherwise(F.col("difference") <= atol + rtol * F.abs(on)),
        )
    )


def cold_flags(
    entities: DataFrame, events: DataFrame, key: str, threshold: int = 3
) -> DataFrame:
    """1 for an entity with fewer than ``threshold`` events, unseen entities included."""
    counts = events.groupBy(key).agg(F.count(F.lit(1)).alias("event_count"))
    n = F.coalesce("event_count", F.lit(0))
    return entities.join(counts, key, "left").select(
        *entities.columns, n.alias("event_count"), F.when(n < threshold, 1).otherwise(0).alias("is_cold")
    )
