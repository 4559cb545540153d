"""Queries: sources, sinks, cleaning, projections, filters."""

from pyspark.sql import functions as F

from ..functions import expressions as X
from ..functions.fixed_values import MODEL_FEATURES
from ..operators import cleaning, features, metrics, profile, ranking
from ..schemas import EVENTS, PRODUCT_STATS, USER_PRODUCT, USER_STATS, enforce_schema
from ..session import new_path
from ..sources import quarantine, readers, sinks
from ..streaming.jobs import collect_batches, csv_stream_apart, event_stream
from .registry import query
from .views_sql import id_bucket_sql

RUN_TS = "2024-02-01 00:00:00"

SHOP_COLUMNS = "event_id, event_time, event_type, product_id, category_id, brand, round(price, 6) AS price, user_id, user_session"
LOG_COLUMNS = "event_id, event_time, event_type, product_id, round(price, 6) AS price, user_id, user_session"


# --- sources and sinks ------------------------------------------------------------

@query("scan_events", f"SELECT {SHOP_COLUMNS} FROM shop_events")
def scan_events(t):
    """The event table written as CSV and scanned with its declared schema."""
    path = new_path(t.spark, "csv")
    t.shop_events.write.option("header", True).option(
        "timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS"
    ).csv(path)
    return enforce_schema(readers.read_csv(t.spark, path, EVENTS), EVENTS)


def _damaged_lines(t):
    """The event table as CSV lines of which one in ten is broken, in four ways."""
    line = F.to_csv(
        F.struct(*EVENTS.names), {"timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}
    )
    way = F.pmod("event_id", F.lit(40))
    broken_price = F.struct(*[F.lit("abc").alias(c) if c == "price" else F.col(c) for c in EVENTS.names])
    no_user = F.struct(*[F.lit(None).cast("long").alias(c) if c == "user_id" else F.col(c) for c in EVENTS.names])
    path = new_path(t.spark, "damaged")
    t.shop_events.select(
        F.when(way == 0, F.substring_index(line, ",", 3))
        .when(way == 1, F.to_csv(broken_price))
        .when(way == 2, F.concat(line, F.lit(",more")))
        .when(way == 3, F.to_csv(no_user))
        .otherwise(line)
    ).write.text(path)
    return path


QUARANTINE_SQL = """
    SELECT 'good' AS side, event_type AS kind, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS id_sum, round(sum(price), 6) AS price_sum
    FROM shop_events WHERE event_id % 40 > 3 GROUP BY event_type
    UNION ALL
    SELECT 'broken', CASE event_id % 40 WHEN 1 THEN 'price: not of type double' WHEN 3 THEN 'user_id: missing' ELSE 'wrong number of fields' END,
           count(*), CAST(sum(event_id) AS BIGINT), NULL FROM shop_events WHERE event_id % 40 <= 3 GROUP BY 2
    """


def _both_sides(good, broken):
    first = F.substring_index("line", ",", 1).cast("long")
    rows = good.groupBy(F.lit("good").alias("side"), F.col("event_type").alias("kind")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("id_sum"), F.sum("price").alias("price_sum")
    )
    lines = broken.groupBy(F.lit("broken").alias("side"), F.col("reason").alias("kind")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(first).alias("id_sum"), F.lit(None).cast("double").alias("price_sum")
    )
    return rows.unionByName(lines)


@query("scan_quarantine", QUARANTINE_SQL)
def scan_quarantine(t):
    """CSV lines of which some are broken: both sides, counted."""
    return _both_sides(*quarantine.read_csv_apart(t.spark, _damaged_lines(t), EVENTS, ["event_id", "user_id"], header=False))


@query("stream_quarantine", QUARANTINE_SQL)
def stream_quarantine(t):
    """The same lines as a stream."""
    return _both_sides(*csv_stream_apart(t.spark, _damaged_lines(t), EVENTS, ["event_id", "user_id"], header=False))


@query("scan_limit", f"SELECT {LOG_COLUMNS} FROM event_log ORDER BY event_time, event_id LIMIT 1000")
def scan_limit(t):
    return readers.first_rows(t.event_log, 1000)


@query(
    "scan_sample",
    f"""SELECT {LOG_COLUMNS} FROM event_log QUALIFY row_number() OVER (ORDER BY {id_bucket_sql('event_id', 2**31)}, event_id)
        <= floor((SELECT count(*) FROM event_log) * 0.05::DOUBLE)""",
)
def scan_sample(t):
    """At most five in a hundred rows, to the row."""
    return readers.exact_sample(t.event_log, 0.05)


@query("scan_sample_threshold", f"SELECT {LOG_COLUMNS} FROM event_log WHERE {id_bucket_sql('event_id', 10000)} < 500")
def scan_sample_threshold(t):
    """The sample in one pass, its size up to sampling error."""
    return readers.stable_sample(t.event_log, 0.05)


def _processed(t):
    path = new_path(t.spark, "processed")
    sinks.write_processed(t.event_log, path)
    return t.spark.read.parquet(path)


@query("scan_processed", f"SELECT {LOG_COLUMNS}, event_date FROM dated WHERE event_date >= DATE '2024-01-10'")
def scan_processed(t):
    """Read the processed dataset back; the date filter prunes its folders."""
    return _processed(t).where(F.col("event_date") >= F.lit("2024-01-10").cast("date"))


@query("sink_processed", "SELECT event_date, count(*) AS n, round(sum(price), 6) AS price_sum FROM dated GROUP BY event_date")
def sink_processed(t):
    return _processed(t).groupBy("event_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("price").alias("price_sum")
    )


@query(
    "sink_feature_group",
    f"""
    SELECT feature_group, row_count, columns, TIMESTAMP '{RUN_TS}' AS prepared_at FROM (
      SELECT 'user_stats' AS feature_group, (SELECT count(*) FROM user_stats) AS row_count,
             '{",".join(USER_STATS.schema().names)}' AS columns
      UNION ALL SELECT 'product_stats', (SELECT count(*) FROM product_stats), '{",".join(PRODUCT_STATS.schema().names)}'
      UNION ALL SELECT 'user_product_interactions', (SELECT count(*) FROM pair_stats), '{",".join(USER_PRODUCT.schema().names)}')
    """,
)
def sink_feature_group(t):
    run_ts = F.lit(RUN_TS).cast("timestamp")
    groups = {
        "user_stats": cleaning.to_feature_view(features.user_stats(t.event_log), USER_STATS, {}, run_ts),
        "product_stats": cleaning.to_feature_view(features.product_stats(t.event_log), PRODUCT_STATS, {}, run_ts),
        "user_product_interactions": cleaning.to_feature_view(
            features.user_product_stats(t.event_log), USER_PRODUCT, {}, run_ts
        ),
    }
    return sinks.write_feature_groups(groups, new_path(t.spark, "feature-groups"), run_ts)


@query(
    "reference_snapshot",
    """SELECT event_time, round(price, 6) AS price, product_id, hour, target FROM numeric_events
       WHERE event_time < TIMESTAMP '2024-01-16'""",
)
def reference_snapshot(t):
    """The first table saved stays the reference; the second call only reads it."""
    path = new_path(t.spark, "reference")
    sinks.reference_snapshot(t.reference, path)
    return sinks.reference_snapshot(t.current, path)


SUMMARY_SQL = """
    SELECT count(*) AS total_rows, min(event_time) AS first_event, max(event_time) AS last_event,
           count(DISTINCT user_id) AS unique_users, round(avg(price), 6) AS price_mean,
           round(stddev_samp(price), 6) AS price_std, round(min(price), 6) AS price_min, round(max(price), 6) AS price_max,
           round(quantile_cont(price, 0.5), 6) AS price_median,
           round(count(*) / count(DISTINCT user_id)::DOUBLE, 6) AS events_per_user
    FROM event_log
"""


@query("sink_json_report", SUMMARY_SQL)
def sink_json_report(t):
    """The nested data report, written as JSON and read back."""
    report = profile.dataset_summary(t.event_log).select(
        F.struct("total_rows", "first_event", "last_event").alias("data"),
        F.struct("unique_users", "events_per_user").alias("users"),
        F.struct("price_mean", "price_std", "price_min", "price_max", "price_median").alias("price"),
    ).withColumn("data", F.col("data").withField("first_event", F.col("data.first_event").cast("string"))
                 .withField("last_event", F.col("data.last_event").cast("string")))
    back = sinks.write_json_report(report, new_path(t.spark, "report"))
    return back.select("data.*", "users.*", "price.*").withColumns(
        {c: F.col(c).cast("timestamp") for c in ("first_event", "last_event")}
    )


BOARD_SQL = """
    SELECT model, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall,
           round(f1_score, 6) AS f1_score, round(roc_auc, 6) AS roc_auc, round(latency_ms, 6) AS latency_ms,
           CAST(row_number() OVER (ORDER BY roc_auc DESC, model) AS INT) AS rank
    FROM model_metrics
"""


@query("sink_leaderboard", BOARD_SQL)
def sink_leaderboard(t):
    board = ranking.leaderboard(metrics.model_metrics(t.scored))
    return sinks.write_leaderboard(board, new_path(t.spark, "leaderboard"))


@query("scan_incremental", "SELECT event_id, event_time, user_id, event_type, round(value, 6) AS value, k FROM all_events")
def scan_incremental(t):
    return collect_batches(event_stream(t.spark, t.sf_dir), "incremental").drop("batch_id")


PRESENT = ["event_id", "event_time", "event_type", "product_id", "price", "user_id", "user_session"]


@query(
    "schema_check",
    "\nUNION ALL ".join(
        f"SELECT '{f.name}' AS \"column\", '{f.dataType.simpleString()}' AS expected_type, "
        + (f"true AS present, count({f.name})" if f.name in PRESENT else "false AS present, count(*) * 0")
        + " AS filled_rows FROM event_log"
        for f in EVENTS.fields
    ),
)
def schema_check(t):
    return cleaning.schema_check(t.event_log, EVENTS)


# --- cleaning -----------------------------------------------------------------------

@query("dedup_rows", f"SELECT DISTINCT {SHOP_COLUMNS} FROM duplicated")
def dedup_rows(t):
    return cleaning.drop_duplicate_rows(t.duplicated_events)


@query(
    "dedup_report",
    """SELECT (SELECT count(*) FROM duplicated) AS rows_before, (SELECT count(*) FROM shop_events) AS rows_after,
              (SELECT count(*) FROM duplicated) - (SELECT count(*) FROM shop_events) AS removed""",
)
def dedup_report(t):
    return cleaning.duplicate_report(t.duplicated_events)


@query("dedup_entities", "SELECT DISTINCT user_id, date_trunc('hour', event_time) AS hour_start FROM event_log")
def dedup_entities(t):
    stamped = t.event_log.withColumn("hour_start", F.date_trunc("hour", "event_time"))
    return cleaning.distinct_entities(stamped, ["user_id"], "hour_start")


@query(
    "null_profile",
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS null_count, "
        f"round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 6) AS null_pct FROM shop_events"
        for c in EVENTS.names
    ),
)
def null_profile(t):
    return cleaning.null_profile(t.shop_events, EVENTS.names)


@query("fill_constant", "SELECT event_id, coalesce(brand, 'unknown') AS brand FROM shop_events")
def fill_constant(t):
    return cleaning.fill_constant(t.shop_events).select("event_id", "brand")


@query(
    "fill_median",
    "SELECT event_id, round(coalesce(price, (SELECT quantile_cont(price, 0.5) FROM event_log)), 6) AS price FROM event_log",
)
def fill_median(t):
    return cleaning.fill_median(t.event_log, ["price"]).select("event_id", "price")


@query(
    "impute_median_multi",
    """
    SELECT target_date, product_id,
           round(coalesce(avg_price, (SELECT quantile_cont(avg_price, 0.5) FROM trailing_stats)), 6) AS avg_price,
           round(coalesce(price_std, (SELECT quantile_cont(price_std, 0.5) FROM trailing_stats)), 6) AS price_std,
           round(CAST(views AS DOUBLE), 6) AS views
    FROM trailing_stats
    """,
)
def impute_median_multi(t):
    trailing = features.trailing_product_features(t.dated_events)
    return cleaning.fill_median(trailing, ["avg_price", "price_std", "views"]).select(
        "target_date", "product_id", "avg_price", "price_std", "views"
    )


@query("fill_zero", "SELECT event_id, round(coalesce(price, 0), 6) AS price FROM event_log")
def fill_zero(t):
    return cleaning.fill_zero(t.event_log, ["price"]).select("event_id", "price")


@query("drop_null_rows", f"SELECT {SHOP_COLUMNS} FROM shop_events WHERE price IS NOT NULL AND brand IS NOT NULL AND category_id IS NOT NULL AND product_id IS NOT NULL")
def drop_null_rows(t):
    return cleaning.drop_null_rows(t.shop_events)


@query("filter_event_type", f"SELECT {LOG_COLUMNS} FROM event_log WHERE event_type = 'purchase'")
def filter_event_type(t):
    return cleaning.of_type(t.events_of("purchase"), "purchase")


@query("filter_date_range", f"SELECT {LOG_COLUMNS}, event_date FROM dated WHERE event_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-12'")
def filter_date_range(t):
    return cleaning.in_time_range(t.dated_events, "2024-01-05", "2024-01-12")


@query("filter_recent", f"SELECT {LOG_COLUMNS} FROM event_log WHERE event_time > (SELECT t FROM newest) - INTERVAL 24 HOUR")
def filter_recent(t):
    return cleaning.recent(t.event_log, features.last_event_time(t.event_log), 24)


DEMAND_COLUMNS = """target_date, product_id, total_events, views, cart_adds, unique_users, round(avg_price, 6) AS avg_price,
       round(price_std, 6) AS price_std, unique_sessions, day_of_week, is_weekend, demand"""


@query("filter_positive_target", f"SELECT {DEMAND_COLUMNS} FROM demand_set WHERE demand > 0")
def filter_positive_target(t):
    return cleaning.positive(t.demand_set)


@query("label_purchase", "SELECT event_id, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS target FROM event_log")
def label_purchase(t):
    return t.event_log.select("event_id", X.purchase_label().alias("target"))


@query("label_has_demand", "SELECT target_date, product_id, CASE WHEN demand > 0 THEN 1 ELSE 0 END AS has_demand FROM demand_set")
def label_has_demand(t):
    return t.demand_set.select("target_date", "product_id", X.flag(F.col("demand") > 0).alias("has_demand"))


@query(
    "select_features",
    """SELECT round(price, 6) AS price, CAST(extract(hour FROM event_time) AS INT) AS hour,
              CAST(isodow(event_time) - 1 AS INT) AS day_of_week FROM event_log""",
)
def select_features(t):
    """The wanted features that the table has; the others are left out."""
    calendar = t.event_log.select(
        "*", F.hour("event_time").alias("hour"), X.day_of_week("event_time").alias("day_of_week")
    )
    return cleaning.select_existing(calendar, MODEL_FEATURES)


@query(
    "feature_schema_project",
    f"""
    SELECT user_id, event_timestamp, user_total_events, user_total_purchases, user_total_views, user_total_carts,
           round(user_avg_price, 6) AS user_avg_price, round(user_purchase_frequency, 6) AS user_purchase_frequency,
           user_session_count, days_since_last_activity, TIMESTAMP '{RUN_TS}' AS created_timestamp FROM user_stats
    """,
)
def feature_schema_project(t):
    raw = features.user_stats(t.event_log).withColumnsRenamed(
        {"event_timestamp": "last_activity", "user_total_events": "total_events"}
    )
    return cleaning.to_feature_view(
        raw,
        USER_STATS,
        {"last_activity": "event_timestamp", "total_events": "user_total_events"},
        F.lit(RUN_TS).cast("timestamp"),
    )


@query(
    "validate_requests",
    """
    SELECT request_id, TRY_CAST(user_id AS BIGINT) AS user_id, round(TRY_CAST(transaction_amount AS DOUBLE), 6) AS transaction_amount,
           concat_ws('; ', CASE WHEN TRY_CAST(user_id AS BIGINT) IS NULL THEN 'user_id not an integer' END,
                     CASE WHEN transaction_amount IS NULL THEN 'transaction_amount missing' END,
                     CASE WHEN TRY_CAST(transaction_amount AS DOUBLE) < 0 THEN 'transaction_amount negative' END) AS reasons
    FROM requests
    """,
)
def validate_requests(t):
    return cleaning.check_requests(t.requests).withColumn("reasons", F.array_join("reasons", "; "))


@query(
    "rejected_requests",
    """
    SELECT request_id,
           concat_ws('; ', CASE WHEN TRY_CAST(user_id AS BIGINT) IS NULL THEN 'user_id not an integer' END,
                     CASE WHEN transaction_amount IS NULL THEN 'transaction_amount missing' END,
                     CASE WHEN TRY_CAST(transaction_amount AS DOUBLE) < 0 THEN 'transaction_amount negative' END) AS reason
    FROM requests WHERE request_id NOT IN (SELECT request_id FROM accepted)
    """,
)
def rejected_requests(t):
    return cleaning.rejected_requests(t.requests)
