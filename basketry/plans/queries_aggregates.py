"""Queries: distributions, summaries, entity features, request-log figures."""

from pyspark.sql import functions as F

from ..functions import expressions as X
from ..operators import decisions, features, joins, prefix, profile
from .queries_tables import DEMAND_COLUMNS, SUMMARY_SQL
from .registry import query


@query(
    "event_distribution",
    """SELECT event_type, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM event_log), 6) AS pct
       FROM event_log GROUP BY event_type""",
)
def event_distribution(t):
    return profile.event_distribution(t.event_log)


@query(
    "distinct_counts",
    """SELECT count(*) AS total_rows, count(DISTINCT user_id) AS unique_user_id, count(DISTINCT product_id) AS unique_product_id,
              count(DISTINCT category_id) AS unique_category_id, count(DISTINCT brand) AS unique_brand FROM shop_events""",
)
def distinct_counts(t):
    return profile.distinct_counts(t.shop_events, ["user_id", "product_id", "category_id", "brand"])


@query("dataset_summary", SUMMARY_SQL)
def dataset_summary(t):
    return profile.dataset_summary(t.event_log)


@query("hourly_activity", "SELECT CAST(extract(hour FROM event_time) AS INT) AS hour, count(*) AS n FROM event_log GROUP BY 1")
def hourly_activity(t):
    return profile.hourly_activity(t.event_log)


@query(
    "weekday_activity",
    """SELECT CAST(d AS INT) AS day_of_week, count(event_id) AS n FROM range(7) AS days(d)
       LEFT JOIN event_log ON isodow(event_time) - 1 = d GROUP BY 1""",
)
def weekday_activity(t):
    return profile.weekday_activity(t.event_log)


@query(
    "daily_activity",
    """SELECT event_date, count(*) FILTER (event_type = 'purchase') AS purchases, count(*) FILTER (event_type = 'view') AS views
       FROM dated GROUP BY event_date""",
)
def daily_activity(t):
    return profile.daily_activity(t.event_log)


def _histogram_sql(values: str) -> str:
    return f"""
    WITH v AS ({values}), l AS (SELECT min(v) AS lo, max(v) AS hi FROM v)
    SELECT b AS bin, round(lo + b * ((hi - lo) / 50), 6) AS bin_start, round(lo + (b + 1) * ((hi - lo) / 50), 6) AS bin_end, count(*) AS n
    FROM (SELECT lo, hi, CASE WHEN lo = hi THEN 0 ELSE CAST(least(floor((v - lo) / ((hi - lo) / 50)), 49) AS INT) END AS b FROM v, l)
    GROUP BY b, lo, hi
    """


@query("price_log_histogram", _histogram_sql("SELECT ln(1 + price) AS v FROM event_log WHERE price > 0"))
def price_log_histogram(t):
    return profile.price_log_histogram(t.event_log)


@query("events_per_user_histogram", _histogram_sql("SELECT CAST(count(*) AS DOUBLE) AS v FROM event_log GROUP BY user_id"))
def events_per_user_histogram(t):
    return profile.events_per_key_histogram(t.event_log, "user_id")


@query(
    "user_activity_segments",
    """SELECT CASE WHEN n = 1 THEN '1 event' WHEN n <= 3 THEN '2-3 events' ELSE 'more than 3' END AS segment, count(*) AS users
       FROM (SELECT count(*) AS n FROM event_log GROUP BY user_id) GROUP BY 1""",
)
def user_activity_segments(t):
    return profile.activity_segments(t.event_log, "user_id")


@query(
    "price_box_stats",
    """
    WITH q AS (SELECT event_type, quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.5) AS median, quantile_cont(price, 0.75) AS q3
               FROM event_log WHERE price IS NOT NULL GROUP BY event_type),
    f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
    SELECT event_type, round(min(price), 6) AS min, round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median,
           round(any_value(q3), 6) AS q3, round(max(price), 6) AS max,
           round(min(price) FILTER (price BETWEEN lo AND hi), 6) AS whisker_low,
           round(max(price) FILTER (price BETWEEN lo AND hi), 6) AS whisker_high,
           count(*) FILTER (NOT price BETWEEN lo AND hi) AS outliers
    FROM event_log JOIN f USING (event_type) WHERE price IS NOT NULL GROUP BY event_type
    """,
)
def price_box_stats(t):
    return profile.box_stats(t.event_log)


CORRELATED = ["price", "product_id", "hour", "target"]


@query(
    "correlation_matrix",
    "\nUNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS corr FROM numeric_events"
        for a in CORRELATED
        for b in CORRELATED
    ),
)
def correlation_matrix(t):
    return profile.correlation_matrix(t.numeric_events, CORRELATED)


@query(
    "user_stats",
    """SELECT user_id, event_timestamp, user_total_events, user_total_purchases, user_total_views, user_total_carts,
              round(user_avg_price, 6) AS user_avg_price, round(user_purchase_frequency, 6) AS user_purchase_frequency,
              user_session_count, days_since_last_activity FROM user_stats""",
)
def user_stats(t):
    return features.user_stats(t.event_log)


@query(
    "user_event_pivot",
    """SELECT user_id, count(*) FILTER (event_type = 'view') AS view, count(*) FILTER (event_type = 'cart') AS cart,
              count(*) FILTER (event_type = 'purchase') AS purchase FROM event_log GROUP BY user_id""",
)
def user_event_pivot(t):
    return features.user_event_pivot(t.event_log)


@query(
    "product_stats",
    """SELECT product_id, event_timestamp, product_total_views, product_total_purchases, product_total_carts,
              round(product_avg_price, 6) AS product_avg_price, round(product_view_to_purchase_rate, 6) AS product_view_to_purchase_rate,
              round(product_popularity_score, 6) AS product_popularity_score, days_since_last_view FROM product_stats""",
)
def product_stats(t):
    return features.product_stats(t.event_log)


@query(
    "user_product_stats",
    """SELECT user_id, product_id, event_timestamp, user_product_view_count, user_product_cart_count, user_product_purchase_count,
              round(user_product_last_interaction_hours, 6) AS user_product_last_interaction_hours,
              round(user_product_preference_score, 6) AS user_product_preference_score FROM pair_stats""",
)
def user_product_stats(t):
    return features.user_product_stats(t.event_log)


@query(
    "user_price_stats",
    """SELECT user_id, round(user_price_mean, 6) AS user_price_mean, round(user_price_std, 6) AS user_price_std,
              user_event_count, user_purchase_count, round(user_purchase_rate, 6) AS user_purchase_rate FROM user_price_stats""",
)
def user_price_stats(t):
    return features.user_price_stats(t.event_log)


def _freq_sql(c: str) -> str:
    return f"""(SELECT {c}, count(*) / (SELECT count({c}) FROM shop_events)::DOUBLE AS freq
                FROM shop_events WHERE {c} IS NOT NULL GROUP BY {c})"""


@query(
    "frequency_encoding",
    f"""
    SELECT e.event_id, round(b.freq, 6) AS brand_freq, round(c.freq, 6) AS category_id_freq, round(p.freq, 6) AS product_id_freq
    FROM shop_events e LEFT JOIN {_freq_sql('brand')} b ON b.brand = e.brand
    LEFT JOIN {_freq_sql('category_id')} c ON c.category_id = e.category_id
    LEFT JOIN {_freq_sql('product_id')} p ON p.product_id = e.product_id
    """,
)
def frequency_encoding(t):
    return features.frequency_encode(t.shop_events, features.ENCODED).select(
        "event_id", "brand_freq", "category_id_freq", "product_id_freq"
    )


PANEL_COLUMNS = """product_id, event_date, total_views, total_carts, total_purchases, round(price_mean, 6) AS price_mean,
       round(price_std, 6) AS price_std, unique_users"""


@query("daily_product_stats", f"SELECT {PANEL_COLUMNS} FROM panel")
def daily_product_stats(t):
    return features.daily_product_stats(t.dated_events)


@query("daily_demand", "SELECT event_date, product_id, demand FROM daily_demand")
def daily_demand(t):
    return features.daily_demand(t.dated_events)


@query(
    "trailing_product_features",
    """SELECT target_date, product_id, total_events, views, cart_adds, unique_users, round(avg_price, 6) AS avg_price,
              round(price_std, 6) AS price_std, unique_sessions FROM trailing_stats""",
)
def trailing_product_features(t):
    return features.trailing_product_features(t.dated_events)


def _trailing_sql(days: int) -> str:
    return f"""
    WITH d AS (SELECT event_date AS target_date, lag(event_date, {days}) OVER (ORDER BY event_date) AS hs,
                      lag(event_date, 1) OVER (ORDER BY event_date) AS he FROM (SELECT DISTINCT event_date FROM daily_demand))
    SELECT target_date, product_id, count(*) AS total_events, count(*) FILTER (event_type = 'view') AS views,
           count(*) FILTER (event_type = 'cart') AS cart_adds, count(DISTINCT user_id) AS unique_users,
           round(avg(price), 6) AS avg_price, round(stddev_samp(price), 6) AS price_std, count(DISTINCT user_session) AS unique_sessions
    FROM dated JOIN d ON event_date BETWEEN hs AND he GROUP BY target_date, product_id
    """


@query("trailing_product_features_3d", _trailing_sql(3))
def trailing_product_features_3d(t):
    return features.trailing_product_features(t.dated_events, target_days=3)


@query("trailing_product_features_28d", _trailing_sql(28))
def trailing_product_features_28d(t):
    """A window of four weeks of days with purchases."""
    return features.trailing_product_features(t.dated_events, target_days=28)


@query("demand_dataset", f"SELECT {DEMAND_COLUMNS} FROM demand_set")
def demand_dataset(t):
    return t.demand_set


@query(
    "class_balance",
    """SELECT CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS target, count(*) AS n,
              round(count(*) / (SELECT count(*) FROM event_log)::DOUBLE, 6) AS share FROM event_log GROUP BY 1""",
)
def class_balance(t):
    return profile.class_balance(t.event_log.select(X.purchase_label().alias("target")))


@query(
    "target_profile",
    """SELECT round(avg(CASE WHEN demand = 0 THEN 1.0 ELSE 0.0 END), 6) AS zero_share, min(demand) FILTER (demand > 0) AS positive_min,
              max(demand) FILTER (demand > 0) AS positive_max, round(avg(demand) FILTER (demand > 0), 6) AS positive_mean FROM demand_set""",
)
def target_profile(t):
    return profile.target_profile(t.demand_set)


DESCRIBED = ["total_events", "views", "cart_adds", "unique_users", "avg_price", "price_std", "demand"]


@query(
    "describe_features",
    "\nUNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
            round(CAST(min({c}) AS DOUBLE), 6) AS min, round(CAST(max({c}) AS DOUBLE), 6) AS max,
            round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q25, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS q50,
            round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q75 FROM demand_set"""
        for c in DESCRIBED
    ),
)
def describe_features(t):
    return profile.describe(t.demand_set, DESCRIBED)


ONLINE_FEATURES = [
    "avg_purchase_amount", "purchase_frequency", "days_since_last_purchase", "total_purchases", "total_events",
    "total_views", "total_carts", "session_count", "avg_price", "price_std", "max_price", "cart_conversion",
]


@query(
    "feature_store_stats",
    f"""SELECT count(*) AS total_users, {len(ONLINE_FEATURES)} AS feature_count, '{",".join(ONLINE_FEATURES)}' AS features FROM online_users""",
)
def feature_store_stats(t):
    return profile.feature_store_stats(t.online_users, "user_id")


@query(
    "latency_summary",
    """SELECT model, count(latency) AS n, round(avg(latency), 6) AS mean, round(stddev_pop(latency), 6) AS std, round(min(latency), 6) AS min,
              round(max(latency), 6) AS max, round(quantile_cont(latency, 0.5), 6) AS p50, round(quantile_cont(latency, 0.95), 6) AS p95,
              round(quantile_cont(latency, 0.99), 6) AS p99 FROM scored GROUP BY model""",
)
def latency_summary(t):
    return profile.latency_summary(t.scored)


@query(
    "throughput",
    """SELECT model, count(*) AS requests,
              round(CASE WHEN count(*) < 2 OR min(event_time) = max(event_time) THEN 0.0
                    ELSE count(*) / (date_diff('microsecond', min(event_time), max(event_time)) / 1e6::DOUBLE) END, 6) AS requests_per_second
       FROM scored GROUP BY model""",
)
def throughput(t):
    return profile.throughput(t.scored)


@query(
    "error_rates",
    """SELECT count(*) AS total, count(*) FILTER (event_type = 'error') AS errors,
              round(count(*) FILTER (event_type = 'error') / 1000.0::DOUBLE, 6) AS errors_per_window,
              round(count(*) FILTER (event_type = 'error') / count(*)::DOUBLE, 6) AS error_rate,
              round(count(*) FILTER (event_type <> 'error') / count(*)::DOUBLE, 6) AS success_rate FROM events""",
)
def error_rates(t):
    return profile.error_rates(t.all_events, F.col("event_type") == "error")


@query(
    "block_throughput",
    """
    SELECT (seq // 100) AS block, count(*) AS n, round(count(*) / sum(latency), 6) AS requests_per_second
    FROM (SELECT row_number() OVER (ORDER BY ts, event_id) - 1 AS seq, value / 1000 AS latency FROM events) GROUP BY 1
    """,
)
def block_throughput(t):
    return profile.block_throughput(t.all_events, F.col("value") / 1000, "event_time", "event_id")


@query(
    "sequence_numbers",
    "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS seq FROM events",
)
def sequence_numbers(t):
    return prefix.sequence_numbers(t.all_events.select("event_id", "event_time"), "event_time", "event_id").select(
        "event_id", "seq"
    )


@query(
    "shadow_summary",
    """
    WITH r AS (SELECT * FROM comparison WHERE event_time > (SELECT max(ts) FROM events) - INTERVAL 240 HOUR),
    s AS (SELECT count(*) AS total_requests, count(*) FILTER (discrepancy_type = 'major') AS major_discrepancies,
                 count(*) FILTER (binary_mismatch = 1) AS binary_mismatches, avg(absolute_difference) AS avg_diff,
                 count(*) FILTER (discrepancy_type = 'major') / count(*)::DOUBLE AS major_rate,
                 count(*) FILTER (binary_mismatch = 1) / count(*)::DOUBLE AS mismatch_rate,
                 avg(la) AS pa, avg(lb) AS sa, quantile_cont(la, 0.95) AS pp, quantile_cont(lb, 0.95) AS sp FROM r)
    SELECT total_requests, major_discrepancies, binary_mismatches, round(avg_diff, 6) AS avg_absolute_difference,
           round(major_rate, 6) AS major_rate, round(mismatch_rate, 6) AS mismatch_rate,
           CASE WHEN major_rate < 0.01 AND mismatch_rate < 0.05 THEN 'ready_for_production'
                WHEN major_rate < 0.05 AND mismatch_rate < 0.1 THEN 'requires_further_testing'
                ELSE 'not_ready_high_discrepancy' END AS recommendation,
           round(pa, 6) AS production_avg_latency, round(sa, 6) AS shadow_avg_latency,
           round(pp, 6) AS production_p95_latency, round(sp, 6) AS shadow_p95_latency FROM s
    """,
)
def shadow_summary(t):
    from ..operators import cleaning

    as_of = t.all_events.agg(F.max("event_time")).scalar()
    recent = cleaning.recent(t.predictions, as_of, 240)
    return decisions.shadow_summary(decisions.compare_scores(recent, "a", "b"), "latency_a", "latency_b")


@query(
    "alert_summary",
    """
    WITH r AS (SELECT * FROM alerts WHERE alert_time > (SELECT max(alert_time) FROM alerts) - INTERVAL 24 HOUR)
    SELECT count(*) AS total, count(*) FILTER (level = 'CRITICAL') AS critical, count(*) FILTER (level = 'WARNING') AS warning,
           count(*) FILTER (level = 'INFO') AS info,
           (SELECT string_agg(type || ':' || n, ',' ORDER BY type) FROM (SELECT type, count(*) AS n FROM r GROUP BY type)) AS by_type,
           (SELECT string_agg(CAST(alert_id AS VARCHAR), ',' ORDER BY alert_time DESC, alert_id DESC)
            FROM (SELECT * FROM r ORDER BY alert_time DESC, alert_id DESC LIMIT 10)) AS latest_ids FROM r
    """,
)
def alert_summary(t):
    from ..operators import alerts, cleaning

    as_of = t.alerts.agg(F.max("alert_time")).scalar()
    return alerts.alert_summary(cleaning.recent(t.alerts, as_of, 24, "alert_time"))


@query(
    "check_pass_rate",
    """
    WITH c AS (SELECT a.user_id, a.user_avg_price = b.user_price_mean OR abs(a.user_avg_price - b.user_price_mean) <= 1e-5 * abs(b.user_price_mean) AS p,
                      abs(a.user_total_events - b.user_event_count) <= 1e-5 * abs(b.user_event_count) AS q
               FROM user_stats a JOIN user_price_stats b USING (user_id)),
    o AS (SELECT p AS passed FROM c UNION ALL SELECT q FROM c)
    SELECT count(*) AS total, count(*) FILTER (passed) AS passed, count(*) - count(*) FILTER (passed) AS failed,
           round(count(*) FILTER (passed) * 100.0::DOUBLE / count(*), 6) AS pass_pct FROM o
    """,
)
def check_pass_rate(t):
    """Two independently computed user tables: prices agree, event counts need not."""
    a = features.user_stats(t.event_log).select(
        "user_id", F.col("user_avg_price").alias("price"), F.col("user_total_events").alias("events")
    )
    b = features.user_price_stats(t.event_log).select(
        "user_id", F.col("user_price_mean").alias("price"), F.col("user_event_count").alias("events")
    )
    return profile.check_pass_rate(joins.consistency_check(a, b, ["user_id"], ["price", "events"]))
