"""Queries: scalar expressions over events, requests, scores and alerts."""

from pyspark.sql import functions as F

from ..functions import expressions as X
from ..functions import fixed_values as V
from ..operators import alerts, decisions, features, profile
from .registry import query
from .views_sql import case_lookup, quote


@query(
    "calendar_parts",
    """SELECT event_id, CAST(extract(hour FROM event_time) AS INT) AS hour, CAST(isodow(event_time) - 1 AS INT) AS day_of_week,
              CAST(extract(day FROM event_time) AS INT) AS day_of_month, CAST(event_time AS DATE) AS event_date FROM event_log""",
)
def calendar_parts(t):
    return t.event_log.select(
        "event_id",
        F.hour("event_time").alias("hour"),
        X.day_of_week("event_time").alias("day_of_week"),
        F.dayofmonth("event_time").alias("day_of_month"),
        F.to_date("event_time").alias("event_date"),
    )


@query("is_weekend", "SELECT event_id, CASE WHEN isodow(event_time) >= 6 THEN 1 ELSE 0 END AS is_weekend FROM event_log")
def is_weekend(t):
    return t.event_log.select("event_id", X.is_weekend("event_time").alias("is_weekend"))


@query(
    "hour_cyclic",
    """SELECT event_id, round(sin(2 * pi() * extract(hour FROM event_time) / 24), 6) + 0.0::DOUBLE AS hour_sin,
              round(cos(2 * pi() * extract(hour FROM event_time) / 24), 6) + 0.0::DOUBLE AS hour_cos FROM event_log""",
)
def hour_cyclic(t):
    hour = F.hour("event_time")
    return t.event_log.select(
        "event_id", X.hour_sin(hour).alias("hour_sin"), X.hour_cos(hour).alias("hour_cos")
    )


@query("price_normalized", "SELECT event_id, round(price / (SELECT max(price) FROM event_log), 6) AS price_normalized FROM event_log")
def price_normalized(t):
    top = t.event_log.agg(F.max("price")).scalar()
    return t.event_log.select("event_id", F.try_divide(F.col("price"), top).alias("price_normalized"))


AFFINITY_SQL = """coalesce(user_product_view_count, 0)
    / sqrt(CAST(coalesce(user_total_views, 1) AS DOUBLE) * coalesce(product_total_views, 1) + 1)"""
PRICE_SHARE_SQL = "price / (SELECT max(price) FROM on_demand_inputs)"
COMPOSITE_SQL = f"""0.3::DOUBLE * coalesce(user_purchase_frequency, 0) + 0.3::DOUBLE * coalesce(product_view_to_purchase_rate, 0)
    + 0.2::DOUBLE * ({AFFINITY_SQL}) + 0.2::DOUBLE * (1 - {PRICE_SHARE_SQL})"""


@query("user_product_affinity", f"SELECT event_id, round({AFFINITY_SQL}, 6) AS affinity FROM on_demand_inputs")
def user_product_affinity(t):
    return t.on_demand_inputs.select(
        "event_id",
        X.affinity("user_product_view_count", "user_total_views", "product_total_views").alias("affinity"),
    )


@query("composite_score", f"SELECT event_id, round({COMPOSITE_SQL}, 6) AS composite_score FROM on_demand_inputs")
def composite_score(t):
    return features.on_demand_features(t.on_demand_inputs).select("event_id", "composite_score")


@query(
    "on_demand_features",
    f"""
    SELECT event_id, round(sin(2 * pi() * hour / 24), 6) + 0.0::DOUBLE AS hour_sin, round(cos(2 * pi() * hour / 24), 6) + 0.0::DOUBLE AS hour_cos,
           CASE WHEN day_of_week >= 5 THEN 1 ELSE 0 END AS is_weekend, round({PRICE_SHARE_SQL}, 6) AS price_normalized,
           round({AFFINITY_SQL}, 6) AS user_product_affinity, round({COMPOSITE_SQL}, 6) AS composite_score
    FROM on_demand_inputs
    """,
)
def on_demand_features(t):
    return t.on_demand_inputs.transform(features.on_demand_features).select(
        "event_id", "hour_sin", "hour_cos", "is_weekend", "price_normalized",
        "user_product_affinity", "composite_score",
    )


@query("popularity_score", "SELECT product_id, round(product_popularity_score, 6) AS product_popularity_score FROM product_stats")
def popularity_score(t):
    return features.product_stats(t.event_log).select("product_id", "product_popularity_score")


@query("preference_score", "SELECT user_id, product_id, round(user_product_preference_score, 6) AS user_product_preference_score FROM pair_stats")
def preference_score(t):
    return features.user_product_stats(t.event_log).select(
        "user_id", "product_id", "user_product_preference_score"
    )


@query("conversion_rate", "SELECT product_id, round(product_view_to_purchase_rate, 6) AS product_view_to_purchase_rate FROM product_stats")
def conversion_rate(t):
    return features.product_stats(t.event_log).select("product_id", "product_view_to_purchase_rate")


@query("purchase_rate", "SELECT user_id, round(user_purchase_rate, 6) AS user_purchase_rate FROM user_price_stats")
def purchase_rate(t):
    return features.user_price_stats(t.event_log).select("user_id", "user_purchase_rate")


@query("recency_days", "SELECT user_id, days_since_last_activity FROM user_stats")
def recency_days(t):
    return features.user_stats(t.event_log).select("user_id", "days_since_last_activity")


@query("recency_hours", "SELECT user_id, product_id, round(user_product_last_interaction_hours, 6) AS hours FROM pair_stats")
def recency_hours(t):
    return features.user_product_stats(t.event_log).select(
        "user_id", "product_id", F.col("user_product_last_interaction_hours").alias("hours")
    )


@query(
    "log1p_expm1",
    """SELECT event_id, round(ln(1 + price), 6) AS log_price, round(exp(ln(1 + price)) - 1, 6) AS price_back FROM event_log""",
)
def log1p_expm1(t):
    return t.event_log.select(
        "event_id", F.log1p("price").alias("log_price"), F.expm1(F.log1p("price")).alias("price_back")
    )


@query(
    "price_brand_interaction",
    """
    SELECT e.event_id, round(e.price * f.freq, 6) AS price_brand_interaction FROM shop_events e
    LEFT JOIN (SELECT brand, count(*) / (SELECT count(brand) FROM shop_events)::DOUBLE AS freq
               FROM shop_events WHERE brand IS NOT NULL GROUP BY brand) f ON f.brand = e.brand
    """,
)
def price_brand_interaction(t):
    return features.frequency_encode(t.shop_events, ["brand"]).select(
        "event_id", (F.col("price") * F.col("brand_freq")).alias("price_brand_interaction")
    )


@query(
    "class_weights",
    """
    WITH c AS (SELECT CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS target, count(*) AS n FROM event_log GROUP BY 1)
    SELECT target, n, round((SELECT sum(n) FROM c)::DOUBLE / ((SELECT count(*) FROM c) * n), 6) AS balanced_weight,
           round((SELECT n FROM c WHERE target = 0) / (SELECT n FROM c WHERE target = 1)::DOUBLE, 6) AS positive_weight FROM c
    """,
)
def class_weights(t):
    return features.class_weights(t.event_log.select(X.purchase_label().alias("target")))


@query("threshold_predict", "SELECT event_id, model, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS prediction FROM scored")
def threshold_predict(t):
    return t.scored.select("event_id", "model", X.above_half("score").alias("prediction"))


@query(
    "discrepancy_bucket",
    """SELECT event_id, round(absolute_difference, 6) AS absolute_difference, round(relative_difference, 6) AS relative_difference,
              discrepancy_type, production_binary, shadow_binary, binary_mismatch FROM comparison""",
)
def discrepancy_bucket(t):
    return decisions.compare_scores(t.predictions, "a", "b").select(
        "event_id", "absolute_difference", "relative_difference", "discrepancy_type",
        "production_binary", "shadow_binary", "binary_mismatch",
    )


@query(
    "error_category",
    """
    SELECT c.category, count(f.request_id) AS n
    FROM (VALUES ('timeout'), ('connection_error'), ('server_error'), ('client_error'), ('other')) AS c(category)
    LEFT JOIN (SELECT request_id, CASE WHEN contains(lower(message), 'timeout') THEN 'timeout'
                 WHEN contains(lower(message), 'connection') THEN 'connection_error'
                 WHEN status // 100 = 5 THEN 'server_error' WHEN status // 100 = 4 THEN 'client_error' ELSE 'other' END AS category
               FROM failed) f ON f.category = c.category
    GROUP BY c.category
    """,
)
def error_category(t):
    return profile.error_counts(t.failed_requests, V.ERROR_CATEGORIES)


@query(
    "alert_advice",
    f"""SELECT alert_id, type, level, {case_lookup('type', V.ADVICE, V.DEFAULT_ADVICE)} AS advice,
               {case_lookup('level', V.LEVEL_COLOURS, V.DEFAULT_COLOUR)} AS colour FROM alerts""",
)
def alert_advice(t):
    return alerts.alert_advice(t.alerts)


_LINE = "chr(10)"


@query(
    "alert_message",
    f"""
    SELECT alert_id,
      {quote(V.ALERT_TITLE)} || {_LINE} || {_LINE} || {quote(V.TIME_LABEL)} || strftime(alert_time, '%Y-%m-%d %H:%M:%S') || {_LINE}
      || {quote(V.LEVEL_LABEL)} || level || {_LINE} || {quote(V.TYPE_LABEL)} || type || {_LINE}
      || {quote(V.MESSAGE_LABEL)} || message || {_LINE} || {_LINE}
      || CASE WHEN metric IS NULL THEN '' ELSE
           {quote(V.METRIC_LABEL)} || metric || {_LINE} || {quote(V.VALUE_LABEL)} || CAST(value AS VARCHAR) || {_LINE}
           || {quote(V.THRESHOLD_LABEL)} || CAST(threshold AS VARCHAR) || {_LINE} || {_LINE} END
      || {quote(V.CONTEXT_LABEL)} || {_LINE} || '  user_id: ' || CAST(user_id AS VARCHAR) || {_LINE} || {_LINE}
      || {quote(V.ADVICE_LABEL)} || {_LINE} || {case_lookup('type', V.ADVICE, V.DEFAULT_ADVICE)} AS text
    FROM alerts
    """,
)
def alert_message(t):
    return alerts.alert_message(t.alerts)
