"""Queries: joins, as-of retrieval, windows, top-k, set operations."""

from pyspark.sql import functions as F

from ..operators import features, joins, metrics, ranking
from ..schemas import EVENTS, FeatureView
from ..sources.tables import Tables
from .queries_aggregates import ONLINE_FEATURES, PANEL_COLUMNS
from .queries_tables import BOARD_SQL, LOG_COLUMNS
from .registry import query

USER_DAILY = ["user_views", "user_carts", "user_purchases", "user_avg_price"]
PRODUCT_DAILY = ["product_views", "product_carts", "product_purchases", "product_avg_price"]
PAIR_DAILY = ["pair_views", "pair_carts", "pair_purchases", "pair_avg_price"]


# --- joins ---------------------------------------------------------------------

@query(
    "attach_user_stats",
    """SELECT e.event_id, e.user_id, round(user_price_mean, 6) AS user_price_mean, round(user_price_std, 6) AS user_price_std,
              user_event_count, user_purchase_count, round(user_purchase_rate, 6) AS user_purchase_rate
       FROM event_log e LEFT JOIN user_price_stats u USING (user_id)""",
)
def attach_user_stats(t):
    return features.attach_user_stats(t.event_log).select(
        "event_id", "user_id", "user_price_mean", "user_price_std", "user_event_count",
        "user_purchase_count", "user_purchase_rate",
    )


@query(
    "merge_feature_parts",
    """SELECT user_id, user_session_count, user_total_views AS view, user_total_carts AS cart, user_total_purchases AS purchase FROM user_stats""",
)
def merge_feature_parts(t):
    sessions = t.event_log.groupBy("user_id").agg(F.count_distinct("user_session").alias("user_session_count"))
    return joins.merge_parts(sessions, features.user_event_pivot(t.event_log), ["user_id"])


@query(
    "merge_left_fill",
    """SELECT p.product_id, p.last_view, coalesce(c.carts, 0) AS carts
       FROM (SELECT product_id, max(event_time) AS last_view FROM event_log GROUP BY product_id) p
       LEFT JOIN (SELECT product_id, count(*) AS carts FROM event_log WHERE event_type = 'cart' GROUP BY product_id) c USING (product_id)""",
)
def merge_left_fill(t):
    products = t.event_log.groupBy("product_id").agg(F.max("event_time").alias("last_view"))
    carts = t.events_of("cart").groupBy("product_id").agg(F.count(F.lit(1)).alias("carts"))
    return joins.merge_left_fill(products, carts, ["product_id"])


MOVING_SQL = """
    SELECT product_id, event_date, avg(total_views) OVER w AS views_7d_avg, avg(total_purchases) OVER w AS purchases_7d_avg,
           avg(total_carts) OVER w AS carts_7d_avg
    FROM panel WINDOW w AS (PARTITION BY product_id ORDER BY event_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
"""


@query(
    "merge_daily_moving",
    f"""SELECT {PANEL_COLUMNS}, round(views_7d_avg, 6) AS views_7d_avg, round(purchases_7d_avg, 6) AS purchases_7d_avg,
               round(carts_7d_avg, 6) AS carts_7d_avg FROM panel JOIN ({MOVING_SQL}) m USING (product_id, event_date)""",
)
def merge_daily_moving(t):
    panel = features.daily_product_stats(t.dated_events)
    return features.merge_daily_moving(panel, features.moving_averages(panel))


@query(
    "lookup_join",
    """SELECT e.event_id, e.category_id, round(c.freq, 6) AS freq FROM shop_events e
       LEFT JOIN (SELECT category_id, count(*) / (SELECT count(category_id) FROM shop_events)::DOUBLE AS freq
                  FROM shop_events GROUP BY category_id) c ON c.category_id = e.category_id""",
)
def lookup_join(t):
    """The same lookup through the split path: hot values broadcast, others shuffled."""
    lookup = features.value_frequencies(t.shop_events, "category_id")
    return joins.attach(t.shop_events, lookup, "category_id", "n").select(
        "event_id", "category_id", "freq"
    )


def _top_sql(c: str) -> str:
    return f"""(SELECT {c} FROM (SELECT {c}, count(*) AS n FROM shop_events WHERE {c} IS NOT NULL GROUP BY {c}
                ORDER BY n DESC, {c} LIMIT 20))"""


@query(
    "popular_flag",
    "SELECT event_id, "
    + ", ".join(
        f"CASE WHEN {c} IN {_top_sql(c)} THEN 1 ELSE 0 END AS {c}_is_popular" for c in features.ENCODED
    )
    + " FROM shop_events",
)
def popular_flag(t):
    return features.popular_flags(t.shop_events, features.ENCODED).select(
        "event_id", *[f"{c}_is_popular" for c in features.ENCODED]
    )


def _view(name: str, keys: tuple[str, ...], ttl_days: int, names: list[str]) -> FeatureView:
    return FeatureView(name, keys, ttl_days, tuple((n, None) for n in names))


def _asof_sql(left: str, table: str, keys: list[str], names: list[str], days: int) -> str:
    on = " AND ".join(f"l.{k} = f.{k}" for k in keys)
    fresh = f"date_diff('microsecond', f.event_timestamp, l.event_timestamp) <= {days * 86400} * 1000000::BIGINT"
    picked = ", ".join(f"CASE WHEN {fresh} THEN f.{n} END AS {n}" for n in names)
    return f"""(SELECT l.*, {picked} FROM {left} l ASOF LEFT JOIN {table} f
                ON {on} AND l.event_timestamp >= f.event_timestamp)"""


PURCHASES_SQL = "(SELECT event_id, user_id, product_id, event_time AS event_timestamp FROM event_log WHERE event_type = 'purchase')"


@query(
    "pit_join",
    f"""
    SELECT event_id, user_id, product_id, event_timestamp, user_views, user_carts, user_purchases, round(user_avg_price, 6) AS user_avg_price,
           product_views, product_carts, product_purchases, round(product_avg_price, 6) AS product_avg_price,
           pair_views, pair_carts, pair_purchases, round(pair_avg_price, 6) AS pair_avg_price
    FROM {_asof_sql(_asof_sql(_asof_sql(PURCHASES_SQL, 'daily_user', ['user_id'], USER_DAILY, 7),
                              'daily_product', ['product_id'], PRODUCT_DAILY, 7),
                    'daily_pair', ['user_id', 'product_id'], PAIR_DAILY, 30)}
    """,
)
def pit_join(t: Tables):
    return joins.historical_features(
        t.purchases,
        [
            (_view("user", ("user_id",), 7, USER_DAILY), t.daily_user_features),
            (_view("product", ("product_id",), 7, PRODUCT_DAILY), t.daily_product_features),
            (_view("pair", ("user_id", "product_id"), 30, PAIR_DAILY), t.daily_pair_features),
        ],
    )


@query(
    "online_lookup",
    """
    SELECT c.user_id, user_views, round(user_avg_price, 6) AS user_avg_price
    FROM (SELECT c_custkey AS user_id FROM customer) c
    LEFT JOIN (SELECT * FROM daily_user WHERE event_timestamp <= TIMESTAMP '2024-01-31'
               QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp DESC, created_timestamp DESC) = 1) o USING (user_id)
    """,
)
def online_lookup(t):
    online = joins.online_table(t.daily_user_features, ["user_id"], end=F.lit("2024-01-31").cast("timestamp"))
    users = t.raw("customer").select(F.col("c_custkey").alias("user_id"))
    return joins.online_lookup(users, online, ["user_id"], ["user_views", "user_avg_price"])


def _default_sql(names: list[str]) -> str:
    return ", ".join(
        f"round(CASE WHEN u.user_id IS NOT NULL THEN CAST(u.{n} AS DOUBLE) ELSE (SELECT avg({n}) FROM online_users) END, 6) AS {n}"
        for n in names
    )


@query(
    "lookup_default_mean",
    f"""SELECT c.user_id, {_default_sql(ONLINE_FEATURES)}, CASE WHEN u.user_id IS NULL THEN 1 ELSE 0 END AS is_default
        FROM (SELECT c_custkey AS user_id FROM customer) c LEFT JOIN online_users u ON u.user_id = c.user_id""",
)
def lookup_default_mean(t):
    users = t.raw("customer").select(F.col("c_custkey").alias("user_id"))
    return joins.lookup_default_mean(users, t.online_users, "user_id")


@query(
    "enrich_requests",
    f"""SELECT r.request_id, r.user_id, {_default_sql(ONLINE_FEATURES)}, round(r.transaction_amount, 6) AS transaction_amount,
               CASE WHEN u.user_id IS NULL THEN 1 ELSE 0 END AS is_default
        FROM accepted r LEFT JOIN online_users u ON u.user_id = r.user_id""",
)
def enrich_requests(t):
    return joins.enrich_requests(t.requests, t.online_users)


@query(
    "consistency_check",
    """
    WITH a AS (SELECT user_id, user_avg_price AS price, CAST(user_total_events AS DOUBLE) AS events FROM user_stats),
    b AS (SELECT user_id, user_price_mean AS price, CAST(user_event_count AS DOUBLE) AS events FROM user_price_stats),
    l AS (SELECT user_id, 'price' AS feature, a.price AS offline, b.price AS online FROM a FULL JOIN b USING (user_id)
          UNION ALL SELECT user_id, 'events', a.events, b.events FROM a FULL JOIN b USING (user_id))
    SELECT user_id, feature, round(offline, 6) AS offline, round(online, 6) AS online, round(abs(offline - online), 6) AS difference,
           CASE WHEN offline IS NULL AND online IS NULL THEN true WHEN offline IS NULL OR online IS NULL THEN false
                ELSE abs(offline - online) <= 0.01 + 1e-5 * abs(online) END AS passed FROM l
    """,
)
def consistency_check(t):
    """Statistics over all events against those over priced events, for every user."""
    a = features.user_stats(t.event_log).select(
        "user_id", F.col("user_avg_price").alias("price"), F.col("user_total_events").alias("events")
    )
    b = features.user_price_stats(t.event_log).select(
        "user_id", F.col("user_price_mean").alias("price"), F.col("user_event_count").alias("events")
    )
    return joins.consistency_check(a, b, ["user_id"], ["price", "events"], atol=0.01)


@query(
    "cold_flags",
    """SELECT c.user_id, coalesce(n, 0) AS event_count, CASE WHEN coalesce(n, 0) < 3 THEN 1 ELSE 0 END AS is_cold
       FROM (SELECT c_custkey AS user_id FROM customer) c
       LEFT JOIN (SELECT user_id, count(*) AS n FROM event_log GROUP BY user_id) e USING (user_id)""",
)
def cold_flags(t):
    users = t.raw("customer").select(F.col("c_custkey").alias("user_id"))
    return joins.cold_flags(users, t.event_log, "user_id")


@query(
    "cold_products",
    """SELECT p.product_id, coalesce(n, 0) AS event_count, CASE WHEN coalesce(n, 0) < 3 THEN 1 ELSE 0 END AS is_cold
       FROM (SELECT p_partkey AS product_id FROM part) p
       LEFT JOIN (SELECT product_id, count(*) AS n FROM event_log GROUP BY product_id) e USING (product_id)""",
)
def cold_products(t):
    return joins.cold_flags(t.catalog.select("product_id"), t.event_log, "product_id")


# --- windows ----------------------------------------------------------------------

@query(
    "moving_avg_7",
    f"""SELECT product_id, event_date, round(views_7d_avg, 6) AS views_7d_avg, round(purchases_7d_avg, 6) AS purchases_7d_avg,
               round(carts_7d_avg, 6) AS carts_7d_avg FROM ({MOVING_SQL})""",
)
def moving_avg_7(t):
    return features.moving_averages(features.daily_product_stats(t.dated_events))


@query(
    "online_table",
    """SELECT user_id, user_views, user_carts, user_purchases, round(user_avg_price, 6) AS user_avg_price, event_timestamp, created_timestamp
       FROM daily_user WHERE event_timestamp BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-20'
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp DESC, created_timestamp DESC) = 1""",
)
def online_table(t):
    return joins.online_table(
        t.daily_user_features,
        ["user_id"],
        F.lit("2024-01-01").cast("timestamp"),
        F.lit("2024-01-20").cast("timestamp"),
    )


@query("lagged_demand_dates", "SELECT target_date, history_start, history_end FROM demand_dates")
def lagged_demand_dates(t):
    return features.lagged_demand_dates(t.dated_events)


@query(
    "last_n_per_group",
    """SELECT event_id, event_time, y, model, round(score, 6) AS score, round(latency, 6) AS latency FROM scored
       QUALIFY row_number() OVER (PARTITION BY model ORDER BY event_time DESC, event_id DESC) <= 100""",
)
def last_n_per_group(t):
    return ranking.last_n_per_group(t.scored, "model", 100, "event_time", "event_id")


@query(
    "latest_per_product",
    f"""SELECT {PANEL_COLUMNS} FROM panel QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY event_date DESC) = 1""",
)
def latest_per_product(t):
    return ranking.latest_per_key(features.daily_product_stats(t.dated_events), "product_id", "event_date")


@query(
    "interval_since_last",
    """SELECT event_id, user_id, lag(event_time) OVER w AS previous_at,
              CAST(floor(date_diff('microsecond', lag(event_time) OVER w, event_time) / 86400e6::DOUBLE) AS BIGINT) AS days_since_previous
       FROM event_log WHERE event_type = 'purchase' WINDOW w AS (PARTITION BY user_id ORDER BY event_time)""",
)
def interval_since_last(t):
    from ..functions import expressions as X

    history = t.events_of("purchase").select("event_id", "user_id", "event_time")
    return joins.previous_time(history, ["user_id"], "event_time", "previous_at").select(
        "event_id",
        "user_id",
        "previous_at",
        X.whole_days_between("event_time", "previous_at").alias("days_since_previous"),
    )


# --- top-k ---------------------------------------------------------------------------

@query("top_users", "SELECT user_id, count(*) AS n FROM event_log GROUP BY user_id ORDER BY n DESC, user_id LIMIT 20")
def top_users(t):
    return features.top_values(t.event_log, "user_id", 20)


@query(
    "top_brands",
    "SELECT brand, count(*) AS n FROM shop_events WHERE brand IS NOT NULL GROUP BY brand ORDER BY n DESC, brand LIMIT 10",
)
def top_brands(t):
    return features.top_values(t.shop_events, "brand", 10)


@query(
    "popular_values",
    "\nUNION ALL ".join(
        f"""SELECT * FROM (SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, count(*) AS n FROM shop_events
            WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY n DESC, {c} LIMIT 20)"""
        for c in features.ENCODED
    ),
)
def popular_values(t):
    return ranking.popular_values(t.shop_events, features.ENCODED)


@query("leaderboard", BOARD_SQL)
def leaderboard(t):
    return ranking.leaderboard(metrics.model_metrics(t.scored))


@query(
    "best_by_error",
    """
    WITH e AS (SELECT product_id AS model, avg(CASE WHEN y > 0 THEN abs(y - p) / y * 100 END) AS mape FROM demand_pred GROUP BY product_id)
    SELECT model, round(mape, 6) AS mape FROM e WHERE mape <= 1000 ORDER BY mape, model LIMIT 1
    """,
)
def best_by_error(t):
    """Every product's forecast plays one model."""
    error = F.when(F.col("y") > 0, F.abs(F.col("y") - F.col("p")) / F.nullif("y", F.lit(0.0)) * 100)
    per_model = t.demand_predictions.groupBy(F.col("product_id").alias("model")).agg(F.avg(error).alias("mape"))
    return ranking.best_by_error(per_model)


@query(
    "best_run_per_experiment",
    """
    WITH b AS (SELECT * FROM runs WHERE starts_with(experiment, 'Brand#1')
               QUALIFY row_number() OVER (PARTITION BY experiment ORDER BY metric DESC, run_id) = 1)
    SELECT experiment, run_id, round(metric, 6) AS metric,
           CASE WHEN run_id = (SELECT run_id FROM b ORDER BY metric DESC, run_id LIMIT 1) THEN 1 ELSE 0 END AS is_best_overall FROM b
    """,
)
def best_run_per_experiment(t):
    return ranking.best_run_per_experiment(t.runs, prefix="Brand#1")


@query(
    "popular_fallback",
    """
    WITH top AS (SELECT product_id, CAST(row_number() OVER (ORDER BY product_popularity_score DESC, product_id) AS INT) AS rank
                 FROM product_stats QUALIFY row_number() OVER (ORDER BY product_popularity_score DESC, product_id) <= 5)
    SELECT c.c_custkey AS user_id, top.rank, top.product_id FROM customer c, top
    WHERE c.c_custkey NOT IN (SELECT user_id FROM event_log GROUP BY user_id HAVING count(*) >= 3)
    """,
)
def popular_fallback(t):
    users = t.raw("customer").select(F.col("c_custkey").alias("user_id"))
    return ranking.popular_fallback(users, t.event_log)


@query(
    "popular_fallback_in_category",
    """
    WITH top AS (SELECT p_type AS category_id, product_id,
                        CAST(row_number() OVER (PARTITION BY p_type ORDER BY product_popularity_score DESC, product_id) AS INT) AS rank
                 FROM product_stats JOIN part ON p_partkey = product_id),
    u AS (SELECT user_id, min(category_id) AS category_id FROM shop_events GROUP BY user_id)
    SELECT user_id, u.category_id, rank, product_id FROM u JOIN top USING (category_id) WHERE rank <= 5
    """,
)
def popular_fallback_in_category(t):
    users = t.shop_events.groupBy("user_id").agg(F.min("category_id").alias("category_id"))
    return ranking.popular_fallback_in_category(users, t.shop_events)


@query("sort_panel", f"SELECT {PANEL_COLUMNS} FROM panel ORDER BY product_id, event_date")
def sort_panel(t):
    return ranking.sort_panel(features.daily_product_stats(t.dated_events))


# --- set operations -------------------------------------------------------------------

@query("union_parts", f"SELECT {LOG_COLUMNS} FROM event_log")
def union_parts(t):
    """The event table put together again from its three event types."""
    return ranking.union_parts(
        [t.events_of(kind) for kind in ("view", "cart", "purchase")]
    )


def _common_sql(c: str) -> str:
    left, right = c != "event_date", c not in ("brand", "category_id")
    return (
        f"SELECT '{c}' AS \"column\", {str(left).lower()} AS in_reference, {str(right).lower()} AS in_current, "
        + (f"(SELECT count({c}) FROM shop_events)" if left else "NULL::BIGINT")
        + " AS reference_rows, "
        + (f"(SELECT count({c}) FROM dated)" if right else "NULL::BIGINT")
        + " AS current_rows"
    )


@query("common_columns", "\nUNION ALL ".join(_common_sql(c) for c in [*EVENTS.names, "event_date"]))
def common_columns(t):
    return ranking.common_columns(t.shop_events, t.dated_events)
