"""The canonical views of ``sources.tables`` written as SQL, for the result checks."""

COMMON = """
all_events AS (
  SELECT event_id, ts AS event_time, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events),
event_log AS (
  SELECT event_id, event_time,
         CASE event_type WHEN 'click' THEN 'cart' ELSE event_type END AS event_type,
         k AS product_id,
         CASE WHEN event_id % 50 <> 0 THEN value END AS price,
         user_id,
         CAST(user_id AS VARCHAR) || '-' || CAST(CAST(event_time AS DATE) AS VARCHAR) AS user_session
  FROM all_events WHERE event_type IN ('view', 'click', 'purchase')),
shop_events AS (
  SELECT e.event_id, e.event_time, e.event_type, e.product_id, p.p_type AS category_id,
         CASE WHEN p.p_partkey % 10 <> 0 THEN p.p_brand END AS brand,
         e.price, e.user_id, e.user_session
  FROM event_log e LEFT JOIN part p ON p.p_partkey = e.product_id),
dated AS (SELECT *, CAST(event_time AS DATE) AS event_date FROM event_log),
newest AS (SELECT max(event_time) AS t FROM event_log),
duplicated AS (
  SELECT * FROM shop_events UNION ALL SELECT * FROM shop_events WHERE event_id % 20 = 0),
numeric_events AS (
  SELECT event_time, price, CAST(product_id AS DOUBLE) AS product_id,
         CAST(extract(hour FROM event_time) AS DOUBLE) AS hour,
         CASE WHEN event_type = 'purchase' THEN 1.0 ELSE 0.0 END::DOUBLE AS target
  FROM event_log),
watched AS (
  SELECT 'price' AS "column", price AS value, event_time >= TIMESTAMP '2024-01-16' AS is_current FROM numeric_events
  UNION ALL SELECT 'product_id', product_id, event_time >= TIMESTAMP '2024-01-16' FROM numeric_events
  UNION ALL SELECT 'hour', hour, event_time >= TIMESTAMP '2024-01-16' FROM numeric_events
  UNION ALL SELECT 'target', target, event_time >= TIMESTAMP '2024-01-16' FROM numeric_events),
scored AS (
  SELECT event_id, ts AS event_time, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS y,
         'a' AS model, ((event_id * 7919) % 1000) / 1000.0::DOUBLE AS score, value AS latency FROM events
  UNION ALL
  SELECT event_id, ts, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END,
         'b', value / (value + 50), value * 1.25::DOUBLE FROM events),
requests AS (
  SELECT o_orderkey AS request_id,
         CASE WHEN o_orderkey % 150 = 0 THEN 'invalid' ELSE CAST(o_custkey AS VARCHAR) END AS user_id,
         CASE WHEN o_orderkey % 175 = 0 THEN NULL
              WHEN o_orderkey % 100 = 0 THEN CAST(-o_totalprice AS VARCHAR)
              ELSE CAST(o_totalprice AS VARCHAR) END AS transaction_amount
  FROM orders),
accepted AS (
  SELECT request_id, CAST(user_id AS BIGINT) AS user_id, CAST(transaction_amount AS DOUBLE) AS transaction_amount
  FROM requests
  WHERE TRY_CAST(user_id AS BIGINT) IS NOT NULL AND TRY_CAST(transaction_amount AS DOUBLE) >= 0),
user_stats AS (
  SELECT user_id, max(event_time) AS event_timestamp, count(*) AS user_total_events,
         count(*) FILTER (event_type = 'purchase') AS user_total_purchases,
         count(*) FILTER (event_type = 'view') AS user_total_views,
         count(*) FILTER (event_type = 'cart') AS user_total_carts,
         avg(price) AS user_avg_price,
         count(*) FILTER (event_type = 'purchase') / count(*)::DOUBLE AS user_purchase_frequency,
         count(DISTINCT user_session) AS user_session_count,
         CAST(floor(date_diff('microsecond', max(event_time), (SELECT t FROM newest)) / 86400e6::DOUBLE) AS BIGINT)
           AS days_since_last_activity
  FROM event_log GROUP BY user_id),
product_stats AS (
  SELECT product_id, max(event_time) AS event_timestamp,
         count(*) FILTER (event_type = 'view') AS product_total_views,
         count(*) FILTER (event_type = 'purchase') AS product_total_purchases,
         count(*) FILTER (event_type = 'cart') AS product_total_carts,
         coalesce(avg(price), 0.0) AS product_avg_price,
         count(*) FILTER (event_type = 'purchase')
           / greatest(count(*) FILTER (event_type = 'view'), 1)::DOUBLE AS product_view_to_purchase_rate,
         0.5::DOUBLE * count(*) FILTER (event_type = 'view') + 0.3::DOUBLE * count(*) FILTER (event_type = 'cart')
           + 0.2::DOUBLE * count(*) FILTER (event_type = 'purchase') AS product_popularity_score,
         CAST(floor(date_diff('microsecond', max(event_time), (SELECT t FROM newest)) / 86400e6::DOUBLE) AS BIGINT)
           AS days_since_last_view
  FROM event_log GROUP BY product_id),
pair_stats AS (
  SELECT user_id, product_id, max(event_time) AS event_timestamp,
         count(*) FILTER (event_type = 'view') AS user_product_view_count,
         count(*) FILTER (event_type = 'cart') AS user_product_cart_count,
         count(*) FILTER (event_type = 'purchase') AS user_product_purchase_count,
         date_diff('microsecond', max(event_time), (SELECT t FROM newest)) / 1e6::DOUBLE / 3600
           AS user_product_last_interaction_hours,
         0.1::DOUBLE * count(*) FILTER (event_type = 'view') + 0.3::DOUBLE * count(*) FILTER (event_type = 'cart')
           + 0.6::DOUBLE * count(*) FILTER (event_type = 'purchase') AS user_product_preference_score
  FROM event_log GROUP BY user_id, product_id),
user_price_stats AS (
  SELECT user_id, coalesce(avg(price), 0.0) AS user_price_mean, coalesce(stddev_samp(price), 0.0) AS user_price_std,
         count(price) AS user_event_count, count(*) FILTER (event_type = 'purchase') AS user_purchase_count,
         coalesce(count(*) FILTER (event_type = 'purchase') / nullif(count(price), 0)::DOUBLE, 0.0) AS user_purchase_rate
  FROM event_log GROUP BY user_id),
daily_user AS (
  SELECT user_id, count(*) FILTER (event_type = 'view') AS user_views, count(*) FILTER (event_type = 'cart') AS user_carts,
         count(*) FILTER (event_type = 'purchase') AS user_purchases, avg(price) AS user_avg_price,
         CAST(event_date + 1 AS TIMESTAMP) AS event_timestamp, CAST(event_date + 1 AS TIMESTAMP) AS created_timestamp
  FROM dated GROUP BY user_id, event_date),
daily_product AS (
  SELECT product_id, count(*) FILTER (event_type = 'view') AS product_views, count(*) FILTER (event_type = 'cart') AS product_carts,
         count(*) FILTER (event_type = 'purchase') AS product_purchases, avg(price) AS product_avg_price,
         CAST(event_date + 1 AS TIMESTAMP) AS event_timestamp, CAST(event_date + 1 AS TIMESTAMP) AS created_timestamp
  FROM dated GROUP BY product_id, event_date),
daily_pair AS (
  SELECT user_id, product_id, count(*) FILTER (event_type = 'view') AS pair_views, count(*) FILTER (event_type = 'cart') AS pair_carts,
         count(*) FILTER (event_type = 'purchase') AS pair_purchases, avg(price) AS pair_avg_price,
         CAST(event_date + 1 AS TIMESTAMP) AS event_timestamp, CAST(event_date + 1 AS TIMESTAMP) AS created_timestamp
  FROM dated GROUP BY user_id, product_id, event_date),
panel AS (
  SELECT product_id, event_date, count(*) FILTER (event_type = 'view') AS total_views,
         count(*) FILTER (event_type = 'cart') AS total_carts, count(*) FILTER (event_type = 'purchase') AS total_purchases,
         avg(price) AS price_mean, coalesce(stddev_samp(price), 0.0) AS price_std, count(DISTINCT user_id) AS unique_users
  FROM dated GROUP BY product_id, event_date),
daily_demand AS (
  SELECT event_date, product_id, count(*) AS demand FROM dated WHERE event_type = 'purchase' GROUP BY event_date, product_id),
demand_dates AS (
  SELECT target_date, history_start, history_end FROM (
    SELECT event_date AS target_date, lag(event_date, 1) OVER (ORDER BY event_date) AS history_start,
           lag(event_date, 1) OVER (ORDER BY event_date) AS history_end
    FROM (SELECT DISTINCT event_date FROM daily_demand)) WHERE history_start IS NOT NULL),
trailing_stats AS (
  SELECT target_date, product_id, count(*) AS total_events, count(*) FILTER (event_type = 'view') AS views,
         count(*) FILTER (event_type = 'cart') AS cart_adds, count(DISTINCT user_id) AS unique_users,
         avg(price) AS avg_price, stddev_samp(price) AS price_std, count(DISTINCT user_session) AS unique_sessions
  FROM dated JOIN demand_dates ON event_date BETWEEN history_start AND history_end GROUP BY target_date, product_id),
demand_set AS (
  SELECT t.target_date, t.product_id, t.total_events, t.views, t.cart_adds, t.unique_users,
         coalesce(t.avg_price, 0.0) AS avg_price, coalesce(t.price_std, 0.0) AS price_std, t.unique_sessions,
         CAST(isodow(t.target_date) - 1 AS INT) AS day_of_week,
         CASE WHEN isodow(t.target_date) >= 6 THEN 1 ELSE 0 END AS is_weekend, coalesce(d.demand, 0) AS demand
  FROM trailing_stats t LEFT JOIN daily_demand d ON d.event_date = t.target_date AND d.product_id = t.product_id),
demand_pred AS (SELECT target_date, product_id, CAST(demand AS DOUBLE) AS y, views * 0.5::DOUBLE AS p FROM demand_set),
online_users AS (
  SELECT user_id,
         avg(price) FILTER (event_type = 'purchase') AS avg_purchase_amount,
         count(*) FILTER (event_type = 'purchase') / count(*)::DOUBLE AS purchase_frequency,
         CAST(floor(date_diff('microsecond', max(event_time) FILTER (event_type = 'purchase'), (SELECT t FROM newest)) / 86400e6::DOUBLE) AS BIGINT)
           AS days_since_last_purchase,
         count(*) FILTER (event_type = 'purchase') AS total_purchases, count(*) AS total_events,
         count(*) FILTER (event_type = 'view') AS total_views, count(*) FILTER (event_type = 'cart') AS total_carts,
         count(DISTINCT user_session) AS session_count, avg(price) AS avg_price,
         coalesce(stddev_samp(price), 0.0) AS price_std, max(price) AS max_price,
         count(*) FILTER (event_type = 'purchase') / greatest(count(*) FILTER (event_type = 'cart'), 1)::DOUBLE AS cart_conversion
  FROM event_log GROUP BY user_id),
on_demand_inputs AS (
  SELECT e.event_id, e.user_id, e.product_id, CAST(extract(hour FROM e.event_time) AS INT) AS hour,
         CAST(isodow(e.event_time) - 1 AS INT) AS day_of_week, e.price,
         u.user_total_views, u.user_purchase_frequency, p.product_total_views, p.product_view_to_purchase_rate,
         x.user_product_view_count
  FROM event_log e LEFT JOIN user_stats u USING (user_id) LEFT JOIN product_stats p USING (product_id)
       LEFT JOIN pair_stats x ON x.user_id = e.user_id AND x.product_id = e.product_id
  WHERE e.event_type = 'purchase'),
alerts AS (
  SELECT event_id AS alert_id, event_time AS alert_time,
         CASE WHEN value > 100 THEN 'CRITICAL' WHEN value > 20 THEN 'WARNING' ELSE 'INFO' END AS level,
         ['DATA_DRIFT', 'ACCURACY_DROP', 'CONCEPT_DRIFT', 'MISSING_VALUES', 'PREDICTION_DRIFT', 'VALUE_RANGE'][k % 6 + 1] AS type,
         'value ' || CAST(value AS VARCHAR) AS message,
         CASE WHEN event_type = 'error' THEN 'value' END AS metric, value, 20.0::DOUBLE AS threshold, user_id
  FROM all_events WHERE event_type IN ('error', 'signup')),
failed AS (
  SELECT event_id AS request_id,
         CASE k % 5 WHEN 0 THEN 'Read Timeout after 10s' WHEN 1 THEN 'Connection refused' ELSE 'request failed' END AS message,
         CASE k % 5 WHEN 2 THEN 503 WHEN 3 THEN 422 END AS status
  FROM all_events WHERE event_type = 'error'),
runs AS (SELECT p_partkey AS run_id, p_brand AS experiment, p_retailprice AS metric FROM part),
versions AS (
  SELECT o_custkey AS model_id, o_orderkey AS version, o_orderdate AS created_at,
         CASE o_orderstatus WHEN 'P' THEN 'Production' WHEN 'F' THEN 'Archived' ELSE 'None' END AS stage
  FROM orders),
overall AS (
  SELECT avg(price) AS price, avg(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS share,
         CAST(min(event_time) AS DATE) AS first_day FROM event_log),
checks AS (
  SELECT CAST(event_date AS VARCHAR) AS check_id, CAST(event_date + 1 AS TIMESTAMP) AS as_of,
         abs(avg(dated.price) / any_value(o.price) - 1) * 3 AS drift_score,
         (any_value(o.share) - avg(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END)) * 3 AS accuracy_drop,
         count(*) AS new_rows,
         CASE WHEN day(event_date) > 5 THEN CAST(any_value(first_day) - 20 AS TIMESTAMP) END AS model_created_at,
         CASE WHEN day(event_date) >= 10
              THEN CAST(any_value(first_day) + CAST((day(event_date) // 10) * 10 - 1 AS INT) AS TIMESTAMP) END AS last_retrain_at
  FROM dated, overall o GROUP BY event_date),
psi_limits AS (SELECT "column", min(value) AS lo, max(value) AS hi FROM watched WHERE value IS NOT NULL GROUP BY 1),
psi_bins AS (
  SELECT "column", b, count(*) FILTER (NOT is_current) AS r, count(*) FILTER (is_current) AS c
  FROM (SELECT w."column", is_current,
               CASE WHEN lo = hi THEN 0 ELSE least(CAST(floor((value - lo) / ((hi - lo) / 10)) AS INT), 9) END AS b
        FROM watched w JOIN psi_limits l ON l."column" = w."column" WHERE value IS NOT NULL) GROUP BY 1, 2),
psi_shares AS (
  SELECT l."column", l.lo, l.hi,
         coalesce(r, 0) / sum(coalesce(r, 0)) OVER (PARTITION BY l."column")::DOUBLE AS rs,
         coalesce(c, 0) / sum(coalesce(c, 0)) OVER (PARTITION BY l."column")::DOUBLE AS cs
  FROM (SELECT * FROM psi_limits, range(10) AS t(g)) l LEFT JOIN psi_bins x ON x."column" = l."column" AND x.b = l.g),
psi AS (
  SELECT "column", CASE WHEN min(lo) = max(hi) THEN 0.0::DOUBLE ELSE
         sum((CASE WHEN cs = 0 THEN 0.0001 ELSE cs END - CASE WHEN rs = 0 THEN 0.0001 ELSE rs END)
             * ln(CASE WHEN cs = 0 THEN 0.0001 ELSE cs END / CASE WHEN rs = 0 THEN 0.0001 ELSE rs END)) END AS psi
  FROM psi_shares GROUP BY 1),
cdf AS (
  SELECT "column", value, lead(value) OVER w AS next_value,
         abs(sum(r) OVER w / sum(r) OVER (PARTITION BY "column")::DOUBLE - sum(c) OVER w / sum(c) OVER (PARTITION BY "column")::DOUBLE) AS gap,
         sum(r) OVER (PARTITION BY "column")::DOUBLE AS nr, sum(c) OVER (PARTITION BY "column")::DOUBLE AS nc
  FROM (SELECT "column", value, count(*) FILTER (NOT is_current) AS r, count(*) FILTER (is_current) AS c
        FROM watched WHERE value IS NOT NULL GROUP BY 1, 2)
  WINDOW w AS (PARTITION BY "column" ORDER BY value)),
distances AS (
  SELECT "column", max(gap) AS ks_statistic, coalesce(sum(gap * (next_value - value)), 0.0) AS wasserstein,
         sqrt(any_value(nr) * any_value(nc) / (any_value(nr) + any_value(nc))) * max(gap) AS x
  FROM cdf GROUP BY 1),
ks AS (
  SELECT "column", ks_statistic,
         CASE WHEN x < 0.2 THEN 1.0 ELSE least(greatest(
           (SELECT sum((CASE WHEN j % 2 = 1 THEN 2.0 ELSE -2.0 END)::DOUBLE * exp(-2.0::DOUBLE * j * j * x * x)) FROM range(1, 101) AS s(j)),
           0.0), 1.0) END AS ks_p_value, wasserstein
  FROM distances),
sides AS (
  SELECT "column", min(value) FILTER (NOT is_current) AS reference_min, max(value) FILTER (NOT is_current) AS reference_max,
         avg(value) FILTER (NOT is_current) AS reference_mean, stddev_samp(value) FILTER (NOT is_current) AS reference_std,
         min(value) FILTER (is_current) AS current_min, max(value) FILTER (is_current) AS current_max,
         avg(value) FILTER (is_current) AS current_mean, stddev_samp(value) FILTER (is_current) AS current_std,
         avg(CASE WHEN value IS NULL THEN 1.0 ELSE 0.0 END) FILTER (NOT is_current) AS reference_rate,
         avg(CASE WHEN value IS NULL THEN 1.0 ELSE 0.0 END) FILTER (is_current) AS current_rate
  FROM watched GROUP BY 1),
ranges AS (
  SELECT *, CASE WHEN current_min < reference_min OR current_max > reference_max THEN 1 ELSE 0 END AS violation,
         coalesce(abs((current_mean - reference_mean) / nullif(reference_mean, 0)) * 100, 0.0) AS mean_change_pct
  FROM sides),
category_watch AS (
  SELECT "column", category, event_time >= TIMESTAMP '2024-01-16' AS is_current
  FROM (SELECT event_time, 'event_type' AS "column", event_type AS category FROM shop_events
        UNION ALL SELECT event_time, 'brand', brand FROM shop_events
        UNION ALL SELECT event_time, 'category_id', category_id FROM shop_events)),
category_sides AS (
  SELECT "column", category, r, c, sum(r) OVER w AS nr, sum(c) OVER w AS nc, r / sum(r) OVER w::DOUBLE AS p, c / sum(c) OVER w::DOUBLE AS q
  FROM (SELECT "column", category, count(*) FILTER (NOT is_current) AS r, count(*) FILTER (is_current) AS c
        FROM category_watch WHERE category IS NOT NULL GROUP BY 1, 2)
  WINDOW w AS (PARTITION BY "column")),
category_parts AS (
  SELECT *, (CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2 AS divergence,
         (r - (r + c) * nr / (nr + nc)) ** 2 / ((r + c) * nr / (nr + nc)) + (c - (r + c) * nc / (nr + nc)) ** 2 / ((r + c) * nc / (nr + nc)) AS chi
  FROM category_sides),
category_rates AS (
  SELECT "column", avg(CASE WHEN category IS NULL THEN 1.0 ELSE 0.0 END) FILTER (NOT is_current) AS reference_rate,
         avg(CASE WHEN category IS NULL THEN 1.0 ELSE 0.0 END) FILTER (is_current) AS current_rate
  FROM category_watch GROUP BY 1),
category_figures AS (
  SELECT "column", count(*) AS categories, count(*) FILTER (r = 0) AS new_categories, count(*) FILTER (c = 0) AS vanished_categories,
         sqrt(greatest(sum(divergence), 0)) AS js_distance, sum(chi) AS chi_square, count(*) - 1 AS degrees
  FROM category_parts GROUP BY 1),
category_drift AS (
  SELECT *, CASE WHEN js_distance > 0.1 AND p_value < 0.05 THEN 1 ELSE 0 END AS drifted FROM (
    SELECT f.*, reference_rate, current_rate,
           1 - (SELECT sum(exp((degrees / 2.0::DOUBLE + j) * ln(chi_square / 2) - chi_square / 2 - lgamma(degrees / 2.0::DOUBLE + j + 1)))
                FROM range(2000) AS s(j)) AS p_value
    FROM category_figures f JOIN category_rates USING ("column"))),
drift_flags AS (
  SELECT psi, psi > 0.2 OR ks_statistic > 0.1 AS drifted, current_rate, violation, 0 AS new_categories
  FROM psi JOIN ks USING ("column") JOIN ranges USING ("column")
  UNION ALL SELECT NULL, drifted = 1, current_rate, 0, new_categories FROM category_drift),
drift_summary AS (
  SELECT max(psi) AS drift_score, count(*) FILTER (drifted) AS drifted_columns, count(*) AS total_columns,
         max(current_rate) AS max_missing_rate, CAST(sum(violation) AS BIGINT) AS range_violations,
         CAST(sum(new_categories) AS BIGINT) AS new_categories,
         CASE WHEN count(*) FILTER (drifted) * 2 >= count(*) THEN 1 ELSE 0 END AS dataset_drift
  FROM drift_flags),
confusion AS (
  SELECT model, count(*) FILTER (y = 0 AND score <= 0.5) AS tn, count(*) FILTER (y = 0 AND score > 0.5) AS fp,
         count(*) FILTER (y = 1 AND score <= 0.5) AS fn, count(*) FILTER (y = 1 AND score > 0.5) AS tp
  FROM scored GROUP BY model),
class_metrics AS (
  SELECT model, (tn + tp) / n AS accuracy,
         (coalesce(tn / nullif(tn + fn, 0)::DOUBLE, 0) * neg + coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0) * pos) / n AS precision,
         (coalesce(tn / nullif(neg, 0)::DOUBLE, 0) * neg + coalesce(tp / nullif(pos, 0)::DOUBLE, 0) * pos) / n AS recall,
         (coalesce(2 * tn / nullif(2 * tn + fn + fp, 0)::DOUBLE, 0) * neg
          + coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0) * pos) / n AS f1_score
  FROM (SELECT *, tn + fp AS neg, tp + fn AS pos, (tn + fp + tp + fn)::DOUBLE AS n FROM confusion)),
auc AS (
  SELECT model, coalesce(sum(p * (below + n / 2.0::DOUBLE)) / nullif(any_value(np) * any_value(nn), 0), 0.5) AS roc_auc
  FROM (SELECT model, score, p, n, coalesce(sum(n) OVER (PARTITION BY model ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS below,
               sum(p) OVER (PARTITION BY model)::DOUBLE AS np, sum(n) OVER (PARTITION BY model)::DOUBLE AS nn
        FROM (SELECT model, score, count(*) FILTER (y = 1) AS p, count(*) FILTER (y = 0) AS n FROM scored GROUP BY 1, 2))
  GROUP BY model),
model_metrics AS (
  SELECT c.*, roc_auc, latency_ms FROM class_metrics c JOIN auc USING (model)
  JOIN (SELECT model, avg(latency) AS latency_ms FROM scored GROUP BY model) USING (model)),
comparison AS (
  SELECT a.event_id, a.event_time, a.score AS pa, b.score AS pb, a.latency AS la, b.latency AS lb,
         abs(a.score - b.score) AS absolute_difference,
         abs(a.score - b.score) / greatest(a.score, 0.001) AS relative_difference,
         CASE WHEN abs(a.score - b.score) < 0.01 THEN 'minor' WHEN abs(a.score - b.score) < 0.1 THEN 'moderate' ELSE 'major' END AS discrepancy_type,
         CASE WHEN a.score > 0.5 THEN 1 ELSE 0 END AS production_binary, CASE WHEN b.score > 0.5 THEN 1 ELSE 0 END AS shadow_binary,
         CASE WHEN (a.score > 0.5) <> (b.score > 0.5) THEN 1 ELSE 0 END AS binary_mismatch
  FROM scored a JOIN scored b ON a.event_id = b.event_id AND a.model = 'a' AND b.model = 'b')
""".strip()


def _stir_sql(h: str) -> str:
    mask = 2**31 - 1
    for shift, factor in zip((16, 15, 13), (1540483477, 739982445, 1935289751)):
        h = f"((xor({h}, {h} >> {shift}) * {factor}) & {mask})"
    return f"xor({h}, {h} >> 16)"


def id_bucket_sql(identifier: str, buckets: int, seed: int = 42) -> str:
    """The stable hash of ``functions.expressions.id_bucket`` as SQL."""
    mask = 2**31 - 1
    start = f"((({identifier} & {mask}) + {(seed * 374761393) % mask}) & {mask})"
    return f"({_stir_sql(_stir_high(start, identifier, mask))} % {buckets})"


def _stir_high(start: str, identifier: str, mask: int) -> str:
    return f"xor({_stir_sql(start)}, (({identifier} >> 31) & {mask}))"


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def case_lookup(column: str, table: dict[str, str], default: str) -> str:
    whens = " ".join(f"WHEN {quote(k)} THEN {quote(v)}" for k, v in table.items())
    return f"CASE {column} {whens} ELSE {quote(default)} END"
