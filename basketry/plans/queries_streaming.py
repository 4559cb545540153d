"""Queries: streaming jobs run to completion over the event files."""

from pyspark.sql import functions as F

from ..operators import decisions
from ..streaming import jobs
from .registry import query


REQUESTS_SQL = """
    WITH r AS (SELECT event_id, event_time, 'a' AS model, value AS latency, event_type = 'error' AS e FROM all_events
               UNION ALL SELECT event_id, event_time, 'b', value * 1.25::DOUBLE, event_type = 'error' FROM all_events)
    """

INFERENCE_SQL = (
    REQUESTS_SQL
    + """
    SELECT time_bucket(INTERVAL 5 MINUTE, event_time, TIMESTAMP '2024-01-01') AS window_start, model, count(*) AS requests, round(avg(latency), 6) AS latency_mean,
           round(stddev_pop(latency), 6) AS latency_std, round(quantile_disc(latency, 0.95), 6) AS latency_p95,
           round(count(*) / 300.0::DOUBLE, 6) AS requests_per_second, round(count(*) FILTER (e) / count(*)::DOUBLE, 6) AS error_rate
    FROM r GROUP BY 1, 2
    """
)


@query("stream_inference_metrics", INFERENCE_SQL)
def stream_inference_metrics(t):
    stream = jobs.request_stream(jobs.event_stream(t.spark, t.sf_dir))
    return jobs.current_inference(
        jobs.merged_parts(stream, jobs.inference_parts, jobs.merge_inference, "inference")
    )


# Sketches are exact up to 4,096 requests in five minutes, which these tables stay far below.
@query("stream_inference_sketch", INFERENCE_SQL)
def stream_inference_sketch(t):
    stream = jobs.request_stream(jobs.event_stream(t.spark, t.sf_dir))
    return jobs.sketched_inference(jobs.merged_parts(stream, jobs.sketch_parts, jobs.merge_sketches, "sketches"))


@query(
    "stream_last_requests",
    REQUESTS_SQL
    + """
    SELECT model, count(*) AS total_requests, round(quantile_cont(latency, 0.5), 6) AS latency_p50, round(quantile_cont(latency, 0.95), 6) AS latency_p95,
           round(quantile_cont(latency, 0.99), 6) AS latency_p99, round(avg(latency), 6) AS latency_mean, round(stddev_pop(latency), 6) AS latency_std,
           round(min(latency), 6) AS latency_min, round(max(latency), 6) AS latency_max,
           round(coalesce(count(*) / nullif((epoch_us(max(event_time)) - epoch_us(min(event_time))) / 1e6::DOUBLE, 0), 0), 6) AS requests_per_second,
           round(count(*) FILTER (e) / 1000.0::DOUBLE, 6) AS error_rate
    FROM (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY model ORDER BY event_time DESC, event_id DESC) <= 1000) GROUP BY model
    """,
)
def stream_last_requests(t):
    """The last 1,000 requests of each model."""
    return jobs.last_requests(jobs.request_stream(jobs.event_stream(t.spark, t.sf_dir)))


@query(
    "stream_user_activity",
    """SELECT user_id, count(*) AS event_count, max(event_time) AS last_seen, CASE WHEN count(*) < 3 THEN 1 ELSE 0 END AS is_cold
       FROM all_events GROUP BY user_id""",
)
def stream_user_activity(t):
    return jobs.user_activity(jobs.event_stream(t.spark, t.sf_dir))


@query(
    "stream_shadow_compare",
    """
    SELECT day, n AS total_requests, round(mj, 6) AS major_rate, round(mm, 6) AS mismatch_rate,
           CASE WHEN mj < 0.01 AND mm < 0.05 THEN 'ready_for_production' WHEN mj < 0.05 AND mm < 0.1 THEN 'requires_further_testing'
                ELSE 'not_ready_high_discrepancy' END AS recommendation
    FROM (SELECT CAST(event_time AS DATE) AS day, count(*) AS n, count(*) FILTER (discrepancy_type = 'major') / count(*)::DOUBLE AS mj,
                 count(*) FILTER (binary_mismatch = 1) / count(*)::DOUBLE AS mm FROM comparison GROUP BY 1)
    """,
)
def stream_shadow_compare(t):
    production = jobs.score_stream(jobs.event_stream(t.spark, t.sf_dir), "production")
    shadow = jobs.score_stream(jobs.event_stream(t.spark, t.sf_dir), "shadow")
    compared = jobs.pair_scores(production, shadow)
    return decisions.shadow_rates(compared.withColumn("day", F.to_date("event_time")), ["day"]).select(
        "day", "total_requests", "major_rate", "mismatch_rate", "recommendation"
    )


# The reference is the first half of the table, so the later days can move away from it.
DRIFT_SQL = """
    WITH long AS (
      SELECT CAST(event_time AS DATE) AS day, event_time < TIMESTAMP '2024-01-16' AS is_ref, 'value' AS c, value::DOUBLE AS v FROM all_events
      UNION ALL SELECT CAST(event_time AS DATE), event_time < TIMESTAMP '2024-01-16', 'k', k::DOUBLE FROM all_events),
    lim AS (SELECT c, min(v) AS lo, max(v) AS hi FROM long WHERE is_ref GROUP BY c),
    cells AS (
      SELECT l.*, lim.lo, lim.hi, CASE WHEN v IS NULL THEN NULL WHEN lim.hi = lim.lo THEN 0 ELSE
        least(floor((least(greatest(v, lim.lo), lim.hi) - lim.lo) / ((lim.hi - lim.lo) / 10)), 9) END AS bin
      FROM long l JOIN lim USING (c)),
    days AS (SELECT DISTINCT day, c FROM cells),
    points AS (
      SELECT day, c, v, sum(r) AS r, sum(n) AS n FROM (
        SELECT day, c, v, r, 0 AS n FROM (SELECT c, v, count(*) AS r FROM cells WHERE is_ref AND v IS NOT NULL GROUP BY 1, 2) JOIN days USING (c)
        UNION ALL SELECT day, c, v, 0, count(*) FROM cells WHERE v IS NOT NULL GROUP BY 1, 2, 3) GROUP BY 1, 2, 3),
    ks AS (
      SELECT day, c, max(gap) AS ks FROM (
        SELECT day, c, abs(sum(r) OVER w / sum(r) OVER a - sum(n) OVER w / sum(n) OVER a) AS gap FROM points
        WINDOW a AS (PARTITION BY day, c), w AS (PARTITION BY day, c ORDER BY v)) GROUP BY 1, 2),
    tenths AS (
      SELECT day, c, bin, sum(r) AS r, sum(n) AS n FROM (
        SELECT day, c, bin, r, 0 AS n FROM (SELECT c, bin, count(*) AS r FROM cells WHERE is_ref AND bin IS NOT NULL GROUP BY 1, 2) JOIN days USING (c)
        UNION ALL SELECT day, c, bin, 0, count(*) FROM cells WHERE bin IS NOT NULL GROUP BY 1, 2, 3) GROUP BY 1, 2, 3),
    psi AS (
      SELECT day, c, sum((n - r) * ln(n / r)) AS psi FROM (
        SELECT day, c, CASE WHEN r = 0 THEN 0.0001 ELSE r / sum(r) OVER a END AS r, CASE WHEN n = 0 THEN 0.0001 ELSE n / sum(n) OVER a END AS n
        FROM tenths WINDOW a AS (PARTITION BY day, c)) GROUP BY 1, 2),
    fig AS (SELECT day, c, avg(CASE WHEN v IS NULL THEN 1.0 ELSE 0.0 END) AS missing, max(CASE WHEN v < lo OR v > hi THEN 1 ELSE 0 END) AS outside
            FROM cells GROUP BY 1, 2)
    SELECT day, round(max(psi), 6) AS drift_score, count(*) FILTER (psi > 0.2 OR ks > 0.1) AS drifted_columns, 2::BIGINT AS total_columns,
           round(max(missing), 6) AS max_missing_rate, sum(outside)::BIGINT AS range_violations, round(max(ks), 6) AS max_ks,
           CASE WHEN 2 * count(*) FILTER (psi > 0.2 OR ks > 0.1) >= 2 THEN 1 ELSE 0 END AS dataset_drift
    FROM fig LEFT JOIN psi USING (day, c) LEFT JOIN ks USING (day, c) GROUP BY day
    """


@query("stream_drift_monitor", DRIFT_SQL)
def stream_drift_monitor(t):
    stream = jobs.event_stream(t.spark, t.sf_dir).withColumn("k", F.col("k").cast("double"))
    reference = t.all_events.where(F.col("event_time") < F.lit("2024-01-16").cast("timestamp")).select(
        "value", F.col("k").cast("double").alias("k")
    )
    return jobs.drift_monitor(stream, reference, ["value", "k"])


@query(
    "stream_feature_update",
    """SELECT user_id, max(event_time) AS event_timestamp, count(*) AS total_events, count(*) FILTER (event_type = 'view') AS total_views,
              count(*) FILTER (event_type = 'click') AS total_carts, count(*) FILTER (event_type = 'purchase') AS total_purchases
       FROM all_events GROUP BY user_id""",
)
def stream_feature_update(t):
    return jobs.feature_update(jobs.event_stream(t.spark, t.sf_dir))
