"""Queries: drift, data quality, model metrics, comparisons, decision tables."""

from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..operators import alerts, categories, decisions, drift, joins, metrics, sampling
from .registry import query
from .views_sql import id_bucket_sql, quote


# --- drift ------------------------------------------------------------------------

@query("psi", 'SELECT "column", round(psi, 6) AS psi FROM psi')
def psi(t):
    return drift.psi(t.reference, t.current, t.DRIFT_COLUMNS)


@query("ks_test", 'SELECT "column", round(ks_statistic, 6) AS ks_statistic, round(ks_p_value, 6) AS ks_p_value FROM ks')
def ks_test(t):
    return drift.ks_test(t.reference, t.current, t.DRIFT_COLUMNS)


@query("wasserstein_1d", 'SELECT "column", round(wasserstein, 6) AS wasserstein FROM ks')
def wasserstein_1d(t):
    return drift.wasserstein_1d(t.reference, t.current, t.DRIFT_COLUMNS)


def _line_sql(body: str) -> str:
    """The drift figures over line items, split at a ship date."""
    parts = "\nUNION ALL ".join(
        f"""SELECT '{c}' AS "column", {c} AS value, l_shipdate >= TIMESTAMP '1998-07-01' AS is_current FROM lineitem"""
        for c in ("l_extendedprice", "l_quantity", "l_discount")
    )
    return f"WITH li AS ({parts}) {body}"


@query(
    "drift_line_items",
    _line_sql(
        """,
        lc AS (SELECT "column", value, lead(value) OVER w AS next_value,
                      abs(sum(r) OVER w / sum(r) OVER (PARTITION BY "column")::DOUBLE - sum(c) OVER w / sum(c) OVER (PARTITION BY "column")::DOUBLE) AS gap
               FROM (SELECT "column", value, count(*) FILTER (NOT is_current) AS r, count(*) FILTER (is_current) AS c FROM li GROUP BY 1, 2)
               WINDOW w AS (PARTITION BY "column" ORDER BY value))
        SELECT "column", round(max(gap), 6) AS ks_statistic, round(sum(gap * (next_value - value)), 6) AS wasserstein FROM lc GROUP BY 1
        """
    ),
)
def drift_line_items(t):
    return drift.distances(t.line_reference, t.line_current, t.LINE_COLUMNS).drop("ks_p_value")


@query(
    "missing_rate_change",
    """SELECT "column", round(reference_rate, 6) AS reference_rate, round(current_rate, 6) AS current_rate,
              round(current_rate - reference_rate, 6) AS difference FROM sides""",
)
def missing_rate_change(t):
    return drift.missing_rate_change(t.reference, t.current, t.DRIFT_COLUMNS)


RANGE_COLUMNS = ", ".join(
    f"round({s}_{m}, 6) AS {s}_{m}" for s in ("reference", "current") for m in ("min", "max", "mean", "std")
)


@query("range_violations", f'SELECT "column", {RANGE_COLUMNS}, violation, round(mean_change_pct, 6) AS mean_change_pct FROM ranges')
def range_violations(t):
    return drift.range_violations(t.reference, t.current, t.DRIFT_COLUMNS)


@query(
    "drift_detail",
    f"""SELECT "column", round(psi, 6) AS psi, round(ks_statistic, 6) AS ks_statistic, round(ks_p_value, 6) AS ks_p_value,
               round(wasserstein, 6) AS wasserstein, {RANGE_COLUMNS}, violation, round(mean_change_pct, 6) AS mean_change_pct,
               round(reference_rate, 6) AS reference_rate, round(current_rate, 6) AS current_rate,
               round(current_rate - reference_rate, 6) AS difference
        FROM psi JOIN ks USING ("column") JOIN ranges USING ("column")""",
)
def drift_detail(t):
    return drift.drift_detail(t.reference, t.current, t.DRIFT_COLUMNS)


@query(
    "categorical_drift",
    """SELECT "column", categories, new_categories, vanished_categories, round(js_distance, 6) AS js_distance,
              round(chi_square, 6) AS chi_square, degrees, round(p_value, 6) AS p_value,
              round(reference_rate, 6) AS reference_rate, round(current_rate, 6) AS current_rate, drifted FROM category_drift""",
)
def categorical_drift(t):
    return categories.categorical_drift(t.mixed_reference, t.mixed_current, t.DRIFT_CATEGORIES)


@query(
    "category_changes",
    """SELECT "column", category, round(p, 6) AS reference_share, round(q, 6) AS current_share, round(q - p, 6) AS difference,
              round(divergence, 6) AS divergence, CASE WHEN r = 0 THEN 'new' WHEN c = 0 THEN 'vanished' ELSE 'kept' END AS status
       FROM category_parts""",
)
def category_changes(t):
    return categories.category_changes(categories.side_counts(t.mixed_reference, t.mixed_current, t.DRIFT_CATEGORIES))


def _summary(t):
    return drift.drift_summary(t.mixed_reference, t.mixed_current, t.DRIFT_COLUMNS, categorical=t.DRIFT_CATEGORIES)


@query(
    "drift_summary",
    """SELECT round(drift_score, 6) AS drift_score, drifted_columns, total_columns, round(max_missing_rate, 6) AS max_missing_rate,
              range_violations, new_categories, dataset_drift FROM drift_summary""",
)
def drift_summary(t):
    return _summary(t)


QUALITY = ["price", "product_id", "hour"]


def _quality_sql() -> str:
    figures = {
        "min": "min({c})", "max": "max({c})", "mean": "avg({c})", "std": "stddev_samp({c})",
        "null_count": "CAST(count(*) - count({c}) AS DOUBLE)",
        "null_share": "(count(*) - count({c})) / count(*)::DOUBLE",
    }
    rows = [("row_count", "*", "CAST(count(*) AS DOUBLE)"), ("column_count", "*", "any_value(5.0::DOUBLE)")]
    rows += [(name, c, f.format(c=c)) for c in QUALITY for name, f in figures.items()]
    parts = []
    for test, column, expr in rows:
        ref = f"(SELECT {expr} FROM numeric_events WHERE event_time < TIMESTAMP '2024-01-16')"
        cur = f"(SELECT {expr} FROM numeric_events WHERE event_time >= TIMESTAMP '2024-01-16')"
        parts.append(f"""SELECT '{test}' AS test, '{column}' AS "column", {ref} AS e, {cur} AS a""")
    union = "\nUNION ALL ".join(parts)
    return f"""SELECT test, "column", round(e, 6) AS expected, round(a, 6) AS actual,
                      coalesce(abs(a - e) <= 0.1 * abs(e), e IS NULL AND a IS NULL) AS passed FROM ({union})"""


@query("quality_tests", _quality_sql())
def quality_tests(t):
    return drift.quality_tests(t.reference, t.current, QUALITY)


def _alert_sql(level: str, kind: str, message: str, metric: str, value: str, limit: float, source: str, when: str, keep: str = "") -> str:
    return f"""SELECT {keep}{quote(level)} AS level, {quote(kind)} AS type, {message} AS message, {quote(metric)} AS metric,
        round(CAST({value} AS DOUBLE), 6) AS value, {limit}::DOUBLE AS threshold FROM {source} WHERE {when}"""


@query(
    "data_alerts",
    "\nUNION ALL ".join(
        [
            _alert_sql("CRITICAL", "DATA_DRIFT", f"printf({quote(V.DRIFT_MESSAGE)}, drift_score, '0.2')", "drift_score",
                       "drift_score", 0.2, "drift_summary", "drift_score > 0.2"),
            _alert_sql("WARNING", "COLUMN_DRIFT", f"printf({quote(V.COLUMN_DRIFT_MESSAGE)}, CAST(drifted_columns AS VARCHAR))",
                       "drifted_columns", "drifted_columns", 0.0, "drift_summary", "drifted_columns > 0"),
            _alert_sql("WARNING", "MISSING_VALUES", f"printf({quote(V.MISSING_MESSAGE)}, max_missing_rate, '0.1')",
                       "max_missing_rate", "max_missing_rate", 0.1, "drift_summary", "max_missing_rate > 0.1"),
            _alert_sql("WARNING", "VALUE_RANGE", f"printf({quote(V.RANGE_MESSAGE)}, CAST(range_violations AS VARCHAR))",
                       "range_violations", "range_violations", 0.0, "drift_summary", "range_violations > 0"),
        ]
    ),
)
def data_alerts(t):
    return alerts.data_alerts(_summary(t))


@query(
    "prediction_drift",
    """
    WITH w AS (SELECT model AS "column", score AS value, event_time >= TIMESTAMP '2024-01-16' AS cur FROM scored),
    l AS (SELECT "column", min(value) AS lo, max(value) AS hi FROM w GROUP BY 1),
    b AS (SELECT w."column", least(CAST(floor((value - lo) / ((hi - lo) / 10)) AS INT), 9) AS b, count(*) FILTER (NOT cur) AS r, count(*) FILTER (cur) AS c
          FROM w JOIN l ON l."column" = w."column" GROUP BY 1, 2),
    s AS (SELECT "column", r / sum(r) OVER (PARTITION BY "column")::DOUBLE AS rs, c / sum(c) OVER (PARTITION BY "column")::DOUBLE AS cs
          FROM (SELECT l."column", coalesce(r, 0) AS r, coalesce(c, 0) AS c FROM l CROSS JOIN range(10) AS g(g) LEFT JOIN b ON b."column" = l."column" AND b.b = g.g))
    SELECT "column", round(psi, 6) AS psi, CASE WHEN psi > 0.2 THEN 1 ELSE 0 END AS alert
    FROM (SELECT "column", sum((greatest(cs, CASE WHEN cs = 0 THEN 0.0001 ELSE cs END) - CASE WHEN rs = 0 THEN 0.0001 ELSE rs END)
            * ln(CASE WHEN cs = 0 THEN 0.0001 ELSE cs END / CASE WHEN rs = 0 THEN 0.0001 ELSE rs END)) AS psi FROM s GROUP BY 1)
    """,
)
def prediction_drift(t):
    split = F.lit("2024-01-16").cast("timestamp")
    before = t.predictions.where(F.col("event_time") < split).select(*t.MODELS)
    after = t.predictions.where(F.col("event_time") >= split).select(*t.MODELS)
    return drift.psi(before, after, t.MODELS).withColumn(
        "alert", F.when(F.col("psi") > V.PSI_LIMIT, 1).otherwise(0)
    )


@query(
    "concept_drift",
    """
    WITH p AS (SELECT value, CAST(k AS DOUBLE) AS k, value / (value + 50) AS score,
                      CASE WHEN (event_type = 'purchase') <> (value / (value + 50) > 0.5) THEN 1.0 ELSE 0.0 END::DOUBLE AS err FROM all_events)
    SELECT "column", round(c, 6) AS error_correlation, CASE WHEN abs(c) > 0.3 THEN 1 ELSE 0 END AS drift
    FROM (SELECT 'value' AS "column", corr(value, err) AS c FROM p UNION ALL SELECT 'k', corr(k, err) FROM p
          UNION ALL SELECT 'score', corr(score, err) FROM p)
    """,
)
def concept_drift(t):
    score = F.col("value") / (F.col("value") + 50)
    rows = t.all_events.select(
        "value",
        "k",
        score.alias("score"),
        F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("y"),
        F.when(score > 0.5, 1).otherwise(0).alias("p"),
    )
    return drift.concept_drift(rows, ["value", "k", "score"], "y", "p")


# --- model metrics ------------------------------------------------------------------

@query(
    "confusion_counts",
    "SELECT model, tn, fp, fn, tp, round(coalesce(tn / nullif(tn + fp, 0)::DOUBLE, 0), 6) AS specificity FROM confusion",
)
def confusion_counts(t):
    return metrics.confusion_counts(t.scored)


CLASS_COLUMNS = "round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1_score, 6) AS f1_score"


@query("classification_metrics", f"SELECT model, {CLASS_COLUMNS} FROM class_metrics")
def classification_metrics(t):
    return metrics.classification_metrics(t.scored)


@query("roc_auc", "SELECT model, round(roc_auc, 6) AS roc_auc FROM auc")
def roc_auc(t):
    return metrics.roc_auc(t.scored)


@query(
    "regression_metrics",
    """
    SELECT round(avg(abs(y - p)), 6) AS mae, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse,
           round(CASE WHEN var_pop(y) = 0 THEN 0.0 ELSE 1 - avg((y - p) * (y - p)) / var_pop(y) END, 6) AS r2,
           round(avg(abs(y - p) / greatest(abs(y), 2.220446049250313e-16)), -9) AS mape
    FROM demand_pred
    """,
)
def regression_metrics(t):
    # Days without demand divide by the smallest step of a double, so the mean is of the order of
    # 1e15 and its last digits depend on the order of the sum.
    return metrics.regression_metrics(t.demand_predictions).withColumn("mape", F.round("mape", -9))


@query(
    "safe_mape",
    """SELECT round(least(coalesce(avg(abs(y - p) / y * 100) FILTER (y > 0 AND p >= 0 AND y < 1e10 AND p < 1e10), 1000.0), 1000.0), 6) AS mape_pct,
              count(*) FILTER (y > 0 AND p >= 0 AND y < 1e10 AND p < 1e10) AS rows_used FROM demand_pred""",
)
def safe_mape(t):
    return metrics.safe_mape(t.demand_predictions)


@query(
    "zero_inflated_mape",
    """
    SELECT round(m, 6) AS mape_positive, round(a, 6) AS zero_accuracy, round(0.7::DOUBLE * m + 0.3::DOUBLE * (1 - a), 6) AS score
    FROM (SELECT coalesce(avg(abs(y - p) / y) FILTER (y > 0), 0.0) AS m, avg(CASE WHEN (y > 0) = (p > 0) THEN 1.0 ELSE 0.0 END) AS a FROM demand_pred)
    """,
)
def zero_inflated_mape(t):
    return metrics.zero_inflated_mape(t.demand_predictions)


@query(
    "requirements_check",
    """
    SELECT bool_and(latency_ms < 100) AS all_latency_below_100, bool_or(accuracy > 0.85) AS any_accuracy_above_085,
           max(roc_auc) > 0.7 AS best_auc_above_07,
           (SELECT least(coalesce(avg(abs(y - p) / y * 100) FILTER (y > 0 AND p >= 0), 1000.0), 1000.0) FROM demand_pred) < 15 AS mape_below_15
    FROM model_metrics
    """,
)
def requirements_check(t):
    mape = metrics.safe_mape(t.demand_predictions).select("mape_pct").scalar()
    return metrics.requirements_check(metrics.model_metrics(t.scored), mape)


@query(
    "ctr_uplift_estimate",
    "SELECT model, round(roc_auc, 6) AS roc_auc, round((roc_auc - 0.5) * 20, 6) AS estimated_uplift_pct FROM auc",
)
def ctr_uplift_estimate(t):
    return metrics.ctr_uplift(metrics.roc_auc(t.scored))


@query(
    "performance_alerts",
    _alert_sql("WARNING", "LOW_ACCURACY", f"printf({quote(V.ACCURACY_MESSAGE)}, accuracy)", "accuracy", "accuracy",
               0.8, "class_metrics", "accuracy < 0.8", "model, ")
    + "\nUNION ALL "
    + _alert_sql("WARNING", "LOW_F1", f"printf({quote(V.F1_MESSAGE)}, f1_score)", "f1_score", "f1_score",
                 0.7, "class_metrics", "f1_score < 0.7", "model, "),
)
def performance_alerts(t):
    return alerts.performance_alerts(metrics.classification_metrics(t.scored))


def _period_metrics_sql(condition: str) -> str:
    return f"""
    (SELECT m.*, roc_auc FROM (
       SELECT model, (tn + tp) / n AS accuracy,
         (coalesce(tn / nullif(tn + fn, 0)::DOUBLE, 0) * neg + coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0) * pos) / n AS precision,
         (coalesce(tn / nullif(neg, 0)::DOUBLE, 0) * neg + coalesce(tp / nullif(pos, 0)::DOUBLE, 0) * pos) / n AS recall,
         (coalesce(2 * tn / nullif(2 * tn + fn + fp, 0)::DOUBLE, 0) * neg + coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0) * pos) / n AS f1_score
       FROM (SELECT *, tn + fp AS neg, tp + fn AS pos, (tn + fp + tp + fn)::DOUBLE AS n FROM (
         SELECT model, count(*) FILTER (y = 0 AND score <= 0.5) AS tn, count(*) FILTER (y = 0 AND score > 0.5) AS fp,
                count(*) FILTER (y = 1 AND score <= 0.5) AS fn, count(*) FILTER (y = 1 AND score > 0.5) AS tp
         FROM scored WHERE {condition} GROUP BY model))) m
     JOIN (SELECT model, sum(p * (below + n / 2.0::DOUBLE)) / (any_value(np) * any_value(nn)) AS roc_auc
           FROM (SELECT model, p, n, coalesce(sum(n) OVER (PARTITION BY model ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS below,
                        sum(p) OVER (PARTITION BY model)::DOUBLE AS np, sum(n) OVER (PARTITION BY model)::DOUBLE AS nn
                 FROM (SELECT model, score, count(*) FILTER (y = 1) AS p, count(*) FILTER (y = 0) AS n FROM scored WHERE {condition} GROUP BY 1, 2))
           GROUP BY model) USING (model))"""


@query(
    "performance_drop",
    f"""
    WITH b AS {_period_metrics_sql("event_time < TIMESTAMP '2024-01-16'")}, c AS {_period_metrics_sql("event_time >= TIMESTAMP '2024-01-16'")}
    SELECT model, metric, round(baseline, 6) AS baseline, round(current, 6) AS current, round(baseline - current, 6) AS drop, "limit",
           CASE WHEN baseline - current > "limit" THEN 1 ELSE 0 END AS alert
    FROM ("""
    + "\nUNION ALL ".join(
        f"""SELECT b.model, '{m}' AS metric, b.{m} AS baseline, c.{m} AS current, {limit}::DOUBLE AS "limit" FROM b JOIN c USING (model)"""
        for m, limit in V.METRIC_DROP_LIMITS.items()
    )
    + ")",
)
def performance_drop(t):
    split = F.lit("2024-01-16").cast("timestamp")

    def period(rows):
        counts = metrics.score_counts(rows)
        return metrics.classification_of(counts).join(metrics.auc_of(counts), "model")

    return metrics.performance_drop(
        period(t.scored.where(F.col("event_time") < split)), period(t.scored.where(F.col("event_time") >= split))
    )


@query(
    "validation_gates",
    """
    SELECT model, round(roc_auc, 6) AS roc_auc, round(ml, 6) AS mean_latency, round(p95, 6) AS p95_latency, stable, finite,
           concat_ws('; ', CASE WHEN roc_auc < 0.85 THEN 'auc below limit' END, CASE WHEN ml > 50 THEN 'latency above limit' END,
                     CASE WHEN NOT stable THEN 'predictions not repeatable' END, CASE WHEN NOT finite THEN 'score not finite' END) AS reasons,
           CASE WHEN roc_auc >= 0.85 AND ml <= 50 AND stable AND finite THEN 1 ELSE 0 END AS passed
    FROM auc JOIN (SELECT model, bool_and(lo = hi) AS stable, bool_and(isfinite(lo) AND isfinite(hi)) AS finite
                   FROM (SELECT model, event_id, min(s) AS lo, max(s) AS hi
                         FROM (SELECT model, event_id, score AS s FROM scored
                               UNION ALL SELECT model, event_id, score + CASE WHEN model = 'b' AND event_id % 1000 = 0 THEN 0.001 ELSE 0.0 END FROM scored)
                         GROUP BY 1, 2) GROUP BY model) r USING (model) JOIN (SELECT model, avg(latency) AS ml, quantile_cont(latency, 0.95) AS p95 FROM scored GROUP BY model) USING (model)
    """,
)
def validation_gates(t):
    return metrics.validation_gates(t.repeated_scores)


@query(
    "compare_two_models",
    """
    SELECT 'a' AS model_1, 'b' AS model_2, round(b.roc_auc - a.roc_auc, 6) AS auc_difference, round(b.latency_ms - a.latency_ms, 6) AS latency_difference,
           CASE WHEN b.roc_auc < a.roc_auc AND b.latency_ms > a.latency_ms THEN 'a' WHEN b.roc_auc > a.roc_auc AND b.latency_ms < a.latency_ms THEN 'b'
                WHEN a.roc_auc > b.roc_auc THEN 'a' ELSE 'b' END AS winner
    FROM model_metrics a, model_metrics b WHERE a.model = 'a' AND b.model = 'b'
    """,
)
def compare_two_models(t):
    return metrics.compare_two_models(metrics.model_metrics(t.scored), "a", "b")


# --- decision tables --------------------------------------------------------------------

@query(
    "canary_assign",
    f"SELECT request_id, CASE WHEN {id_bucket_sql('request_id', 100)} < 20 THEN 'new' ELSE 'current' END AS route FROM requests",
)
def canary_assign(t):
    return decisions.canary_assign(t.requests, 20).select("request_id", "route")


CANARY_SQL = """
    WITH l AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY model ORDER BY event_time DESC, event_id DESC) <= 100),
    m AS (SELECT avg(latency) FILTER (model = 'b') AS nm, avg(latency) FILTER (model = 'a') AS cm FROM l)
    SELECT round(nm, 6) AS new_mean_latency, round(cm, 6) AS current_mean_latency, (SELECT count(*) FROM events) AS new_requests,
           (SELECT count(*) FROM events) AS current_requests, round(nm / cm, 6) AS latency_ratio,
           CASE WHEN (SELECT count(*) FROM events) >= 10 THEN 'analysis_complete' ELSE 'insufficient_data' END AS status,
           CASE WHEN (SELECT count(*) FROM events) < 10 THEN 'continue' WHEN nm / cm > 1.2 THEN 'rollback' WHEN nm / cm < 0.9 THEN 'increase_traffic' ELSE 'continue' END AS recommendation FROM m
"""


@query("canary_decision", CANARY_SQL)
def canary_decision(t):
    return decisions.canary_decision(t.scored, "a", "b")


@query(
    "canary_next_split",
    f"""SELECT recommendation, percent, CASE recommendation WHEN 'increase_traffic' THEN least(percent + 10, 100)
               WHEN 'rollback' THEN greatest(percent - 20, 0) ELSE percent END AS next_percent
        FROM ({CANARY_SQL}), (VALUES (10), (50), (95)) AS v(percent)""",
)
def canary_next_split(t):
    decision = decisions.canary_decision(t.scored, "a", "b")
    return decision.select(
        "recommendation", F.explode(F.array(F.lit(10), F.lit(50), F.lit(95))).alias("percent")
    ).withColumn("next_percent", decisions.next_split(F.col("recommendation"), F.col("percent")))


@query(
    "shadow_recommendation",
    """
    SELECT day, n AS total_requests, round(mj, 6) AS major_rate, round(mm, 6) AS mismatch_rate,
           CASE WHEN mj < 0.01 AND mm < 0.05 THEN 'ready_for_production' WHEN mj < 0.05 AND mm < 0.1 THEN 'requires_further_testing'
                ELSE 'not_ready_high_discrepancy' END AS recommendation
    FROM (SELECT CAST(event_time AS DATE) AS day, count(*) AS n, count(*) FILTER (discrepancy_type = 'major') / count(*)::DOUBLE AS mj,
                 count(*) FILTER (binary_mismatch = 1) / count(*)::DOUBLE AS mm FROM comparison GROUP BY 1)
    """,
)
def shadow_recommendation(t):
    compared = decisions.compare_scores(t.predictions, "a", "b").withColumn("day", F.to_date("event_time"))
    return decisions.shadow_rates(compared, ["day"]).select(
        "day", "total_requests", "major_rate", "mismatch_rate", "recommendation"
    )


def _retrain_sql() -> str:
    reasons = [
        ("data_drift", "drift_score > 0.3", f"printf({quote(V.RETRAIN_DRIFT_MESSAGE)}, drift_score, '0.3')"),
        ("accuracy_drop", "accuracy_drop > 0.15", f"printf({quote(V.RETRAIN_ACCURACY_MESSAGE)}, accuracy_drop, '0.15')"),
        ("weekly_schedule", "isodow(as_of) = 1", quote(V.RETRAIN_WEEKLY_MESSAGE)),
        ("model_age", "age > 30", f"printf({quote(V.RETRAIN_AGE_MESSAGE)}, CAST(age AS VARCHAR), '30')"),
        ("new_data", "new_rows >= 1000", f"printf({quote(V.RETRAIN_NEW_DATA_MESSAGE)}, CAST(new_rows AS VARCHAR))"),
    ]
    names = ", ".join(f"CASE WHEN {cond} THEN {quote(name)} END" for name, cond, _ in reasons)
    texts = ", ".join(f"CASE WHEN {cond} THEN {text} END" for _, cond, text in reasons)
    return f"""
    WITH a AS (SELECT *, coalesce(CAST(floor(date_diff('microsecond', model_created_at, as_of) / 86400e6::DOUBLE) AS BIGINT), 365) AS age,
                      CAST(floor(date_diff('microsecond', last_retrain_at, as_of) / 86400e6::DOUBLE) AS BIGINT) AS since FROM checks),
    r AS (SELECT *, concat_ws(',', {names}) AS reasons, concat_ws('; ', {texts}) AS messages FROM a)
    SELECT check_id, as_of, age AS model_age_days, since AS days_since_last_retrain, reasons, messages,
           CASE WHEN reasons <> '' THEN 1 ELSE 0 END AS retrain_needed,
           CASE WHEN reasons <> '' AND coalesce(since < 7, false) THEN 1 ELSE 0 END AS delayed,
           CASE WHEN reasons <> '' AND NOT coalesce(since < 7, false) THEN 1 ELSE 0 END AS retrain_now FROM r
    """


@query("retrain_decision", _retrain_sql())
def retrain_decision(t):
    return decisions.retrain_decision(t.retrain_checks)


def _channel_sql() -> str:
    group = "CASE type " + " ".join(
        f"WHEN {quote(k)} THEN {quote(g)}" for k, g in alerts.ALERT_GROUP_OF_TYPE.items()
    ) + " ELSE 'system' END"
    rows = ", ".join(f"('{g}', '{c}')" for g, rule in V.ALERT_GROUPS.items() for c in rule["channels"])
    return f"""SELECT alert_id, type, a.alert_group, channel FROM (SELECT *, {group} AS alert_group FROM alerts) a
               JOIN (VALUES {rows}) AS r(alert_group, channel) ON r.alert_group = a.alert_group"""


@query("alert_routing", _channel_sql())
def alert_routing(t):
    return alerts.alert_routing(t.alerts)


@query(
    "model_age",
    """
    SELECT model_id, coalesce(CAST(floor(date_diff('microsecond', max(created_at) FILTER (stage = 'Production'), TIMESTAMP '2002-01-01') / 86400e6::DOUBLE) AS BIGINT), 365)
           AS model_age_days
    FROM versions GROUP BY model_id
    """,
)
def model_age(t):
    return decisions.model_age(t.model_versions, F.lit("2002-01-01").cast("timestamp"))


@query(
    "promote_best",
    """
    WITH r AS (SELECT o_custkey AS model_id, o_orderkey AS run_id, o_totalprice AS metric FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'),
    b AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY model_id ORDER BY metric DESC, run_id) = 1),
    v AS (SELECT model_id, version, version AS run_id, stage FROM versions WHERE created_at < TIMESTAMP '1998-01-01')
    SELECT v.model_id, v.version, v.run_id, CASE WHEN b.model_id IS NOT NULL AND v.stage = 'Production' THEN 'Archived' ELSE v.stage END AS stage
    FROM v LEFT JOIN b USING (model_id)
    UNION ALL
    SELECT b.model_id, coalesce(m, 0) + 1, b.run_id, 'Production' FROM b LEFT JOIN (SELECT model_id, max(version) AS m FROM v GROUP BY 1) USING (model_id)
    """,
)
def promote_best(t):
    cut = F.lit("1998-01-01").cast("timestamp")
    runs = (
        t.raw("orders")
        .where(F.col("o_orderdate").cast("timestamp") >= cut)
        .select(
            F.col("o_custkey").alias("model_id"),
            F.col("o_orderkey").alias("run_id"),
            F.col("o_totalprice").alias("metric"),
        )
    )
    versions = t.model_versions.where(F.col("created_at") < cut).select(
        "model_id", "version", F.col("version").alias("run_id"), "stage"
    )
    return decisions.promote_best(runs, versions)


# --- splits -------------------------------------------------------------------------------

@query(
    "random_split",
    f"SELECT event_id, CASE WHEN {id_bucket_sql('event_id', 1000)} < 700 THEN 'train' ELSE 'test' END AS split FROM event_log",
)
def random_split(t):
    return sampling.random_split(t.event_log, "event_id").select("event_id", "split")


@query(
    "random_split_80",
    f"SELECT event_id, CASE WHEN {id_bucket_sql('event_id', 1000)} < 800 THEN 'train' ELSE 'test' END AS split FROM event_log",
)
def random_split_80(t):
    return sampling.random_split(t.event_log, "event_id", train_share=0.8).select("event_id", "split")


@query(
    "stratified_split",
    f"""
    WITH b AS (SELECT event_id, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS target, {id_bucket_sql('event_id', 2**31)} AS h FROM event_log)
    SELECT event_id, target, CASE WHEN row_number() OVER (PARTITION BY target ORDER BY h, event_id)
             <= round(count(*) OVER (PARTITION BY target) * 0.7::DOUBLE) THEN 'train' ELSE 'test' END AS split FROM b
    """,
)
def stratified_split(t):
    labelled = t.event_log.select(
        "event_id", F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("target")
    )
    return sampling.stratified_split(labelled, "event_id", "target")


@query(
    "standard_scale",
    "SELECT "
    + ", ".join(
        f"round(({c} - (SELECT avg({c}) FROM lineitem)) / (SELECT stddev_pop({c}) FROM lineitem), 6) + 0.0::DOUBLE AS {c}"
        for c in ("l_quantity", "l_extendedprice", "l_discount")
    )
    + " FROM lineitem",
)
def standard_scale(t):
    from ..operators.features import standard_scale as scale

    columns = ["l_quantity", "l_extendedprice", "l_discount"]
    return scale(t.raw("lineitem").select(*columns), columns)
