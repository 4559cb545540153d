"""Alert rows from metric rows, their text, advice, routing and summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V


def _alert(level: str, kind: str, message: Column, metric: str, value: Column, threshold: float) -> Column:
    return F.struct(
        F.lit(level).alias("level"),
        F.lit(kind).alias("type"),
        message.alias("message"),
        F.lit(metric).alias("metric"),
        value.cast("double").alias("value"),
        F.lit(float(threshold)).alias("threshold"),
    )


def _rules(df: DataFrame, keep: list[str], rules: list[tuple[Column, Column]]) -> DataFrame:
    """One alert row per rule that fires; every rule is (condition, alert)."""
    fired = F.array_compact(F.array(*[F.when(condition, alert) for condition, alert in rules]))
    return df.select(*keep, F.inline(fired))


def data_alerts(summary: DataFrame) -> DataFrame:
    """Alerts for one ``drift_summary`` row."""
    score, drifted = F.col("drift_score"), F.col("drifted_columns")
    missing, ranges = F.col("max_missing_rate"), F.col("range_violations")
    return _rules(
        summary,
        [],
        [
            (
                score > V.PSI_LIMIT,
                _alert("CRITICAL", "DATA_DRIFT",
                       F.format_string(V.DRIFT_MESSAGE, score, F.lit(str(V.PSI_LIMIT))),
                       "drift_score", score, V.PSI_LIMIT),
            ),
            (
                drifted > 0,
                _alert("WARNING", "COLUMN_DRIFT",
                       F.format_string(V.COLUMN_DRIFT_MESSAGE, drifted.cast("string")),
                       "drifted_columns", drifted, 0),
            ),
            (
                missing > V.MISSING_LIMIT,
                _alert("WARNING", "MISSING_VALUES",
                       F.format_string(V.MISSING_MESSAGE, missing, F.lit(str(V.MISSING_LIMIT))),
                       "max_missing_rate", missing, V.MISSING_LIMIT),
            ),
            (
                ranges > 0,
                _alert("WARNING", "VALUE_RANGE",
                       F.format_string(V.RANGE_MESSAGE, ranges.cast("string")),
                       "range_violations", ranges, 0),
            ),
        ],
    )


def performance_alerts(metrics: DataFrame) -> DataFrame:
    accuracy, f1 = F.col("accuracy"), F.col("f1_score")
    return _rules(
        metrics,
        ["model"],
        [
            (
                accuracy < V.ACCURACY_FLOOR,
                _alert("WARNING", "LOW_ACCURACY", F.format_string(V.ACCURACY_MESSAGE, accuracy),
                       "accuracy", accuracy, V.ACCURACY_FLOOR),
            ),
            (
                f1 < V.F1_FLOOR,
                _alert("WARNING", "LOW_F1", F.format_string(V.F1_MESSAGE, f1),
                       "f1_score", f1, V.F1_FLOOR),
            ),
        ],
    )


def _lookup(table: dict[str, str], key: Column, default: str) -> Column:
    entries = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(F.try_element_at(entries, key), F.lit(default))


def advice(kind: Column) -> Column:
    return _lookup(V.ADVICE, kind, V.DEFAULT_ADVICE)


def colour(level: Column) -> Column:
    return _lookup(V.LEVEL_COLOURS, level, V.DEFAULT_COLOUR)


def alert_advice(alerts: DataFrame) -> DataFrame:
    return alerts.select(
        "alert_id", "type", "level", advice(F.col("type")).alias("advice"), colour(F.col("level")).alias("colour")
    )


def alert_text(default_type: str = "monitoring") -> Column:
    """Header, level, type and message; metric block and context if present; advice."""
    kind = F.coalesce("type", F.lit(default_type))
    has_metric = F.col("metric").isNotNull() & F.col("value").isNotNull() & F.col("threshold").isNotNull()

    def line(label: str, value: Column) -> Column:
        return F.concat(F.lit(label), value)

    header = F.array(
        F.lit(V.ALERT_TITLE),
        F.lit(""),
        line(V.TIME_LABEL, F.date_format("alert_time", "yyyy-MM-dd HH:mm:ss")),
        line(V.LEVEL_LABEL, F.coalesce("level", F.lit("UNKNOWN"))),
        line(V.TYPE_LABEL, kind),
        line(V.MESSAGE_LABEL, F.coalesce("message", F.lit("No message"))),
        F.lit(""),
    )
    metric = F.when(
        has_metric,
        F.array(
            line(V.METRIC_LABEL, F.col("metric")),
            line(V.VALUE_LABEL, F.col("value").cast("string")),
            line(V.THRESHOLD_LABEL, F.col("threshold").cast("string")),
            F.lit(""),
        ),
    )
    context = F.when(
        F.col("context").isNotNull(),
        F.concat(
            F.array(F.lit(V.CONTEXT_LABEL)),
            F.transform(
                F.map_entries("context"), lambda e: F.concat(F.lit("  "), e["key"], F.lit(": "), e["value"])
            ),
            F.array(F.lit("")),
        ),
    )
    nothing = F.array().cast("array<string>")
    closing = F.array(F.lit(V.ADVICE_LABEL), advice(kind))
    return F.array_join(
        F.concat(header, F.coalesce(metric, nothing), F.coalesce(context, nothing), closing), "\n"
    )


def alert_message(alerts: DataFrame) -> DataFrame:
    return alerts.select("alert_id", alert_text().alias("text"))


ALERT_GROUP_OF_TYPE = {
    "DATA_DRIFT": "data_drift",
    "COLUMN_DRIFT": "data_drift",
    "MISSING_VALUES": "data_drift",
    "VALUE_RANGE": "data_drift",
    "PREDICTION_DRIFT": "data_drift",
    "ACCURACY_DROP": "model_performance",
    "CONCEPT_DRIFT": "model_performance",
    "LOW_ACCURACY": "model_performance",
    "LOW_F1": "model_performance",
    "RETRAIN": "retrain",
}


def alert_routing(alerts: DataFrame, groups: dict = V.ALERT_GROUPS) -> DataFrame:
    """(alert_id, type, alert_group, channel) for every channel of an enabled group."""
    channels = F.create_map(
        *[
            x
            for name, rule in groups.items()
            if rule["enabled"]
            for x in (F.lit(name), F.array(*[F.lit(c) for c in rule["channels"]]))
        ]
    )
    return alerts.withColumn("alert_group", _lookup(ALERT_GROUP_OF_TYPE, F.col("type"), "system")).select(
        "alert_id", "type", "alert_group",
        F.explode(F.try_element_at(channels, F.col("alert_group"))).alias("channel"),
    )


def alert_summary(alerts: DataFrame) -> DataFrame:
    """Counts by level, counts by type and the ten newest alerts, as one row."""
    total = F.count(F.lit(1)).alias("total")

    def of_level(level: str) -> Column:
        return F.count_if(F.col("level") == level).alias(level.lower())

    by_type = (
        alerts.groupBy("type")
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.array_sort(F.collect_list(F.concat_ws(":", "type", F.col("n").cast("string")))).alias("by_type"))
        .scalar()
    )
    newest = (
        alerts.orderBy(F.desc("alert_time"), F.desc("alert_id"))
        .limit(10)
        .agg(F.reverse(F.array_sort(F.collect_list(F.struct("alert_time", "alert_id")))).alias("newest"))
        .select(F.array_join(F.col("newest.alert_id").cast("array<string>"), ","))
        .scalar()
    )
    return alerts.agg(total, of_level("CRITICAL"), of_level("WARNING"), of_level("INFO")).select(
        "*",
        F.array_join(by_type, ",").alias("by_type"),
        newest.alias("latest_ids"),
    )
