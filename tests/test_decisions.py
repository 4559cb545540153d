import datetime as dt

import pytest
from pyspark.sql import functions as F

from basketry.functions import expressions as X
from basketry.functions import fixed_values as V
from basketry.operators import alerts, decisions, features

T0 = dt.datetime(2024, 1, 2)  # a Tuesday


def test_request_time_features(spark):
    df = spark.createDataFrame(
        [(14, 2, 29.99, 100, 50, 10)],
        "hour int, day_of_week int, price double, user_total_views long, product_total_views long, user_product_view_count long",
    )
    row = features.on_demand_features(df).first()
    assert row["hour_sin"] == pytest.approx(-0.5)
    assert row["hour_cos"] == pytest.approx(-0.8660254037844386)
    assert row["is_weekend"] == 0
    assert row["user_product_affinity"] == pytest.approx(10 / 5001**0.5)
    assert row["price_normalized"] == 1.0


def test_request_time_defaults_without_stored_features(spark):
    df = spark.createDataFrame([(0, 5, 10.0), (0, 6, 20.0)], "hour int, day_of_week int, price double")
    rows = features.on_demand_features(df, max_price=40.0).orderBy("price").collect()
    assert [r["user_product_affinity"] for r in rows] == [0.0, 0.0]
    assert [r["price_normalized"] for r in rows] == [0.25, 0.5]
    assert rows[0]["composite_score"] == pytest.approx(0.2 * 0.75)
    assert [r["is_weekend"] for r in rows] == [1, 1]


def test_discrepancy_boundaries(spark):
    df = spark.createDataFrame([(0.0099,), (0.01,), (0.0999,), (0.1,)], "d double")
    got = [r[0] for r in df.select(X.discrepancy_type("d")).collect()]
    assert got == ["minor", "moderate", "moderate", "major"]


def test_id_bucket_is_even_and_independent_of_the_seed(spark):
    df = spark.range(200_000).select(X.id_bucket("id", 10).alias("a"), X.id_bucket("id", 10, 7).alias("b"))
    cells = {(r["a"], r["b"]): r["count"] for r in df.groupBy("a", "b").count().collect()}
    assert len(cells) == 100
    assert max(abs(n - 2000) for n in cells.values()) < 400
    odd = spark.range(0, 200_000, 50).select(X.id_bucket("id", 10).alias("a")).groupBy("a").count().collect()
    assert len(odd) == 10 and max(abs(r["count"] - 400) for r in odd) < 120


def test_id_bucket_takes_very_large_ids(spark):
    df = spark.createDataFrame([(2**62 + 5,), (2**63 - 1,), (0,), (-7,)], "id long")
    assert all(0 <= r[0] < 1000 for r in df.select(X.id_bucket("id", 1000)).collect())


def latencies(spark, current, new):
    rows = [("current", T0 + dt.timedelta(seconds=i), i, float(v)) for i, v in enumerate(current)]
    rows += [("new", T0 + dt.timedelta(seconds=i), i, float(v)) for i, v in enumerate(new)]
    return spark.createDataFrame(rows, "model string, event_time timestamp, event_id long, latency double")


@pytest.mark.parametrize(
    "current, new, status, recommendation",
    [
        ([100] * 50, [200] * 9, "insufficient_data", "continue"),
        ([100] * 50, [121] * 20, "analysis_complete", "rollback"),
        ([100] * 50, [120] * 20, "analysis_complete", "continue"),
        ([100] * 50, [89] * 20, "analysis_complete", "increase_traffic"),
        ([0] * 50, [500] * 20, "analysis_complete", "continue"),
        ([100] * 50, [500] * 50 + [100] * 100, "analysis_complete", "continue"),
    ],
)
def test_canary(spark, current, new, status, recommendation):
    row = decisions.canary_decision(latencies(spark, current, new), "current", "new").first()
    assert (row["status"], row["recommendation"]) == (status, recommendation)


def test_next_split_stays_in_range(spark):
    df = spark.createDataFrame(
        [("increase_traffic", 95), ("rollback", 10), ("continue", 40), ("rollback", 50)], "r string, p int"
    )
    got = [r[0] for r in df.select(decisions.next_split(F.col("r"), F.col("p"))).collect()]
    assert got == [100, 0, 40, 30]


def check(spark, **values):
    row = dict(check_id="c", as_of=T0, drift_score=0.0, accuracy_drop=0.0, new_rows=0, model_created_at=T0, last_retrain_at=None)
    row.update(values)
    schema = ("check_id string, as_of timestamp, drift_score double, accuracy_drop double, new_rows long, "
              "model_created_at timestamp, last_retrain_at timestamp")
    return decisions.retrain_decision(spark.createDataFrame([tuple(row.values())], schema)).first()


def test_retrain_reasons(spark):
    assert check(spark)["retrain_needed"] == 0
    assert check(spark, drift_score=0.31)["reasons"] == "data_drift"
    assert check(spark, drift_score=0.3)["reasons"] == ""
    assert check(spark, accuracy_drop=0.16)["reasons"] == "accuracy_drop"
    assert check(spark, as_of=T0 - dt.timedelta(days=1))["reasons"] == "weekly_schedule"
    assert check(spark, model_created_at=T0 - dt.timedelta(days=31))["reasons"] == "model_age"
    assert check(spark, model_created_at=T0 - dt.timedelta(days=30))["reasons"] == ""
    assert check(spark, model_created_at=None)["model_age_days"] == 365
    assert check(spark, new_rows=1000)["reasons"] == "new_data"


def test_retrain_delay(spark):
    soon = check(spark, drift_score=0.5, last_retrain_at=T0 - dt.timedelta(days=6, hours=23))
    assert (soon["retrain_needed"], soon["delayed"], soon["retrain_now"]) == (1, 1, 0)
    later = check(spark, drift_score=0.5, last_retrain_at=T0 - dt.timedelta(days=7))
    assert (later["delayed"], later["retrain_now"]) == (0, 1)


def test_shadow_recommendation(spark):
    df = spark.createDataFrame([(0.009, 0.049), (0.01, 0.0), (0.049, 0.099), (0.05, 0.0), (0.0, 0.1)], "m double, b double")
    got = [r[0] for r in df.select(decisions.shadow_recommendation(F.col("m"), F.col("b"))).collect()]
    assert got == ["ready_for_production", "requires_further_testing", "requires_further_testing",
                   "not_ready_high_discrepancy", "not_ready_high_discrepancy"]


def test_promotion_archives_only_models_with_a_new_run(spark):
    runs = spark.createDataFrame([(1, 10, 0.5), (1, 11, 0.7), (3, 12, 0.1)], "model_id long, run_id long, metric double")
    versions = spark.createDataFrame(
        [(1, 1, 5, "Production"), (1, 2, 6, "None"), (2, 1, 7, "Production")], "model_id long, version long, run_id long, stage string"
    )
    got = sorted(map(tuple, decisions.promote_best(runs, versions).collect()))
    assert got == [(1, 1, 5, "Archived"), (1, 2, 6, "None"), (1, 3, 11, "Production"), (2, 1, 7, "Production"), (3, 1, 12, "Production")]


ALERTS = "alert_id long, alert_time timestamp, level string, type string, message string, metric string, value double, threshold double, context map<string,string>"


def test_alert_text(spark):
    rows = [
        (1, T0, "CRITICAL", "DATA_DRIFT", "PSI is high", "psi", 0.25, 0.2, {"feature": "price"}),
        (2, T0, None, "SOMETHING", None, None, None, None, None),
    ]
    text = {r["alert_id"]: r["text"] for r in alerts.alert_message(spark.createDataFrame(rows, ALERTS)).collect()}
    assert text[1].splitlines()[:6] == [
        V.ALERT_TITLE, "", "*Время:* 2024-01-02 00:00:00", "*Уровень:* CRITICAL", "*Тип:* DATA_DRIFT", "*Сообщение:* PSI is high",
    ]
    assert "*Метрика:* psi\n*Текущее значение:* 0.25\n*Порог:* 0.2\n\n*Контекст:*\n  feature: price\n\n*Рекомендации:*\n" in text[1]
    assert text[1].endswith(V.ADVICE["DATA_DRIFT"])
    assert "*Уровень:* UNKNOWN" in text[2] and "No message" in text[2] and "*Метрика:*" not in text[2]
    assert "*Контекст:*" not in text[2] and text[2].endswith(V.DEFAULT_ADVICE)


def test_disabled_group_sends_nothing(spark):
    rows = [(1, T0, "INFO", "DATA_DRIFT", "m", None, None, None, None), (2, T0, "INFO", "DISK", "m", None, None, None, None)]
    df = spark.createDataFrame(rows, ALERTS)
    groups = {**V.ALERT_GROUPS, "system": {**V.ALERT_GROUPS["system"], "enabled": False}}
    got = sorted((r["alert_id"], r["channel"]) for r in alerts.alert_routing(df, groups).collect())
    assert got == [(1, "email"), (1, "slack")]
