import numpy as np
import pytest

from basketry.operators import metrics, ranking


def scored(spark, rows):
    return spark.createDataFrame(rows, "model string, y int, score double, latency double")


def test_auc_counts_ties_half_and_handles_one_class(spark):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 3000)
    s = np.round(rng.random(3000) * 0.5 + y * 0.2, 2)
    rows = [("m", int(a), float(b), 1.0) for a, b in zip(y, s)]
    rows += [("one", 1, 0.3, 1.0), ("one", 1, 0.4, 1.0), ("none", 0, None, 1.0), ("tied", 0, 0.5, 1.0), ("tied", 1, 0.5, 1.0)]
    got = {r["model"]: r["roc_auc"] for r in metrics.roc_auc(scored(spark, rows)).collect()}
    pos, neg = s[y == 1], s[y == 0]
    expected = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert got["m"] == pytest.approx(expected, abs=1e-12)
    assert got["one"] == got["none"] == got["tied"] == 0.5


def test_auc_equals_spark_evaluator(spark, tables):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.sql import functions as F

    rows = tables.scored.where("model = 'a'").select("model", F.col("y").cast("double").alias("label"), "score", "latency", "y")
    theirs = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(rows)
    assert metrics.roc_auc(rows).first()["roc_auc"] == pytest.approx(theirs, abs=1e-9)


def test_weighted_metrics_equal_spark_evaluator(spark, tables):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.sql import functions as F

    rows = tables.scored.where("model = 'b'")
    got = metrics.classification_metrics(rows).first()
    frame = rows.select(F.col("y").cast("double").alias("label"), (F.col("score") > 0.5).cast("double").alias("prediction"))
    for ours, theirs in [("accuracy", "accuracy"), ("precision", "weightedPrecision"), ("recall", "weightedRecall"), ("f1_score", "f1")]:
        value = MulticlassClassificationEvaluator(metricName=theirs).evaluate(frame)
        assert got[ours] == pytest.approx(value, abs=1e-9)


def test_zero_denominators(spark):
    rows = [("m", 0, 0.1, 1.0), ("m", 0, 0.2, 1.0)]
    got = metrics.classification_metrics(scored(spark, rows)).first()
    assert (got["accuracy"], got["precision"], got["recall"], got["f1_score"]) == (1.0, 1.0, 1.0, 1.0)
    only_positive = metrics.confusion_counts(scored(spark, [("m", 1, 0.9, 1.0)])).first()
    assert only_positive["specificity"] == 0.0


def pairs(spark, rows):
    return spark.createDataFrame(rows, "y double, p double")


def test_regression_metrics(spark):
    got = metrics.regression_metrics(pairs(spark, [(1.0, 2.0), (3.0, 3.0), (5.0, 4.0)])).first()
    assert got["mae"] == pytest.approx(2 / 3)
    assert got["rmse"] == pytest.approx((2 / 3) ** 0.5)
    assert got["r2"] == pytest.approx(1 - 2 / 8)
    assert metrics.regression_metrics(pairs(spark, [(2.0, 1.0), (2.0, 3.0)])).first()["r2"] == 0.0


def test_safe_mape_limits(spark):
    assert metrics.safe_mape(pairs(spark, [(0.0, 1.0), (1.0, -1.0), (1e11, 1.0)])).first()[:] == (1000.0, 0)
    assert metrics.safe_mape(pairs(spark, [(1.0, 100.0)])).first()["mape_pct"] == 1000.0
    assert metrics.safe_mape(pairs(spark, [(2.0, 1.0), (4.0, 4.0)])).first()["mape_pct"] == 25.0


def test_zero_inflated_mape(spark):
    got = metrics.zero_inflated_mape(pairs(spark, [(2.0, 1.0), (0.0, 0.0), (0.0, 1.0), (4.0, 4.0)])).first()
    assert got["score"] == pytest.approx(0.7 * 0.25 + 0.3 * 0.25)


def test_validation_gates_reasons(spark):
    schema = "model string, request_id long, repeat int, y int, score double, latency double"
    rows = []
    for r in (1, 2):
        rows += [("good", 1, r, 1, 0.9, 10.0), ("good", 2, r, 0, 0.1, 10.0)]
        rows += [("slow", 1, r, 1, 0.9, 100.0), ("slow", 2, r, 0, 0.1, 100.0)]
        rows += [("shaky", 1, r, 1, 0.9 - r / 100, 10.0), ("shaky", 2, r, 0, 0.1, 10.0)]
        rows += [("broken", 1, r, 1, float("inf"), 10.0), ("broken", 2, r, 0, 0.1, 10.0)]
        rows += [("wrong", 1, r, 1, 0.1, 10.0), ("wrong", 2, r, 0, 0.9, 10.0)]
    got = {r["model"]: r for r in metrics.validation_gates(spark.createDataFrame(rows, schema)).collect()}
    assert got["good"]["passed"] == 1
    assert got["slow"]["reasons"] == "latency above limit"
    assert got["shaky"]["reasons"] == "predictions not repeatable"
    assert got["broken"]["reasons"] == "score not finite"
    assert got["wrong"]["reasons"] == "auc below limit"


@pytest.mark.parametrize(
    "a, b, winner",
    [((0.9, 10), (0.8, 20), "a"), ((0.8, 20), (0.9, 10), "b"), ((0.9, 30), (0.8, 10), "a"), ((0.8, 10), (0.8, 20), "b")],
)
def test_winner(spark, a, b, winner):
    board = spark.createDataFrame([("a", *map(float, a)), ("b", *map(float, b))], "model string, roc_auc double, latency_ms double")
    assert metrics.compare_two_models(board, "a", "b").first()["winner"] == winner


def test_performance_drop_limits(spark):
    names = "model string, accuracy double, precision double, recall double, f1_score double, roc_auc double"
    base = spark.createDataFrame([("m", 0.9, 0.9, 0.9, 0.9, 0.9)], names)
    now = spark.createDataFrame([("m", 0.75, 0.8, 0.74, 0.85, 0.84)], names)
    got = {r["metric"]: r["alert"] for r in metrics.performance_drop(base, now).collect()}
    assert got == {"accuracy": 1, "precision": 0, "recall": 1, "f1_score": 0, "roc_auc": 1}


def test_best_by_error_skips_outliers_and_breaks_ties(spark):
    df = spark.createDataFrame([("c", 5.0), ("b", 5.0), ("x", 1001.0)], "model string, mape double")
    assert ranking.best_by_error(df).first()["model"] == "b"
    assert ranking.best_by_error(df.where("model = 'x'")).count() == 0


def test_best_run_tie_goes_to_the_lower_id(spark):
    df = spark.createDataFrame([(1, "e", 0.5), (2, "e", 0.9), (3, "e", 0.9), (4, "f", 0.7)], "run_id long, experiment string, metric double")
    got = {r["experiment"]: (r["run_id"], r["is_best_overall"]) for r in ranking.best_run_per_experiment(df).collect()}
    assert got == {"e": (2, 1), "f": (4, 0)}
