import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.functions.fixed_values import MODEL_FEATURES
from basketry.operators import features, learning, sampling

QUICK = learning.Effort(
    linear_rounds=10, trees=5, tree_depth=4, demand_trees=5, demand_depth=4, boosting_rounds=3, kernel_features=32
)


def test_stratified_split_keeps_shares(spark):
    df = spark.range(50_000).select(F.col("id"), F.when(F.col("id") % 10 == 0, 1).otherwise(0).alias("y"))
    split = sampling.stratified_split(df, "id", "y")
    shares = {r["y"]: r["s"] for r in split.groupBy("y").agg(F.avg((F.col("split") == "train").cast("int")).alias("s")).collect()}
    assert shares[0] == pytest.approx(0.7, abs=0.01) and shares[1] == pytest.approx(0.7, abs=0.01)
    assert split.count() == 50_000 and set(split.columns) == {"id", "y", "split"}


def test_split_is_the_same_after_repartitioning(spark):
    df = spark.range(2000).toDF("id")
    a = sampling.random_split(df, "id").where("split = 'train'")
    b = sampling.random_split(df.repartition(13), "id").where("split = 'train'")
    assert sorted(a.collect()) == sorted(b.collect())
    assert a.count() == pytest.approx(1400, abs=80)


def minority_frame(spark, minority, majority):
    rows = [(i, float(x), float(y), 1) for i, (x, y) in enumerate(minority)]
    rows += [(10_000 + i, float(x), float(y), 0) for i, (x, y) in enumerate(majority)]
    return spark.createDataFrame(rows, "event_id long, a double, b double, target int")


def test_oversampling_balances_and_stays_between_minority_rows(spark):
    rng = np.random.default_rng(6)
    minority = rng.uniform(0, 1, (60, 2))
    df = minority_frame(spark, minority, rng.uniform(5, 6, (500, 2)))
    out = sampling.smote_oversample(df, ["a", "b"])
    counts = {(r["target"], r["is_synthetic"]): r["count"] for r in out.groupBy("target", "is_synthetic").count().collect()}
    assert counts == {(1, 0): 60, (0, 0): 500, (1, 1): 440}
    made = np.array([(r["a"], r["b"]) for r in out.where("is_synthetic = 1").collect()])
    low, high = minority.min(axis=0), minority.max(axis=0)
    assert (made >= low - 1e-9).all() and (made <= high + 1e-9).all()
    # Every synthetic row lies on a segment to one of the five nearest neighbours.
    gaps = np.linalg.norm(minority[:, None] - minority[None, :], axis=2)
    np.fill_diagonal(gaps, np.inf)
    near = np.argsort(gaps, axis=1)[:, :5]
    for point in made:
        on_segment = False
        for i in range(60):
            for j in near[i]:
                d = minority[j] - minority[i]
                t = np.clip((point - minority[i]) @ d / (d @ d), 0, 1)
                on_segment |= np.linalg.norm(minority[i] + t * d - point) < 1e-7
        assert on_segment


def test_oversampling_with_a_vector_held_by_most_minority_rows(spark):
    rng = np.random.default_rng(7)
    minority = np.concatenate([np.tile([[0.5, 0.5]], (80, 1)), rng.uniform(0, 1, (20, 2))])
    df = minority_frame(spark, minority, rng.uniform(5, 6, (1000, 2)))
    out = sampling.smote_oversample(df, ["a", "b"])
    assert out.where("target = 1").count() == out.where("target = 0").count() == 1000
    # A copy's five nearest neighbours are copies, so its synthetic rows repeat it.
    assert out.where("is_synthetic = 1 AND a = 0.5 AND b = 0.5").count() >= 720


def test_oversampling_of_a_single_minority_row(spark):
    df = minority_frame(spark, [(0.1, 0.2)], [(5.0, 5.0)] * 4)
    out = sampling.smote_oversample(df, ["a", "b"]).where("is_synthetic = 1").collect()
    assert [(r["a"], r["b"]) for r in out] == [(0.1, 0.2)] * 3


@pytest.fixture(scope="module")
def training(tables):
    return learning.classification_set(
        features.model_features(tables.shop_events), oversample=False, exact_shares=False
    )


def test_default_training_set_is_stratified_and_balanced(tables):
    data = learning.classification_set(features.model_features(tables.shop_events))
    classes = {r["target"]: r["count"] for r in data.train.groupBy("target").count().collect()}
    assert classes[0] == classes[1]
    whole = features.model_features(tables.shop_events).groupBy("target").count().collect()
    held = {r["target"]: r["count"] for r in data.test.groupBy("target").count().collect()}
    for r in whole:  # 256 strata, each off by at most half a row
        assert abs(held[r["target"]] - 0.3 * r["count"]) <= 128


def test_training_parts_are_disjoint_and_complete(training, tables):
    a, b = training.train.select("event_id"), training.test.select("event_id")
    assert a.join(b, "event_id").count() == 0
    assert a.count() + b.count() == tables.event_log.count()


def test_training_columns_are_scaled_on_the_training_part(training):
    row = training.train.agg(*[F.avg(c) for c in MODEL_FEATURES], *[F.stddev_pop(c) for c in MODEL_FEATURES]).first()
    means, stds = row[: len(MODEL_FEATURES)], row[len(MODEL_FEATURES):]
    assert all(abs(m) < 1e-9 for m in means)
    assert all(s == pytest.approx(1.0) or s == pytest.approx(0.0) for s in stds)


def test_class_weights_balance(training):
    sums = {r["target"]: r["s"] for r in training.train.groupBy("target").agg(F.sum("weight").alias("s")).collect()}
    assert sums[0] == pytest.approx(sums[1])


def test_leaderboard_of_four_models(training):
    board = learning.train_compare(training, QUICK, ["logistic_regression", "random_forest", "rbf_svm", "boosted_depth6_weighted"]).collect()
    assert [r["rank"] for r in sorted(board, key=lambda r: -r["roc_auc"])] == [1, 2, 3, 4]
    assert all(0 <= r["accuracy"] <= 1 for r in board)
    assert all(0 <= r["roc_auc"] <= 1 for r in board)
    assert all(r["tn"] + r["fp"] + r["fn"] + r["tp"] == training.test.count() for r in board)
    assert all(0 <= r["specificity"] <= 1 for r in board)


def test_importances_are_sorted_and_sum_to_one(training):
    rows = learning.feature_importance(learning.fit(training, learning.forest(QUICK)), MODEL_FEATURES).collect()
    values = [r["importance"] for r in rows]
    assert values == sorted(values, reverse=True) and sum(values) == pytest.approx(1.0)


def test_two_stage_predictions(tables):
    data = learning.demand_set(tables.demand_set)
    rows = learning.two_stage_demand(data, QUICK).collect()
    assert len(rows) == data.test.count() and all(r["p"] >= 0 for r in rows)


def test_batch_score_answers_every_request_once(tables):
    from basketry.session import materialize

    users = materialize(tables.online_users, "users")
    model = learning.scoring_model(tables.event_log, users, QUICK)
    out = learning.batch_score(tables.requests, users, model)
    assert out.count() == out.select("request_id").distinct().count() == tables.requests.count()
    bad = out.where("error is not null")
    assert bad.count() > 0 and bad.where("prediction is not null").count() == 0
    assert out.where("error is null and not (probability between 0 and 1)").count() == 0
    assert out.where("error is null and prediction <> cast(probability > 0.5 as int)").count() == 0


def test_a_training_set_leaves_only_its_two_tables(spark, tables):
    import os

    from basketry.session import FILE_CLEANUP, shared_dir

    rows = features.model_features(tables.shop_events)
    folder = os.path.join(shared_dir(spark), "basketry")
    before = set(os.listdir(folder))
    data = learning.classification_set(rows)
    left = set(os.listdir(folder)) - before
    assert sorted(name.rsplit("-", 1)[0] for name in left) == ["test", "train"]
    assert data.train.count() == data.train_rows and data.test.count() > 0
    # Outside of the step the session is as before.
    assert spark.conf.get(FILE_CLEANUP, "false") == "false"


def test_trees_learn_in_no_more_partitions_than_cores(spark, monkeypatch):
    assert [learning.partitions(n, True, 8) for n in (0, 20_000, 335_000, 10_000_000)] == [1, 2, 8, 20]
    assert learning.partitions(335_000, False, 8) == 34
    seen = []
    kept = learning.kept
    monkeypatch.setattr(learning, "kept", lambda df, parts: seen.append(parts) or kept(df, parts))
    rows = spark.range(200).select(
        F.rand(1).alias("a"), (F.col("id") % 2).cast("int").alias("target"), F.lit(1.0).alias("weight")
    )
    data = learning.TrainingSet(rows, rows, ["a"], 100 * learning.TRAIN_PARTITION_ROWS)
    for estimator in (learning.forest(QUICK), learning.boosted(QUICK, "boosted_depth6"), learning.logistic(QUICK, 200)):
        learning.fit(data, estimator)
    cores = spark.sparkContext.defaultParallelism
    assert seen == [max(2, cores), max(2, cores), 100]


def test_kernel_machine_keeps_no_mapped_rows(spark):
    numbers = [F.sin(F.col("id") * (i + 1)).alias(f"x{i}") for i in range(4)]
    train = spark.range(6000).select(*numbers, (F.col("id") % 2).alias("target"), F.lit(1.0).alias("weight"))
    data = learning.TrainingSet(train, train, [f"x{i}" for i in range(4)], 6000)
    held, fitted = [], threading.Event()

    def watch():
        while not fitted.wait(0.02):
            held.append(sum(r.memSize() + r.diskSize() for r in spark.sparkContext._jsc.sc().getRDDStorageInfo()))

    before = sum(r.memSize() + r.diskSize() for r in spark.sparkContext._jsc.sc().getRDDStorageInfo())
    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        learning.fit(data, learning.kernel_svm(learning.Effort(linear_rounds=10, kernel_features=512), 6000))
    finally:
        fitted.set()
        watcher.join()
    # A mapped row has 4096 bytes.
    assert 0 < max(held) - before < 6000 * 512
