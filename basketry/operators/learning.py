"""Spark ML training, evaluation and scoring for the purchase and the demand model.

Learners read their input once per pass, hundreds of times in all: it is assembled once,
kept in memory and on disk (and is recomputed from a written table if an executor is
lost), in partitions in proportion to its rows, for trees and the kernel machine about one for each core.  Independent fits run side by side.
"""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from typing import Callable

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..functions.fixed_values import DEMAND_FEATURES, MODEL_FEATURES
from ..session import materialize, scratch, shared_dir
from . import cleaning, joins, metrics, ranking
from .features import ENCODED, standard_scale
from .history import ordered_target_statistics, target_statistics
from .kernel import KernelSVC
from .sampling import random_split, smote_oversample, stratified_split

#: Rows of a partition of the learners' input.
TRAIN_PARTITION_ROWS = 10_000
#: For trees and the kernel machine: rows of a partition where there are more than one for each core.
FEW_PARTITION_ROWS = 500_000
#: Fits that run at the same time.
FITS = 4
TARGET_STATISTICS = [f"{c}_ts" for c in ENCODED]


@dataclass(frozen=True)
class Effort:
    """Rounds and sizes of the iterative learners; the defaults are the full sizes."""

    linear_rounds: int = 1000
    trees: int = 200
    tree_depth: int = 15
    demand_trees: int = 100
    demand_depth: int = 10
    boosting_rounds: int = 200
    kernel_features: int = 256


# Boosting presets, fixed values: depth, learning rate, row subsampling.  ``categories`` adds the label's ordered
# statistics of the encoded categories to the inputs.
BOOSTING = {
    "boosted_depth6": dict(maxDepth=6, stepSize=0.1, subsamplingRate=1.0),
    "boosted_depth6_weighted": dict(maxDepth=6, stepSize=0.1, subsamplingRate=1.0, weighted=True, categories=True),
    "boosted_depth5_subsampled": dict(maxDepth=5, stepSize=0.1, subsamplingRate=0.8),
    "boosted_depth7": dict(maxDepth=7, stepSize=0.1, subsamplingRate=1.0),
}


# --- data for training ----------------------------------------------------------

def weighted(df: DataFrame, label: str = "target") -> DataFrame:
    """Adds the balanced class weight n / (classes * n_class)."""
    totals = df.agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("pos"))
    ).scalar()
    own = F.when(F.col(label) == 1, F.col("_t.pos")).otherwise(F.col("_t.n") - F.col("_t.pos"))
    return (
        df.withColumn("_t", totals)
        .withColumn("weight", F.coalesce(F.try_divide(F.col("_t.n"), 2 * own), F.lit(1.0)))
        .drop("_t")
    )


@dataclass(frozen=True)
class TrainingSet:
    train: DataFrame
    test: DataFrame
    columns: list[str]
    train_rows: int
    statistics: list[str] = field(default_factory=list)


def classification_set(
    features: DataFrame,
    columns: list[str] = MODEL_FEATURES,
    oversample: bool = True,
    exact_shares: bool = True,
) -> TrainingSet:
    """70/30 split with exact label shares, scaling fitted on the training part, oversampling of its minority.

    Without ``exact_shares`` the split is decided row by row from the id, which
    saves a shuffle of the feature table and keeps the shares up to sampling error.
    Where the features carry the encoded categories, the label's ordered statistics of
    the training part are added, and its whole statistics to the test part.

    The learners read their input many times, so both parts are written to the
    shared folder first: a lost executor costs a re-read, not the feature joins.
    The tables between are deleted as soon as the next one is written.
    """
    spark = features.sparkSession
    statistics = TARGET_STATISTICS if set(ENCODED) <= set(features.columns) else []
    inputs = [*columns, *statistics]
    with scratch(spark):
        train, test = _scaled_parts(features, inputs, bool(statistics), exact_shares)
        if oversample:
            # Written before the weights are taken: they need the counts of the whole.
            with scratch(spark):
                train = materialize(smote_oversample(train, inputs), "oversampled", outlives=1)
        train = materialize(weighted(train), "train", outlives=1)
    return TrainingSet(train, test, columns, train.count(), statistics)


def _scaled_parts(features: DataFrame, inputs: list[str], statistics: bool, exact_shares: bool) -> tuple[DataFrame, DataFrame]:
    """The training and the test part, written."""
    spark = features.sparkSession
    with scratch(spark):
        with scratch(spark):
            if exact_shares:
                split = stratified_split(materialize(features, "features"), "event_id", "target")
            else:
                split = random_split(features, "event_id")
            split = materialize(split, "split", outlives=1)
        train, test = split.where("split = 'train'").drop("split"), split.where("split = 'test'").drop("split")
        if statistics:
            learned = train
            train = materialize(ordered_target_statistics(learned, ENCODED, "target", "event_id").drop(*ENCODED), "train-part")
            test = target_statistics(test, learned, ENCODED, "target", "event_id").drop(*ENCODED)
        test = materialize(standard_scale(test, inputs, fitted_on=train), "test", outlives=2)
        train = materialize(standard_scale(train, inputs), "scaled", outlives=1)
    return train, test


def assemble(columns: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=columns, outputCol="features")


# --- estimators ------------------------------------------------------------------

def logistic(effort: Effort, rows: int, regularisation_c: float = 1.0) -> LogisticRegression:
    """Inverse strength C corresponds to a penalty of 1 / (C * rows) per row."""
    return LogisticRegression(
        labelCol="target", weightCol="weight", maxIter=effort.linear_rounds,
        regParam=1.0 / (regularisation_c * max(rows, 1)), standardization=False, tol=1e-4,
    )


def forest(effort: Effort, rows: int = 0) -> RandomForestClassifier:
    """Deep trees: room for many nodes a pass, and each row's node kept from pass to pass."""
    return RandomForestClassifier(
        labelCol="target", weightCol="weight", numTrees=effort.trees,
        maxDepth=effort.tree_depth, minInstancesPerNode=2, seed=42,
        maxMemoryInMB=512, cacheNodeIds=True, checkpointInterval=10,
    )


def boosted(effort: Effort, preset: str) -> GBTClassifier:
    options = {k: v for k, v in BOOSTING[preset].items() if k not in ("weighted", "categories")}
    model = GBTClassifier(
        labelCol="target", maxIter=effort.boosting_rounds, seed=42, checkpointInterval=10, **options
    )
    return model.setWeightCol("weight") if BOOSTING[preset].get("weighted") else model


def linear_svm(effort: Effort, rows: int, regularisation_c: float = 1.0) -> LinearSVC:
    return LinearSVC(
        labelCol="target", weightCol="weight", maxIter=effort.linear_rounds,
        regParam=1.0 / (regularisation_c * max(rows, 1)), standardization=False, tol=1e-3,
    )


def kernel_svm(effort: Effort, rows: int, regularisation_c: float = 1.0) -> KernelSVC:
    """RBF kernel by random Fourier features in front of a linear machine; the features are made anew in each pass."""
    return KernelSVC(
        labelCol="target", weightCol="weight", size=effort.kernel_features, maxIter=effort.linear_rounds,
        regParam=1.0 / (regularisation_c * max(rows, 1)), tol=1e-3,
    )


def classifiers(effort: Effort, rows: int) -> dict[str, Callable]:
    table = {
        "logistic_regression": lambda: logistic(effort, rows),
        "random_forest": lambda: forest(effort, rows),
        "rbf_svm": lambda: kernel_svm(effort, rows),
    }
    for preset in BOOSTING:
        table[preset] = lambda preset=preset: boosted(effort, preset)
    return table


def inputs_of(data: TrainingSet, name: str) -> list[str]:
    return [*data.columns, *(data.statistics if BOOSTING.get(name, {}).get("categories") else [])]


def partitions(rows: int, few: bool, cores: int) -> int:
    """Partitions in proportion to the rows.

    With ``few`` one for each core as long as it holds at most ``FEW_PARTITION_ROWS``.  For trees: at every level, each
    partition shuffles the statistics of all nodes, so the shuffle grows with partitions times nodes, both of which follow
    the rows.  For the kernel machine: at every pass, each partition sends its gradient to the driver.
    """
    parts = max(1, -(-rows // TRAIN_PARTITION_ROWS))
    return min(parts, max(cores, -(-rows // FEW_PARTITION_ROWS))) if few else parts


@contextmanager
def kept(df: DataFrame, parts: int) -> Iterator[DataFrame]:
    """The table in so many partitions, kept while it is learned from."""
    held = df.repartition(parts).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()


def fit(data: TrainingSet, estimator, name: str = "") -> PipelineModel:
    shared_dir(data.train.sparkSession)
    front = assemble(inputs_of(data, name))
    few = isinstance(estimator, (RandomForestClassifier, GBTClassifier, KernelSVC))
    parts = partitions(data.train_rows, few, data.train.sparkSession.sparkContext.defaultParallelism)
    with kept(front.transform(data.train).select("features", "target", "weight"), parts) as held:
        fitted = estimator.fit(held)
    stages = fitted.stages if isinstance(fitted, PipelineModel) else [fitted]
    return PipelineModel(stages=[front, *stages])


def fit_all(data: TrainingSet, effort: Effort, names: list[str]) -> dict[str, PipelineModel]:
    """One fit for each name, a few at a time; the longest begin first."""
    table = classifiers(effort, data.train_rows)
    spark = data.train.sparkSession
    ordered = sorted(names, key=lambda n: (n != "random_forest", n not in BOOSTING))
    with ThreadPoolExecutor(FITS) as pool:
        run = inheritable_thread_target(spark)(lambda n: fit(data, table[n](), n))
        return dict(zip(ordered, pool.map(run, ordered)))


def positive_score(model: PipelineModel) -> Column:
    """Probability of the positive class, or a squashed margin without one."""
    if model.stages[-1].hasParam("probabilityCol"):
        return vector_to_array(F.col("probability"))[1]
    margin = vector_to_array(F.col("rawPrediction"))[1]
    return 1 / (1 + F.exp(-margin))


def score(model: PipelineModel, rows: DataFrame, keep: list[str]) -> DataFrame:
    return model.transform(rows).select(*keep, positive_score(model).alias("score"))


def evaluate(model: PipelineModel, data: TrainingSet, name: str) -> DataFrame:
    scored = score(model, data.test, ["event_id", F.col("target").alias("y")])
    named = scored.withColumn("model", F.lit(name)).withColumn("latency", F.lit(None).cast("double"))
    return metrics.classification_metrics(named).join(metrics.roc_auc(named), "model")


def train_compare(
    data: TrainingSet, effort: Effort, names: list[str] | None = None, models: dict[str, PipelineModel] | None = None
) -> DataFrame:
    """Leaderboard over the named classifiers: fits side by side, unless a model is among ``models``."""
    models = dict(models or {})
    names = names or list(classifiers(effort, data.train_rows))
    models |= fit_all(data, effort, [n for n in names if n not in models])
    board = None
    for name in names:
        scored = score(models[name], data.test, ["event_id", F.col("target").alias("y")]).withColumn("model", F.lit(name))
        board = scored if board is None else board.unionByName(scored)
    return ranking.leaderboard(comparison_figures(materialize(board, "scored")))


def comparison_figures(scored: DataFrame) -> DataFrame:
    """Metrics, confusion counts, specificity and ROC-AUC per model (model, y, score)."""
    counts = metrics.score_counts(scored)
    figures = metrics.classification_of(counts).join(metrics.confusion_of(counts), "model")
    return figures.join(metrics.auc_of(counts), "model")


def feature_importance(model: PipelineModel, columns: list[str], top: int = 20) -> DataFrame:
    """Importances of a tree model, largest first (one row per feature)."""
    values = model.stages[-1].featureImportances.toArray().tolist()
    rows = [(c, float(v)) for c, v in zip(columns, values)]
    table = _spark(model).createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), F.asc("feature")).limit(top)


def _spark(model):
    from pyspark.sql import SparkSession

    return SparkSession.getActiveSession()


# --- demand ------------------------------------------------------------------------

@dataclass(frozen=True)
class DemandSet:
    train: DataFrame
    test: DataFrame


def demand_set(demand: DataFrame, train_share: float = 0.8) -> DemandSet:
    """Rows without nulls, split by product and date."""
    key = F.col("product_id") * 100_000 + F.datediff("target_date", F.lit("1970-01-01").cast("date"))
    rows = cleaning.drop_null_rows(demand).select(
        "target_date",
        "product_id",
        *[F.col(c).cast("double").alias(c) for c in DEMAND_FEATURES],
        F.col("demand").cast("double").alias("demand"),
        key.alias("_row"),
    )
    split = materialize(random_split(rows, "_row", train_share).drop("_row"), "demand")
    return DemandSet(
        split.where("split = 'train'").drop("split"), split.where("split = 'test'").drop("split")
    )


def demand_regressors(effort: Effort) -> dict[str, object]:
    return {
        "linear_regression": LinearRegression(labelCol="demand", maxIter=effort.linear_rounds),
        "random_forest": RandomForestRegressor(
            labelCol="demand", numTrees=effort.demand_trees, maxDepth=effort.demand_depth, seed=42
        ),
        "boosted_trees": GBTRegressor(
            labelCol="demand", maxIter=effort.boosting_rounds, maxDepth=6, stepSize=0.1, seed=42,
            checkpointInterval=10,
        ),
    }


def compare_demand(data: DemandSet, effort: Effort) -> DataFrame:
    """Regression figures per model on the test rows."""
    shared_dir(data.train.sparkSession)
    board = None
    for name, estimator in demand_regressors(effort).items():
        model = Pipeline(stages=[assemble(DEMAND_FEATURES), estimator]).fit(data.train)
        scored = model.transform(data.test).select(F.col("demand").alias("y"), F.col("prediction").alias("p"))
        row = metrics.regression_metrics(scored).select(F.lit(name).alias("model"), "*")
        board = row if board is None else board.unionByName(row)
    return board


def two_stage_demand(data: DemandSet, effort: Effort) -> DataFrame:
    """Classifier for demand > 0, regressor on log1p(demand) of the positive rows."""
    shared_dir(data.train.sparkSession)
    labelled = data.train.withColumn("has_demand", X.flag(F.col("demand") > 0).cast("double"))
    gate = Pipeline(
        stages=[
            assemble(DEMAND_FEATURES),
            RandomForestClassifier(
                labelCol="has_demand", numTrees=effort.demand_trees, maxDepth=effort.demand_depth, seed=42,
                predictionCol="has_demand_hat", probabilityCol="has_demand_p", rawPredictionCol="has_demand_raw",
            ),
        ]
    ).fit(labelled)
    positives = cleaning.positive(labelled).withColumn("log_demand", F.log1p("demand"))
    amount = Pipeline(
        stages=[
            assemble(DEMAND_FEATURES),
            RandomForestRegressor(
                labelCol="log_demand", numTrees=effort.demand_trees, maxDepth=effort.demand_depth, seed=42,
                predictionCol="log_demand_hat",
            ),
        ]
    ).fit(positives)
    scored = amount.transform(gate.transform(data.test).drop("features"))
    return scored.select(
        "target_date",
        "product_id",
        F.col("demand").alias("y"),
        F.when(F.col("has_demand_hat") == 1, F.expm1("log_demand_hat")).otherwise(0.0).alias("p"),
    )


# --- scoring ---------------------------------------------------------------------------

def batch_score(
    requests: DataFrame, users: DataFrame, model: PipelineModel, version: str = "1"
) -> DataFrame:
    """One result row per request: score and decision, or the reason it was rejected."""
    enriched = joins.enrich_requests(requests, users)
    names = [c for c in enriched.columns if c not in ("request_id", "user_id", "is_default")]
    scored = model.transform(enriched.na.fill(0.0, subset=names)).select(
        "request_id",
        "user_id",
        positive_score(model).alias("probability"),
        F.lit(version).alias("model_version"),
        F.lit(None).cast("string").alias("error"),
    )
    rejected = cleaning.rejected_requests(requests).select(
        "request_id",
        F.lit(None).cast("long").alias("user_id"),
        F.lit(None).cast("double").alias("probability"),
        F.lit(version).alias("model_version"),
        F.col("reason").alias("error"),
    )
    return scored.unionByName(rejected).withColumn(
        "prediction", F.when(F.col("probability").isNotNull(), X.above_half("probability"))
    )


def scoring_model(events: DataFrame, users: DataFrame, effort: Effort) -> PipelineModel:
    """Scorer for requests, trained on the event log: is an event at this price by this user a purchase?

    The price of an event stands for the amount of a request; the label is the
    event's type, which is no input.
    """
    past = events.where(F.col("price").isNotNull()).select(
        F.col("event_id").alias("request_id"),
        "user_id",
        F.col("price").alias("transaction_amount"),
        X.flag(F.col("event_type") == "purchase").alias("target"),
    )
    enriched = joins.enrich_requests(past.drop("target"), users)
    names = [c for c in enriched.columns if c not in ("request_id", "user_id", "is_default")]
    rows = enriched.na.fill(0.0, subset=names).join(past.select("request_id", "target"), "request_id")
    estimator = LogisticRegression(labelCol="target", maxIter=effort.linear_rounds, regParam=0.01)
    return Pipeline(stages=[assemble(names), estimator]).fit(materialize(rows, "past-requests"))
