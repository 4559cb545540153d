"""Queries: features for training (with SQL); Spark ML training, evaluation, scoring, oversampling (rows and tests)."""

from pyspark.sql import functions as F

from ..functions.fixed_values import DEMAND_FEATURES, MODEL_FEATURES
from ..operators import features, history, learning, metrics, sampling
from ..session import materialize
from .registry import query
from .views_sql import id_bucket_sql

FULL = learning.Effort()

# Training sets and fitted models of this session, so that queries over the same
# tables train each model once.  Keyed by application and folder.
_trained: dict[tuple, object] = {}


def _once(t, name: str, make):
    key = (t.spark.sparkContext.applicationId, t.sf_dir, name)
    if key not in _trained:
        _trained[key] = make()
    return _trained[key]


def _training(t) -> learning.TrainingSet:
    return _once(t, "set", lambda: learning.classification_set(features.model_features(t.shop_events)))


def _model(t, name: str):
    data = _training(t)
    table = learning.classifiers(FULL, data.train_rows) | {"linear_svm": lambda: learning.linear_svm(FULL, data.train_rows)}
    return _once(t, name, lambda: learning.fit(data, table[name](), name))


def _scored(t, name: str):
    return learning.score(_model(t, name), _training(t).test, ["event_id", F.col("target").alias("y")])


@query(
    "training_features_asof",
    """
    SELECT event_id, event_type, round(coalesce(avg(price) OVER w, 0.0), 6) AS user_price_mean,
           round(coalesce(stddev_samp(price) OVER w, 0.0), 6) AS user_price_std, count(price) OVER w AS user_event_count,
           count(*) FILTER (event_type = 'purchase') OVER w AS user_purchase_count,
           round(coalesce(count(*) FILTER (event_type = 'purchase') OVER w / nullif(count(price) OVER w, 0)::DOUBLE, 0.0), 6)
             AS user_purchase_rate
    FROM event_log
    WINDOW w AS (PARTITION BY user_id ORDER BY event_time, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    """,
)
def training_features_asof(t):
    return history.user_stats_asof(t.event_log).select(
        "event_id", "event_type", "user_price_mean", "user_price_std", "user_event_count", "user_purchase_count",
        "user_purchase_rate",
    )


def _target_statistics_sql(columns: list[str]) -> str:
    """Label means over the earlier rows of a value in the seeded permutation, with one row of the overall mean."""
    place = id_bucket_sql("event_id", history.PERMUTATION)
    means = ", ".join(
        f"round((coalesce(sum(y) OVER {c}_w, 0) + p) / (count(*) OVER {c}_w + 1.0::DOUBLE), 6) AS {c}_ts" for c in columns
    )
    windows = ", ".join(
        f"{c}_w AS (PARTITION BY {c} ORDER BY place, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)" for c in columns
    )
    return f"""
    SELECT event_id, {means}
    FROM (SELECT *, {place} AS place, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS y,
                 (SELECT avg(CASE WHEN event_type = 'purchase' THEN 1.0::DOUBLE ELSE 0.0 END) FROM shop_events) AS p FROM shop_events)
    WINDOW {windows}
    """


@query("ordered_target_statistics", _target_statistics_sql(features.ENCODED))
def ordered_target_statistics(t):
    events = t.shop_events.withColumn("target", F.when(F.col("event_type") == "purchase", 1).otherwise(0))
    found = history.ordered_target_statistics(events, features.ENCODED, "target", "event_id")
    return found.select("event_id", *[f"{c}_ts" for c in features.ENCODED])


@query("smote_oversample")
def smote_oversample(t):
    rows = materialize(features.model_features(t.shop_events), "features")
    return sampling.smote_oversample(
        features.standard_scale(rows, MODEL_FEATURES), MODEL_FEATURES
    )


@query("logreg")
def logreg(t):
    return _scored(t, "logistic_regression")


@query("random_forest_cls")
def random_forest_cls(t):
    return _scored(t, "random_forest")


@query("gbt_cls")
def gbt_cls(t):
    return _scored(t, "boosted_depth6")


@query("linear_svm")
def linear_svm(t):
    return _scored(t, "linear_svm")


@query("rbf_svm")
def rbf_svm(t):
    return _scored(t, "rbf_svm")


@query("feature_importance")
def feature_importance(t):
    return learning.feature_importance(_model(t, "random_forest"), MODEL_FEATURES)


@query("train_compare")
def train_compare(t):
    data = _training(t)
    key = (t.spark.sparkContext.applicationId, t.sf_dir)
    known = {n: _trained[(*key, n)] for n in learning.classifiers(FULL, 1) if (*key, n) in _trained}
    models = known | learning.fit_all(data, FULL, [n for n in learning.classifiers(FULL, 1) if n not in known])
    _trained.update({(*key, n): m for n, m in models.items()})
    return learning.train_compare(data, FULL, models=models)


@query("demand_regressors")
def demand_regressors(t):
    return learning.compare_demand(learning.demand_set(t.demand_set), FULL)


@query("two_stage_demand")
def two_stage_demand(t):
    return learning.two_stage_demand(learning.demand_set(t.demand_set), FULL)


@query("two_stage_demand_metrics")
def two_stage_demand_metrics(t):
    return metrics.zero_inflated_mape(two_stage_demand(t))


@query("batch_score")
def batch_score(t):
    users = materialize(t.online_users, "online-users")
    model = _once(t, "scorer", lambda: learning.scoring_model(t.event_log, users, FULL))
    return learning.batch_score(t.requests, users, model)
