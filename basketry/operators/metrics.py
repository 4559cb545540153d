"""Model metrics and comparisons over tables of label, score and model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..functions import fixed_values as V
from ..session import materialize
from .prefix import quantiles, running_totals

FLOAT_EPSILON = 2.220446049250313e-16


def melt_scores(wide: DataFrame, models: list[str], keep: list[str]) -> DataFrame:
    """One row per (row, model) from one score and one latency column per model."""
    cells = F.array(
        *[
            F.struct(
                F.lit(m).alias("model"), F.col(m).alias("score"), F.col(f"latency_{m}").alias("latency")
            )
            for m in models
        ]
    )
    return wide.select(*keep, F.inline(cells))


# --- classification ---------------------------------------------------------------

def score_counts(scored: DataFrame) -> DataFrame:
    """Labels and latency by (model, score): one pass, written once; all figures of a model follow from it."""
    latency = F.col("latency") if "latency" in scored.columns else F.lit(None).cast("double")
    counts = scored.groupBy("model", "score").agg(
        F.count_if(F.col("y") == 1).alias("pos"),
        F.count_if(F.col("y") == 0).alias("neg"),
        F.sum(latency).alias("latency"),
        F.count(latency).alias("timed"),
    )
    return materialize(counts, "score-counts")


def _confusion(counts: DataFrame, threshold: float) -> DataFrame:
    p = X.above_half("score", threshold)
    of = lambda label, side: F.coalesce(F.sum(F.when(p == side, F.col(label))), F.lit(0))
    return counts.groupBy("model").agg(
        of("neg", 0).alias("tn"), of("neg", 1).alias("fp"), of("pos", 0).alias("fn"), of("pos", 1).alias("tp")
    )


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def confusion_counts(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    return confusion_of(score_counts(scored), threshold)


def confusion_of(counts: DataFrame, threshold: float = 0.5) -> DataFrame:
    return _confusion(counts, threshold).withColumn(
        "specificity", _ratio(F.col("tn"), F.col("tn") + F.col("fp"))
    )


def classification_metrics(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Accuracy, and precision, recall and F1 weighted by class support."""
    return classification_of(score_counts(scored), threshold)


def classification_of(counts: DataFrame, threshold: float = 0.5) -> DataFrame:
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    negatives, positives = tn + fp, tp + fn

    def weighted(of_negative: Column, of_positive: Column) -> Column:
        return _ratio(of_negative * negatives + of_positive * positives, n)

    return _confusion(counts, threshold).select(
        "model",
        _ratio(tn + tp, n).alias("accuracy"),
        weighted(_ratio(tn, tn + fn), _ratio(tp, tp + fp)).alias("precision"),
        weighted(_ratio(tn, negatives), _ratio(tp, positives)).alias("recall"),
        weighted(_ratio(2 * tn, 2 * tn + fn + fp), _ratio(2 * tp, 2 * tp + fp + fn)).alias("f1_score"),
    )


def roc_auc(scored: DataFrame) -> DataFrame:
    """Rank AUC, ties counted half; 0.5 if a class or all scores are missing."""
    return auc_of(score_counts(scored))


def auc_of(counts: DataFrame) -> DataFrame:
    """The negatives below each score come from bucketed running totals, so no task sorts a whole model."""
    known = counts.where(F.col("score").isNotNull()).select("model", "score", "pos", "neg")
    running = running_totals(known, ["pos", "neg"], "model", "score")
    won = F.col("pos") * (F.col("neg_before") + F.col("neg") / 2)
    auc = running.groupBy("model").agg(
        F.sum(won).alias("won"),
        (F.max("pos_total").cast("double") * F.max("neg_total")).alias("pairs"),
    )
    return (
        counts.select("model")
        .distinct()
        .join(auc, "model", "left")
        .select("model", F.coalesce(F.try_divide("won", "pairs"), F.lit(0.5)).alias("roc_auc"))
    )


def model_metrics(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Leaderboard input: all classification figures and the mean latency per model, from one pass."""
    counts = score_counts(scored)
    latency = counts.groupBy("model").agg(F.try_divide(F.sum("latency"), F.sum("timed")).alias("latency_ms"))
    return classification_of(counts, threshold).join(auc_of(counts), "model").join(latency, "model")


# --- regression --------------------------------------------------------------------

def regression_metrics(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """MAE, RMSE, R2 (0 for a constant target) and MAPE in one pass."""
    label, predicted = F.col(y), F.col(p)
    residual = label - predicted
    return df.agg(
        F.avg(F.abs(residual)).alias("mae"),
        F.sqrt(F.avg(residual * residual)).alias("rmse"),
        F.avg(residual * residual).alias("_mse"),
        F.var_pop(label).alias("_variance"),
        F.avg(F.abs(residual) / F.greatest(F.abs(label), F.lit(FLOAT_EPSILON))).alias("mape"),
    ).select(
        "mae",
        "rmse",
        F.when(F.col("_variance") == 0, 0.0)
        .otherwise(1 - F.try_divide(F.col("_mse"), F.col("_variance")))
        .alias("r2"),
        "mape",
    )


def safe_mape(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """MAPE in percent over usable rows, at most 1000, and 1000 without any."""
    label, predicted = F.col(y), F.col(p)
    usable = (label > 0) & (predicted >= 0) & (label < 1e10) & (predicted < 1e10)
    error = F.when(usable, F.abs(label - predicted) / F.nullif(label, F.lit(0.0)) * 100)
    return df.agg(
        F.least(F.coalesce(F.avg(error), F.lit(1000.0)), F.lit(1000.0)).alias("mape_pct"),
        F.count_if(usable).alias("rows_used"),
    )


def zero_inflated_mape(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """0.7 x MAPE of the positive rows + 0.3 x share of wrong zero / non-zero calls."""
    label, predicted = F.col(y), F.col(p)
    error = F.when(label > 0, F.abs(label - predicted) / F.nullif(label, F.lit(0.0)))
    agree = F.when((label > 0) == (predicted > 0), 1.0).otherwise(0.0)
    return df.agg(
        F.coalesce(F.avg(error), F.lit(0.0)).alias("mape_positive"),
        F.avg(agree).alias("zero_accuracy"),
    ).withColumn("score", 0.7 * F.col("mape_positive") + 0.3 * (1 - F.col("zero_accuracy")))


# --- rules over metrics ---------------------------------------------------------------

def requirements_check(board: DataFrame, best_mape: Column) -> DataFrame:
    return board.agg(
        F.bool_and(F.col("latency_ms") < 100).alias("all_latency_below_100"),
        F.bool_or(F.col("accuracy") > 0.85).alias("any_accuracy_above_085"),
        (F.max("roc_auc") > 0.7).alias("best_auc_above_07"),
        (F.max(best_mape) < 15).alias("mape_below_15"),
    )


def ctr_uplift(board: DataFrame) -> DataFrame:
    return board.select(
        "model", "roc_auc", ((F.col("roc_auc") - 0.5) * 20).alias("estimated_uplift_pct")
    )


def performance_drop(baseline: DataFrame, current: DataFrame) -> DataFrame:
    """(model, metric, baseline, current, drop, limit, alert) for five metrics."""
    names = list(V.METRIC_DROP_LIMITS)

    def long(df: DataFrame, value: str) -> DataFrame:
        return df.select("model", *names).unpivot("model", names, "metric", value)

    limits = F.create_map(*[F.lit(x) for pair in V.METRIC_DROP_LIMITS.items() for x in pair])
    return (
        long(baseline, "baseline")
        .join(long(current, "current"), ["model", "metric"])
        .withColumn("drop", F.col("baseline") - F.col("current"))
        .withColumn("limit", F.element_at(limits, F.col("metric")))
        .withColumn("alert", X.flag(F.col("drop") > F.col("limit")))
    )


def validation_gates(
    scored: DataFrame, min_auc: float = 0.85, max_latency: float = 50.0
) -> DataFrame:
    """Gates per model over (model, request_id, repeat, y, score, latency) rows."""
    first = scored.where(F.col("repeat") == 1)
    repeats = (
        scored.groupBy("model", "request_id")
        .agg(
            (F.min("score") == F.max("score")).alias("same"),
            F.max(X.flag(F.isnan("score") | (F.abs("score") == float("inf")))).alias("broken"),
        )
        .groupBy("model")
        .agg(
            F.coalesce(F.bool_and("same"), F.lit(True)).alias("stable"),
            (F.max("broken") == 0).alias("finite"),
        )
    )
    latency = first.groupBy("model").agg(F.avg("latency").alias("mean_latency"))
    p95 = quantiles(
        first.select("model", F.col("latency").alias("value")), {"p95_latency": 0.95}, "model"
    )
    auc_ok = F.col("roc_auc") >= min_auc
    latency_ok = F.col("mean_latency") <= max_latency
    reasons = F.array_compact(
        F.array(
            F.when(~auc_ok, "auc below limit"),
            F.when(~latency_ok, "latency above limit"),
            F.when(~F.col("stable"), "predictions not repeatable"),
            F.when(~F.col("finite"), "score not finite"),
        )
    )
    return (
        roc_auc(first)
        .join(latency, "model")
        .join(p95, "model")
        .join(repeats, "model")
        .withColumn("reasons", F.concat_ws("; ", reasons))
        .withColumn("passed", X.flag(F.col("reasons") == ""))
    )


def compare_two_models(board: DataFrame, first: str, second: str) -> DataFrame:
    """Differences second - first, and the winner: better on both, else better AUC."""

    def of(model: str, column: str) -> Column:
        return F.max(F.when(F.col("model") == model, F.col(column)))

    auc_diff, latency_diff = F.col("auc_difference"), F.col("latency_difference")
    return board.agg(
        (of(second, "roc_auc") - of(first, "roc_auc")).alias("auc_difference"),
        (of(second, "latency_ms") - of(first, "latency_ms")).alias("latency_difference"),
    ).select(
        F.lit(first).alias("model_1"),
        F.lit(second).alias("model_2"),
        "auc_difference",
        "latency_difference",
        F.when((auc_diff < 0) & (latency_diff > 0), first)
        .when((auc_diff > 0) & (latency_diff < 0), second)
        .when(auc_diff < 0, first)
        .otherwise(second)
        .alias("winner"),
    )
