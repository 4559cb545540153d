"""Headline queries at one scale factor; prints one JSON line.

BENCH_SF_DIR  directory with the parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS    executor threads (default 8)

Every query is built and run twice and written to the no-op sink; the shorter
time counts, so JVM warm-up is not measured.  Model training is run once, at full
size: oversampled training part, 1000 linear rounds, 200 trees of depth 15, 200
boosting rounds.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from basketry.functions.fixed_values import MODEL_FEATURES  # noqa: E402
from basketry.operators import features, learning  # noqa: E402
from basketry.plans.catalog import CATALOG  # noqa: E402
from basketry.session import local_session  # noqa: E402
from basketry.sources.tables import Tables  # noqa: E402

HEADLINE = [
    "dedup_rows", "null_profile", "fill_median", "dataset_summary", "event_distribution",
    "user_stats", "product_stats", "user_product_stats", "frequency_encoding", "attach_user_stats",
    "daily_product_stats", "moving_avg_7", "demand_dataset", "pit_join", "online_table",
    "enrich_requests", "consistency_check", "psi", "ks_test", "drift_summary", "drift_line_items",
    "quality_tests", "roc_auc", "leaderboard", "latency_summary", "block_throughput",
    "shadow_summary", "canary_decision", "retrain_decision", "alert_message", "standard_scale",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus))

    times = {}
    for name in HEADLINE:
        query = CATALOG[name]
        times[name] = min(timed(lambda: run(query.run(spark, sf_dir))) for _ in range(2))

    tables = Tables(spark, sf_dir)
    data = {}
    times["prepare_training_set"] = timed(
        lambda: data.update(
            set=learning.classification_set(features.model_features(tables.shop_events), MODEL_FEATURES)
        )
    )
    effort = learning.Effort()
    training = data["set"]
    for name, estimator in {
        "train_logistic_regression": learning.logistic(effort, training.train_rows),
        "train_random_forest": learning.forest(effort),
        "train_boosted_depth6": learning.boosted(effort, "boosted_depth6"),
        "train_linear_svm": learning.linear_svm(effort, training.train_rows),
    }.items():
        times[name] = timed(lambda: learning.fit(training, estimator))

    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
