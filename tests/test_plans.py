"""Plan shapes that decide whether a query survives a thousand times the data."""

import pytest

from basketry.operators import features, joins, ranking, sampling
from basketry.plans.catalog import CATALOG

from .conftest import SMALL

LAZY = [
    name
    for name, q in CATALOG.items()
    if q.oracle and not name.startswith(("stream_", "sink_", "scan_", "reference_"))
]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    """Plan as if no table were small enough for an automatic broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_no_python_no_gathered_rows(spark, no_broadcast, name):
    plan = plan_of(CATALOG[name].run(spark, SMALL))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "EvalPython" not in plan and "InPandas" not in plan
    lines = plan.splitlines()
    for line, below in zip(lines, lines[1:]):
        if "Exchange SinglePartition" in line and name not in ("leaderboard",):
            # Only partial aggregates (one row per task) may meet in one task.
            assert "Aggregate" in below, f"{name}: {below.strip()}"


def test_latest_rows_are_cut_before_the_shuffle(tables):
    plan = plan_of(ranking.last_n_per_group(tables.scored, "model", 100, "event_time", "event_id"))
    assert plan.count("WindowGroupLimit") == 2


def test_conditional_aggregates_are_combined_before_the_shuffle(tables):
    plan = plan_of(features.product_stats(tables.event_log))
    assert plan.count("Exchange hashpartitioning(product_id") == 1
    assert "partial_count" in plan or "partial_sum" in plan


def test_unused_columns_are_not_read(tables):
    plan = plan_of(features.user_event_pivot(tables.event_log))
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in plan


def test_random_split_does_not_shuffle(tables):
    assert "Exchange" not in plan_of(sampling.random_split(tables.event_log, "event_id"))


def test_split_lookup_spreads_served_rows(tables, no_broadcast):
    lookup = features.value_frequencies(tables.event_log, "product_id")
    plan = plan_of(joins.attach(tables.event_log, lookup, "product_id", "n"))
    assert "_salt" in plan and "BroadcastHashJoin" in plan and "SortMergeJoin" in plan


def test_asof_shuffles_by_key_and_time_bucket(tables):
    plan = plan_of(
        joins.asof_join(tables.purchases, tables.daily_user_features, ["user_id"], ["user_views"], 604800)
    )
    assert "hashpartitioning(user_id" in plan and "_bucket" in plan and "Join" not in plan
