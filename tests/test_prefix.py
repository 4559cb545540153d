import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.operators import prefix


def long_table(spark, **columns):
    rows = [(name, None if v is None else float(v)) for name, values in columns.items() for v in values]
    return spark.createDataFrame(rows, "column string, value double")


def test_quantiles_equal_numpy_with_a_value_holding_a_third_of_the_rows(spark):
    rng = np.random.default_rng(1)
    data = {
        "smooth": rng.exponential(100, 5000),
        "hot": np.concatenate([np.full(2000, 7.0), rng.normal(0, 50, 4001)]),
        "single": np.array([3.5]),
        "constant": np.full(100, 2.0),
    }
    probs = {"a": 0.0, "b": 0.05, "c": 0.5, "d": 0.95, "e": 1.0}
    got = {r["column"]: r for r in prefix.quantiles(long_table(spark, **data), probs).collect()}
    for name, values in data.items():
        for key, q in probs.items():
            assert got[name][key] == pytest.approx(np.quantile(values, q), rel=1e-12, abs=1e-12)


def test_quantiles_skip_nulls_and_all_null_columns(spark):
    got = prefix.quantiles(long_table(spark, x=[None, 1, 3, None], y=[None, None]), {"m": 0.5}).collect()
    assert [(r["column"], r["m"]) for r in got] == [("x", 2.0)]


def test_running_totals_equal_cumulative_sums(spark):
    rng = np.random.default_rng(2)
    values = rng.integers(0, 3000, 20000)
    long = long_table(spark, x=values)
    got = prefix.running_totals(prefix.value_counts(long), ["n"]).orderBy("value").collect()
    distinct, counts = np.unique(values, return_counts=True)
    assert [r["value"] for r in got] == list(distinct)
    assert [r["n_before"] for r in got] == list(np.cumsum(counts) - counts)
    assert {r["n_total"] for r in got} == {20000}
    assert [r["next_value"] for r in got] == [*distinct[1:], None]


def test_sequence_numbers_with_one_time_stamp_on_most_rows(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(i, base + dt.timedelta(seconds=0 if i % 3 else (i * 37) % 5000)) for i in range(6000)]
    df = spark.createDataFrame(rows, "id long, at timestamp")
    got = {r["id"]: r["seq"] for r in prefix.sequence_numbers(df, "at", "id").collect()}
    expected = {i: n for n, (i, _) in enumerate(sorted(rows, key=lambda r: (r[1], r[0])))}
    assert got == expected


def test_hot_time_stamp_is_spread_over_parts(spark):
    """The rows of the shared time stamp do not sit in one (bucket, part)."""
    df = spark.range(20000).select(F.col("id"), F.lit("2024-01-01").cast("timestamp").alias("at"))
    plan = prefix.sequence_numbers(df, "at", "id")
    assert plan.agg(F.max("seq"), F.count_distinct("seq")).first()[:] == (19999, 20000)


def test_no_large_single_partition_sort(spark, tables):
    """A single-partition exchange may only carry aggregated rows, never a scan."""
    from basketry.operators import drift, metrics

    for df in (
        metrics.roc_auc(tables.scored),
        drift.distances(tables.reference, tables.current, tables.DRIFT_COLUMNS),
        prefix.column_quantiles(tables.event_log, ["price"], {"m": 0.5}),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan
        assert "Python" not in plan
