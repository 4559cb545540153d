import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.operators import alerts, categories, drift, profile


def table(spark, **columns):
    names = list(columns)
    return spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{n} string" for n in names))


def p_of(spark, pairs):
    df = spark.createDataFrame([(i, float(x), float(k)) for i, (x, k) in enumerate(pairs)], "i int, x double, k double")
    rows = df.select("i", categories.chi_square_p(F.col("x"), F.col("k")).alias("p")).collect()
    return [r["p"] for r in sorted(rows, key=lambda r: r["i"])]


def even_tail(x, k):
    """The tail for even degrees: a Poisson sum."""
    m = x / 2
    return math.fsum(math.exp(j * math.log(m) - m - math.lgamma(j + 1)) for j in range(k // 2))


def test_log_gamma_equals_the_library(spark):
    z = [0.5, 1.0, 1.5, 2.0, 7.25, 100.0, 1e6]
    df = spark.createDataFrame([(v,) for v in z], "z double").select("z", categories.log_gamma(F.col("z")).alias("g"))
    for row in df.collect():
        assert row["g"] == pytest.approx(math.lgamma(row["z"]), rel=1e-12, abs=1e-10)


def test_p_values_over_many_degrees(spark):
    cases = [(x, k) for k in (2, 4, 10, 100, 1000, 20_000, 1_000_000) for x in (0.5 * k, 0.97 * k, k, 1.02 * k, k + 6 * math.sqrt(2 * k))]
    for (x, k), p in zip(cases, p_of(spark, cases)):
        assert p == pytest.approx(even_tail(x, k), abs=2e-8), (x, k)
    one = [(x, 1) for x in (0.01, 1.0, 3.841459, 12.0)]
    for (x, _), p in zip(one, p_of(spark, one)):
        assert p == pytest.approx(math.erfc(math.sqrt(x / 2)), abs=1e-9)
    assert p_of(spark, [(0.0, 3), (5.0, 0), (1e12, 5), (1e9, 1000)]) == [1.0, 1.0, 0.0, 0.0]


def test_figures_equal_numpy(spark):
    rng = np.random.default_rng(3)
    r = rng.choice(list("abcd"), 3000, p=[0.5, 0.3, 0.15, 0.05])
    c = rng.choice(list("abce"), 2000, p=[0.4, 0.3, 0.2, 0.1])
    row = categories.categorical_drift(table(spark, x=r.tolist()), table(spark, x=c.tolist()), ["x"]).first()
    names = sorted(set(r) | set(c))
    a, b = np.array([(r == n).sum() for n in names], float), np.array([(c == n).sum() for n in names], float)
    p, q = a / a.sum(), b / b.sum()
    m = (p + q) / 2
    bits = lambda s: np.where(s > 0, s * np.log2(np.where(s > 0, s, 1) / m), 0).sum()
    assert row["js_distance"] == pytest.approx(math.sqrt((bits(p) + bits(q)) / 2))
    expected = np.outer([a.sum(), b.sum()], (a + b) / (a.sum() + b.sum()))
    assert row["chi_square"] == pytest.approx((((np.array([a, b]) - expected) ** 2) / expected).sum())
    assert (row["categories"], row["new_categories"], row["vanished_categories"], row["degrees"]) == (5, 1, 1, 4)
    assert row["p_value"] == pytest.approx(even_tail(row["chi_square"], 4), abs=1e-9) and row["drifted"] == 1


def test_chance_in_a_small_table_is_no_drift(spark):
    rng = np.random.default_rng(6)
    names = [f"c{i}" for i in range(30)]
    small = [table(spark, x=rng.choice(names, n).tolist()) for n in (150, 150)]
    row = categories.categorical_drift(*small, ["x"]).first()
    assert row["js_distance"] > 0.1 and row["p_value"] > 0.05 and row["drifted"] == 0


def test_changes_carry_the_whole_divergence(spark):
    counts = categories.side_counts(table(spark, x=list("aab") + [None]), table(spark, x=list("abc") + [""]), ["x"])
    rows = {x["category"]: x for x in categories.category_changes(counts).collect()}
    assert {k: v["status"] for k, v in rows.items()} == {"a": "kept", "b": "kept", "c": "new", "": "new"}
    figures = categories.drift_of(counts).first()
    assert sum(v["divergence"] for v in rows.values()) == pytest.approx(figures["js_distance"] ** 2)
    assert figures["reference_rate"] == 0.25 and figures["current_rate"] == 0.0


def test_counts_of_parts_add_up(spark):
    df = table(spark, day=["1", "1", "2"], x=["a", None, "a"])
    rows = categories.category_counts(df, ["x"], ["day"]).groupBy("column", "category").agg(F.sum("n").alias("n")).collect()
    assert {r["category"]: r["n"] for r in rows} == {"a": 2, None: 1}


def test_defined_results_at_the_edges(spark):
    some, none = table(spark, x=["a", "a"], y=["p", "q"]), table(spark, x=[None, None], y=["p", "q"])
    rows = {r["column"]: r for r in categories.categorical_drift(some, none, ["x", "y"]).collect()}
    assert rows["x"]["js_distance"] is None and rows["x"]["p_value"] is None and rows["x"]["drifted"] == 0
    assert rows["x"]["current_rate"] == 1.0
    assert rows["y"]["js_distance"] == 0.0 and rows["y"]["p_value"] == 1.0
    both_null = categories.categorical_drift(none, none, ["x"]).first()
    assert both_null["categories"] == 0 and both_null["js_distance"] is None and both_null["p_value"] is None
    single = categories.categorical_drift(some, some, ["x"]).first()
    assert single["degrees"] == 0 and single["p_value"] == 1.0
    assert categories.categorical_drift(some.limit(0), some.limit(0), ["x"]).count() == 0


def test_summary_counts_both_kinds(spark):
    rows = lambda kind: [(float(v % 7), k) for v, k in enumerate(kind)]
    r = spark.createDataFrame(rows(["a", "b"] * 200), "v double, kind string")
    c = spark.createDataFrame(rows(["c", "b"] * 200), "v double, kind string")
    summary = drift.drift_summary(r, c, ["v"], categorical=["kind"])
    row = summary.first()
    assert (row["total_columns"], row["drifted_columns"], row["new_categories"], row["dataset_drift"]) == (2, 1, 1, 1)
    assert {a["type"] for a in alerts.data_alerts(summary).collect()} == {"COLUMN_DRIFT"}


def test_distinct_counts_in_one_scan(spark, tables):
    df = spark.createDataFrame([("a", 1), ("b", 1), (None, 2), ("a", None)], "x string, y long")
    assert profile.distinct_counts(df, ["x", "y"]).first().asDict() == {"total_rows": 4, "unique_x": 2, "unique_y": 2}
    assert profile.distinct_counts(df.limit(0), ["x", "y"]).first().asDict() == {"total_rows": 0, "unique_x": 0, "unique_y": 0}
    plan = profile.distinct_counts(tables.shop_events, ["user_id", "brand"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2  # the events and the catalogue
