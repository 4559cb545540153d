import numpy as np
import pytest

from basketry.operators import alerts, drift


def frame(spark, **columns):
    names = list(columns)
    rows = [tuple(None if v is None else float(v) for v in row) for row in zip(*columns.values())]
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))


@pytest.fixture(scope="module")
def pair(spark):
    rng = np.random.default_rng(42)
    ref = dict(feature1=rng.normal(0, 1, 1000), feature2=rng.exponential(1, 1000), feature3=rng.integers(0, 10, 1000), flat=np.ones(1000))
    cur = dict(feature1=rng.normal(1, 1, 1000), feature2=rng.exponential(1, 1000), feature3=rng.integers(0, 10, 1000), flat=np.ones(1000))
    return ref, cur, frame(spark, **ref), frame(spark, **cur)


COLUMNS = ["feature1", "feature2", "feature3", "flat"]


def numpy_psi(r, c):
    lo, hi = min(r.min(), c.min()), max(r.max(), c.max())
    if lo == hi:
        return 0.0
    edges = np.linspace(lo, hi, 11)
    a = np.histogram(r, edges)[0] / len(r)
    b = np.histogram(c, edges)[0] / len(c)
    a, b = np.where(a == 0, 1e-4, a), np.where(b == 0, 1e-4, b)
    return float(((b - a) * np.log(b / a)).sum())


def test_psi_equals_numpy(pair):
    ref, cur, r, c = pair
    got = {x["column"]: x["psi"] for x in drift.psi(r, c, COLUMNS).collect()}
    for name in COLUMNS:
        assert got[name] == pytest.approx(numpy_psi(np.asarray(ref[name], float), np.asarray(cur[name], float)), abs=1e-9)
    assert got["flat"] == 0.0
    same = {x["column"]: x["psi"] for x in drift.psi(r, r, COLUMNS).collect()}
    assert all(v == pytest.approx(0.0) for v in same.values())


def test_distances_equal_numpy(pair):
    ref, cur, r, c = pair
    got = {x["column"]: x for x in drift.distances(r, c, COLUMNS).collect()}
    for name in COLUMNS:
        a, b = np.sort(np.asarray(ref[name], float)), np.sort(np.asarray(cur[name], float))
        grid = np.unique(np.concatenate([a, b]))
        fa = np.searchsorted(a, grid, side="right") / len(a)
        fb = np.searchsorted(b, grid, side="right") / len(b)
        assert got[name]["ks_statistic"] == pytest.approx(np.abs(fa - fb).max())
        assert got[name]["wasserstein"] == pytest.approx((np.abs(fa - fb)[:-1] * np.diff(grid)).sum())
    assert got["feature1"]["ks_p_value"] < 1e-6
    assert got["feature2"]["ks_p_value"] > 0.01
    assert got["flat"]["ks_p_value"] == 1.0


def test_one_empty_side_gives_null_distances(spark):
    r = frame(spark, x=[1.0, 2.0])
    c = frame(spark, x=[None, None])
    row = drift.distances(r, c, ["x"]).first()
    assert row["ks_statistic"] is None


def test_summary_and_alerts(pair):
    _, _, r, c = pair
    summary = drift.drift_summary(r, c, COLUMNS)
    row = summary.first()
    assert row["drift_score"] > 0.2 and row["drifted_columns"] == 1 and row["total_columns"] == 4
    assert row["dataset_drift"] == 0
    fired = {a["type"]: a for a in alerts.data_alerts(summary).collect()}
    assert fired["DATA_DRIFT"]["level"] == "CRITICAL" and fired["COLUMN_DRIFT"]["value"] == 1.0
    assert "MISSING_VALUES" not in fired
    calm = alerts.data_alerts(drift.drift_summary(r, r, COLUMNS))
    assert calm.count() == 0


def test_concept_drift_after_a_flipped_relation(spark):
    rng = np.random.default_rng(42)
    f1, f2 = rng.normal(size=1000), rng.normal(size=1000)
    y = np.where(np.arange(1000) < 500, f1 > 0, f1 < 0).astype(float)
    position = np.arange(1000.0)
    df = frame(spark, feature1=f1, position=position, y=y, p=(f1 > 0).astype(float), feature2=f2)
    got = {r["column"]: r["drift"] for r in drift.concept_drift(df, ["feature1", "position", "feature2"], "y", "p").collect()}
    assert got["position"] == 1 and got["feature2"] == 0


def test_quality_tests_flag_missing_values(spark):
    r = frame(spark, x=[1.0, 2.0, 3.0, None])
    c = frame(spark, x=[1.0, None, None, None])
    got = {(t["test"], t["column"]): t["passed"] for t in drift.quality_tests(r, c, ["x"]).collect()}
    assert got[("row_count", "*")] and got[("column_count", "*")]
    assert not got[("null_share", "x")] and not got[("max", "x")] and got[("min", "x")]


def test_daily_ks_equals_numpy_on_every_day(spark, monkeypatch):
    monkeypatch.setattr(drift, "RANK_BUCKETS", 7)
    rng = np.random.default_rng(8)
    ref = np.round(rng.normal(0, 1, 800), 1)
    days = {"a": np.round(rng.normal(0.3, 1, 300), 1), "b": np.full(50, 9.0), "c": np.full(40, -9.0), "d": ref[:1], "e": np.round(rng.normal(0, 3, 500), 3)}
    reference = spark.createDataFrame([(float(v),) for v in ref], "x double")
    current = spark.createDataFrame([(d, float(v)) for d, vs in days.items() for v in vs], "day string, x double")
    counts = drift.value_counts_by(current, ["x"], ["day"])
    got = {r["day"]: r["ks_statistic"] for r in drift.daily_ks(drift.value_counts_by(reference, ["x"], []), counts).collect()}
    for day, values in days.items():
        grid = np.unique(np.concatenate([ref, values]))
        fa = np.searchsorted(np.sort(ref), grid, side="right") / len(ref)
        fb = np.searchsorted(np.sort(values), grid, side="right") / len(values)
        assert got[day] == pytest.approx(np.abs(fa - fb).max())
    assert got["b"] == got["c"] == 1.0


def test_daily_ks_without_a_reference_has_no_row(spark):
    none = drift.value_counts_by(frame(spark, x=[1.0]).limit(0), ["x"], [])
    day = drift.value_counts_by(spark.createDataFrame([("a", 1.0)], "day string, x double"), ["x"], ["day"])
    assert drift.daily_ks(none, day).count() == 0 and drift.daily_ks(none, day.limit(0)).count() == 0
