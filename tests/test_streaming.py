import pytest
from pyspark.sql import functions as F

from basketry.operators import alerts
from basketry.session import new_path
from basketry.sources.readers import incremental_read
from basketry.streaming import jobs

from .conftest import SMALL


@pytest.fixture(scope="module")
def split_dir(spark, tmp_path_factory):
    """The small event table as a folder of files in random time order."""
    root = str(tmp_path_factory.mktemp("stream"))
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    for part in (3, 0, 5, 1, 4, 2):  # files are streamed in order of their age
        events.where(F.pmod(F.xxhash64("event_id"), F.lit(6)) == part).coalesce(1).write.mode("append").parquet(
            f"{root}/events.parquet"
        )
    return root


@pytest.fixture()
def stream(spark, split_dir):
    return jobs.event_stream(spark, split_dir, bytes_per_trigger=1)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_every_event_is_read_once_in_many_batches(tables, stream):
    got = jobs.collect_batches(stream, "t-scan")
    assert got.select("batch_id").distinct().count() == 6
    assert rows(got.select("event_id", "event_time")) == rows(tables.all_events.select("event_id", "event_time"))


def test_csv_files_as_a_stream(spark, tmp_path):
    path = str(tmp_path / "rows.csv")
    spark.range(100).selectExpr("id", "id * 2 as twice").repartition(4).write.option("header", True).csv(path)
    stream = incremental_read(spark, path, "id long, twice long", "csv", 1, {"header": True})
    got = jobs.collect_batches(stream, "t-csv")
    assert got.select("batch_id").distinct().count() > 1
    assert rows(got.select("id", "twice")) == rows(spark.range(100).selectExpr("id", "id * 2 as twice"))


def test_user_activity_equals_batch(tables, stream):
    expected = tables.all_events.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("event_time"), F.when(F.count(F.lit(1)) < 3, 1).otherwise(0)
    )
    assert rows(jobs.user_activity(stream, name="t-activity")) == rows(expected)


def test_feature_update_equals_batch(tables, stream):
    got = jobs.feature_update(stream, "t-features").select("user_id", "total_events", "total_views")
    expected = tables.all_events.groupBy("user_id").agg(
        F.count(F.lit(1)), F.count_if(F.col("event_type") == "view")
    )
    assert rows(got) == rows(expected)


def test_inference_parts_lose_no_request(tables, stream):
    parts = jobs.collect_parts(jobs.request_stream(stream), jobs.inference_parts, "t-inference")
    got = {(r["window_start"], r["model"]): r for r in jobs.current_inference(parts).collect()}
    requests = jobs.request_stream(tables.all_events)
    batch = requests.groupBy(F.window("event_time", "5 minutes")["start"].alias("w"), "model").agg(
        F.count(F.lit(1)).alias("n"), F.avg("latency").alias("mean"), F.stddev_pop("latency").alias("std"),
        F.sum("is_error").alias("errors"), F.percentile_approx("latency", 0.95, 100_000).alias("p95"),
    ).collect()
    assert len(got) == len(batch)
    for r in batch:
        own = got[r["w"], r["model"]]
        assert own["requests"] == r["n"] and own["latency_p95"] == r["p95"]
        assert own["latency_mean"] == pytest.approx(r["mean"]) and own["latency_std"] == pytest.approx(r["std"], abs=1e-9)
        assert own["error_rate"] == pytest.approx(r["errors"] / r["n"])


def test_all_score_pairs_are_compared(tables, spark, split_dir):
    sides = [jobs.score_stream(jobs.event_stream(spark, split_dir, 1), m) for m in ("production", "shadow")]
    assert jobs.pair_scores(*sides).count() == tables.all_events.count()


def test_late_rows_are_an_error_unless_allowed(tables, stream):
    requests = jobs.request_stream(stream)
    with pytest.raises(jobs.LateRows):
        jobs.collect_batches(jobs.inference_metrics(requests), "t-late")
    jobs.collect_batches(jobs.inference_metrics(requests), "t-late-allowed", allow_late=True)
    closed = jobs.collect_batches(jobs.inference_metrics(requests, "400 days"), "t-wide", "update")
    got = {(r["window_start"], r["model"]): r["requests"] for r in jobs.latest_update(closed, ["window_start", "model"]).collect()}
    assert sum(got.values()) == 2 * tables.all_events.count()


def test_rows_dropped_in_any_batch_are_counted(spark, stream):
    """A query keeps the progress of few batches; all of them count."""
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "1")
    try:
        dropped = jobs.DroppedRows()
        spark.streams.addListener(dropped)
        query = jobs.run_batches(jobs.inference_metrics(jobs.request_stream(stream)), jobs._batch_files(new_path(spark, "t-drop")), "t-drop")
        kept = sum(int(s.numRowsDroppedByWatermark) for p in query.recentProgress for s in p.stateOperators)
        assert len(query.recentProgress) <= 1 and dropped.of(query) > kept
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
        spark.streams.removeListener(dropped)


def test_repeated_batch_replaces_its_own_output(spark, tables):
    path = new_path(spark, "t-repeat")
    write = jobs._batch_files(path)
    for _ in range(2):
        write(tables.all_events.limit(10).select("event_id"), 0)
    assert spark.read.option("recursiveFileLookup", True).parquet(path).count() == 10


def test_drift_is_per_day_whatever_the_batches(spark, tables, split_dir):
    reference = tables.all_events.select((F.col("value") * 3).alias("value"), F.col("k").cast("double").alias("k"))
    found = []
    for size in (1, 1 << 30):
        stream = jobs.event_stream(spark, split_dir, size).withColumn("k", F.col("k").cast("double"))
        found.append(jobs.drift_monitor(stream, reference, ["value", "k"], "t-drift"))
    assert rows(found[0]) == rows(found[1])
    days = tables.all_events.select(F.to_date("event_time")).distinct().count()
    assert found[0].count() == days
    assert "DATA_DRIFT" in {r["type"] for r in jobs.drift_alerts(found[0]).collect()}
    assert alerts.data_alerts(found[0].where("drift_score < 0")).count() == 0
