"""Merged parts: bounded reads, repeated batches, runs that break off between any two steps."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.session import new_path
from basketry.streaming import jobs
from basketry.streaming.parts import Parts

from .test_streaming import rows, split_dir, stream  # noqa: F401  (fixtures)


class Broken(RuntimeError):
    pass


def summed(df):
    return df.groupBy("k").agg(F.sum("n").alias("n"))


def part(spark, batch):
    return spark.range(batch, batch + 5).selectExpr("id % 7 as k", "id as n").transform(summed)


def expected(spark, batches):
    total = {}
    for batch in batches:
        for i in range(batch, batch + 5):
            total[i % 7] = total.get(i % 7, 0) + i
    return sorted(total.items())


def opened(spark, folder, **how):
    return Parts(spark, folder, part(spark, 0).schema, summed, **{"fanout": 3, "keep": 2, **how})


def test_reads_stay_bounded_and_old_files_go(spark):
    folder = new_path(spark, "t-parts")
    parts = opened(spark, folder)
    for batch in range(30):
        parts.add(part(spark, batch), batch)
        per_level = {}
        for entry in parts.entries:
            per_level[entry.level] = per_level.get(entry.level, 0) + 1
        assert max(per_level.values()) < 3 and len(per_level) <= 4
    assert sorted(map(tuple, parts.current().collect())) == expected(spark, range(30))
    assert parts.entries[0].first_batch == 0 and parts.entries[-1].last_batch == 29
    assert len(parts.files.names(f"{folder}/manifest")) <= 3
    # Nothing but the parts of the kept versions is left.
    assert len(parts.files.names(f"{folder}/data")) <= 2 * len(parts.entries) + 3


def test_repeated_batches_change_nothing_also_after_reopening(spark):
    folder = new_path(spark, "t-repeat-parts")
    parts = opened(spark, folder)
    for batch in (0, 1, 1, 2, 3, 0):
        parts.add(part(spark, batch), batch)
    again = opened(spark, folder)
    assert (again.version, again.entries) == (parts.version, parts.entries)
    for batch in (2, 3, 4):
        again.add(part(spark, batch), batch)
    assert sorted(map(tuple, again.current().collect())) == expected(spark, range(5))


@pytest.mark.parametrize("fail_at", range(1, 7))
def test_a_break_before_any_commit_loses_and_doubles_nothing(spark, monkeypatch, fail_at):
    """Data is written, its manifest is not: the next run repeats the batch."""
    folder = new_path(spark, "t-broken-parts")
    commit, calls = Parts._commit, []

    def breaking(self, entries):
        calls.append(1)
        if len(calls) == fail_at:
            raise Broken
        commit(self, entries)

    monkeypatch.setattr(Parts, "_commit", breaking)
    parts, batch, broken = opened(spark, folder), 0, 0
    while batch < 5:
        try:
            parts.add(part(spark, batch), batch)
            batch += 1
        except Broken:
            broken += 1
            parts = opened(spark, folder)
    assert broken == 1
    assert sorted(map(tuple, parts.current().collect())) == expected(spark, range(5))
    live = {e.path for e in parts.entries}
    assert live <= set(parts.files.names(f"{folder}/data"))


def test_empty_log_and_bad_settings(spark):
    parts = opened(spark, new_path(spark, "t-empty-parts"))
    assert parts.current().count() == 0 and parts.current().columns == ["k", "n"]
    with pytest.raises(ValueError):
        opened(spark, new_path(spark, "t-bad-parts"), fanout=1)


def test_a_stream_that_breaks_goes_on_in_its_folder(spark, tables, stream, monkeypatch):  # noqa: F811
    folder = new_path(spark, "t-resume")
    add = Parts.add

    def breaking(self, df, number):
        add(self, df, number)
        if number == 3:
            raise Broken("after the commit")

    monkeypatch.setattr(Parts, "add", breaking)
    with pytest.raises(Exception, match="after the commit"):
        jobs.user_activity(stream, folder=folder)
    monkeypatch.setattr(Parts, "add", add)
    got = jobs.user_activity(stream, folder=folder).select("user_id", "event_count")
    assert rows(got) == rows(tables.all_events.groupBy("user_id").count())
    # Nothing new in the source: nothing is added.
    assert rows(jobs.user_activity(stream, folder=folder).select("user_id", "event_count")) == rows(got)


@pytest.mark.parametrize("n", [1, 50, 100_000])
def test_newest_requests_do_not_depend_on_the_batches(tables, stream, n):  # noqa: F811
    whole = jobs.newest_requests(jobs.request_stream(tables.all_events), n)
    assert whole.groupBy("model").count().where(F.col("count") > n).count() == 0
    got = jobs.last_requests(jobs.request_stream(stream), n, "t-newest")
    close = lambda df: [
        tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.orderBy("model").collect()
    ]
    assert close(got) == close(jobs.window_metrics(whole, n))


def test_window_figures_equal_numpy(spark):
    values = np.random.default_rng(1).exponential(10, 40)
    requests = spark.createDataFrame(
        [(i, i // 2, int(i % 4 == 0), "m", float(v)) for i, v in enumerate(values)],
        "request_id long, s long, is_error int, model string, latency double",
    ).withColumn("event_time", F.timestamp_seconds("s"))
    row = jobs.window_metrics(jobs.newest_requests(requests, 20), 20).first()
    last = values[20:]
    assert row["latency_p95"] == pytest.approx(np.percentile(last, 95)) and row["latency_std"] == pytest.approx(last.std())
    assert row["requests_per_second"] == pytest.approx(20 / 9) and row["error_rate"] == 0.25
    single = jobs.window_metrics(jobs.newest_requests(requests, 1), 1).first()
    assert single["requests_per_second"] == 0.0 and single["total_requests"] == 1


def test_hot_model_is_cut_before_the_shuffle(tables):
    plan = jobs.newest_requests(jobs.request_stream(tables.all_events), 1000)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_sketch_of_a_large_window_keeps_rank_and_size(spark):
    """400,000 latencies in 16 parts: the rank of the quantile and the bytes stay within what is stated."""
    n = 400_000
    requests = spark.range(n).select(
        F.timestamp_seconds(F.col("id") % 300).alias("event_time"),
        F.when(F.col("id") % 10 == 0, 1).otherwise(0).alias("is_error"),
        F.lit("m").alias("model"),
        (F.rand(5) * F.rand(6)).alias("latency"),
        (F.col("id") % 16).alias("batch"),
    )
    path = new_path(spark, "t-latencies")
    requests.write.parquet(path)
    requests = spark.read.parquet(path)
    merged = None
    for batch in range(16):
        one = jobs.sketch_parts(requests.where(F.col("batch") == batch))
        merged = one if merged is None else merged.unionByName(one)
    merged = jobs.merge_sketches(merged)
    size = merged.select(F.length("sketch")).first()[0]
    assert size < 3 * 8 * jobs.SKETCH_SIZE
    row = jobs.sketched_inference(merged).first()
    latencies = np.sort([r[0] for r in requests.select("latency").collect()])
    assert abs(np.searchsorted(latencies, row["latency_p95"], side="right") / n - 0.95) < 0.003
    assert row["requests"] == n and row["error_rate"] == pytest.approx(0.1)
    assert row["latency_mean"] == pytest.approx(latencies.mean()) and row["latency_std"] == pytest.approx(latencies.std())


def test_sketch_of_a_window_without_latencies(spark):
    requests = spark.createDataFrame([(0, 1, "m", None), (1, 0, "m", None)], "s long, is_error int, model string, latency double")
    merged = jobs.merge_sketches(jobs.sketch_parts(requests.withColumn("event_time", F.timestamp_seconds("s"))))
    row = jobs.sketched_inference(merged).first()
    assert row["requests"] == 2 and row["latency_p95"] is None and row["latency_mean"] is None and row["error_rate"] == 0.5


def test_sketches_of_up_to_their_size_are_exact_when_merged(spark):
    values = np.random.default_rng(4).exponential(3, 4000)
    requests = spark.createDataFrame(
        [(0, 0, "m", float(v), i % 16) for i, v in enumerate(values)], "s long, is_error int, model string, latency double, batch int"
    ).withColumn("event_time", F.timestamp_seconds("s"))
    merged = None
    for batch in range(16):
        one = jobs.sketch_parts(requests.where(F.col("batch") == batch))
        merged = one if merged is None else jobs.merge_sketches(merged.unionByName(one))
    assert jobs.sketched_inference(merged).first()["latency_p95"] == np.sort(values)[3799]
