import datetime as dt
import random

from pyspark.sql import functions as F

from basketry.operators import joins

BASE = dt.datetime(2024, 1, 1)


def at(seconds):
    return BASE + dt.timedelta(seconds=seconds)


def brute_asof(entities, features, ttl):
    out = {}
    for eid, key, when in entities:
        best = None
        for fkey, ftime, created, value in features:
            if key is not None and fkey == key and ftime <= when:
                if best is None or (ftime, created) > (best[0], best[1]):
                    best = (ftime, created, value)
        fresh = best is not None and (when - best[0]).total_seconds() <= ttl
        out[eid] = best[2] if fresh else None
    return out


def run_asof(spark, entities, features, ttl, **options):
    e = spark.createDataFrame(entities, "id long, k long, event_timestamp timestamp")
    f = spark.createDataFrame(features, "k long, event_timestamp timestamp, created_timestamp timestamp, v long")
    got = joins.asof_join(e, f, ["k"], ["v"], ttl, **options).collect()
    assert len(got) == len(entities)
    return {r["id"]: r["v"] for r in got}


def test_asof_equals_brute_force_with_a_hot_key(spark):
    rng = random.Random(3)

    def key():
        return 1 if rng.random() < 0.6 else rng.randrange(2, 8)

    features = [(key(), at(rng.randrange(200_000)), at(i), i) for i in range(800)]
    entities = [(i, key(), at(rng.randrange(200_000))) for i in range(600)]
    for bucket in (60, 3600, 10**6):
        assert run_asof(spark, entities, features, 5000, bucket_seconds=bucket) == brute_asof(entities, features, 5000)


def test_asof_edges(spark):
    features = [(1, at(100), at(1), 10), (1, at(100), at(2), 11), (2, at(50), at(0), 20), (None, at(0), at(0), 99)]
    entities = [
        (1, 1, at(100)),   # equal time matches; the later created row wins
        (2, 1, at(99)),    # feature lies in the future
        (3, 2, at(150)),   # exactly at the time-to-live
        (4, 2, at(151)),   # one second too old
        (5, None, at(10)),  # no key, no match
        (6, 3, at(10)),    # unknown key
    ]
    assert run_asof(spark, entities, features, 100) == {1: 11, 2: None, 3: 20, 4: None, 5: None, 6: None}


def test_asof_keeps_latest_row_even_if_its_value_is_null(spark):
    features = [(1, at(0), at(0), 5), (1, at(10), at(10), None)]
    assert run_asof(spark, [(1, 1, at(20))], features, 1000) == {1: None}


def test_previous_time_equals_lag(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice([1, 1, 1, 2, 3]), at(rng.randrange(100_000))) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, k long, t timestamp")
    got = joins.previous_time(df, ["k"], "t", "before", bucket_seconds=600).collect()
    assert len(got) == 500
    for key in (1, 2, 3):
        times = sorted(t for _, k, t in rows if k == key)
        previous = sorted((r["t"], r["before"] or dt.datetime.min) for r in got if r["k"] == key)
        assert previous == sorted(zip(times, [dt.datetime.min, *times[:-1]]))


def test_attach_equals_a_plain_left_join(spark):
    rows = [(i, None if i % 11 == 0 else ("hot" if i % 3 == 0 else f"k{i % 400}")) for i in range(4000)]
    facts = spark.createDataFrame(rows, "event_id long, k string")
    lookup = (
        facts.where("k is not null")
        .groupBy("k")
        .agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first"))
        .where("k <> 'k7'")
    )
    plain = facts.join(lookup.drop("n"), "k", "left").select("event_id", "k", "first")
    split = joins.attach(facts, lookup, "k", "n")
    assert sorted(map(str, plain.collect())) == sorted(map(str, split.collect()))
    assert split.count() == 4000
    assert split.where("k is null and first is not null").count() == 0
    assert split.where("k = 'k7' and first is not null").count() == 0


def test_lookup_default_mean_for_unknown_users(spark):
    users = spark.createDataFrame([(1, 2.0, None), (2, 4.0, 6.0)], "user_id long, a double, b double")
    requests = spark.createDataFrame([(1,), (2,), (999999,), (-1,), (0,), (10**9,)], "user_id long")
    got = {r["user_id"]: r for r in joins.lookup_default_mean(requests, users, "user_id").collect()}
    assert (got[1]["a"], got[1]["b"], got[1]["is_default"]) == (2.0, None, 0)
    for unknown in (999999, -1, 0, 10**9):
        assert (got[unknown]["a"], got[unknown]["b"], got[unknown]["is_default"]) == (3.0, 6.0, 1)


def test_consistency_check_nulls_and_tolerance(spark):
    a = spark.createDataFrame([(1, 1.0), (2, None), (3, None), (4, 5.0)], "k long, v double")
    b = spark.createDataFrame([(1, 1.000001), (2, None), (3, 2.0), (5, 1.0)], "k long, v double")
    got = {r["k"]: r["passed"] for r in joins.consistency_check(a, b, ["k"], ["v"]).collect()}
    assert got == {1: True, 2: True, 3: False, 4: False, 5: False}


def test_online_table_range_and_tie(spark):
    rows = [(1, at(0), at(0), 1), (1, at(10), at(1), 2), (1, at(10), at(2), 3), (1, at(99), at(0), 4), (2, at(5), at(5), 5)]
    df = spark.createDataFrame(rows, "k long, event_timestamp timestamp, created_timestamp timestamp, v long")
    got = joins.online_table(df, ["k"], F.lit(at(0)), F.lit(at(50))).collect()
    assert {r["k"]: r["v"] for r in got} == {1: 3, 2: 5}


def test_cold_threshold(spark):
    events = spark.createDataFrame([(1,)] * 3 + [(2,)] * 2, "user_id long")
    users = spark.createDataFrame([(1,), (2,), (3,)], "user_id long")
    got = {r["user_id"]: r["is_cold"] for r in joins.cold_flags(users, events, "user_id").collect()}
    assert got == {1: 0, 2: 1, 3: 1}
