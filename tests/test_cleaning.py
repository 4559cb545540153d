import pytest
from pyspark.sql import functions as F

from basketry.operators import cleaning, features, profile
from basketry.schemas import EVENTS, SchemaError, enforce_schema


def test_median_of_an_even_number_of_values(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 2.0)], "id long, price double")
    got = {r["id"]: r["price"] for r in cleaning.fill_median(df, ["price"]).collect()}
    assert got == {1: 1.0, 2: 1.5, 3: 2.0}


def test_median_of_nothing_leaves_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id long, price double")
    assert [r["price"] for r in cleaning.fill_median(df, ["price"]).collect()] == [None, None]


def test_median_of_several_columns_in_one_plan(spark):
    df = spark.createDataFrame([(1.0, None), (None, 4.0), (3.0, 8.0)], "a double, b double")
    assert sorted(map(tuple, cleaning.fill_median(df, ["a", "b"]).collect())) == [(1.0, 6.0), (2.0, 4.0), (3.0, 8.0)]


def test_duplicate_report_counts_rows_with_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a long, b string")
    assert cleaning.duplicate_report(df).first()[:] == (3, 2, 1)
    assert cleaning.duplicate_report(df.limit(0)).first()[:] == (0, 0, 0)


def test_schema_check_and_enforcement(spark, tables):
    with pytest.raises(SchemaError, match="category_id, brand"):
        enforce_schema(tables.event_log, EVENTS)
    checked = {r["column"]: r["present"] for r in cleaning.schema_check(tables.event_log, EVENTS).collect()}
    assert checked["price"] and not checked["brand"]
    assert enforce_schema(tables.shop_events, EVENTS).schema.names == EVENTS.names


def test_request_validation_reasons(spark):
    rows = [(1, "5", "10.5"), (2, "x", "1"), (3, None, "1"), (4, "5", None), (5, "5", "-1"), (6, "5", "abc"),
            (7, "y", "-3"), (8, "5", "1000000"), (9, "5", "0")]
    df = spark.createDataFrame(rows, "request_id long, user_id string, transaction_amount string")
    rejected = {r["request_id"]: r["reason"] for r in cleaning.rejected_requests(df).collect()}
    assert rejected == {
        2: "user_id not an integer",
        3: "user_id missing",
        4: "transaction_amount missing",
        5: "transaction_amount negative",
        6: "transaction_amount not a number",
        7: "user_id not an integer; transaction_amount negative",
    }
    assert {r["request_id"] for r in cleaning.accepted_requests(df).collect()} == {1, 8, 9}


def test_recent_is_strict(spark):
    df = spark.sql("SELECT timestamp'2024-01-02 00:00:00' AS event_time UNION ALL SELECT timestamp'2024-01-02 00:00:01'")
    kept = cleaning.recent(df, F.lit("2024-01-03").cast("timestamp"), 24).count()
    assert kept == 1


def test_type_filter_and_columns_reach_the_scan(tables):
    df = tables.events_of("purchase").select("user_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,purchase)" in plan or "In(event_type, [purchase])" in plan
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in plan


def test_date_filter_prunes_processed_folders(spark, tables, tmp_path):
    from basketry.sources import sinks

    path = str(tmp_path / "processed")
    sinks.write_processed(tables.event_log, path)
    df = cleaning.in_date_range(spark.read.parquet(path), "2024-01-03", "2024-01-04")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    expected = cleaning.in_time_range(tables.event_log, "2024-01-03", "2024-01-04").count()
    assert df.count() == expected > 0


def test_histogram_edges_and_constant(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,), (None,)], "v double")
    got = {r["bin"]: r["n"] for r in profile.histogram(df, F.col("v"), 10).collect()}
    assert got == {0: 1, 5: 1, 9: 1}
    constant = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert [(r["bin"], r["n"]) for r in profile.histogram(constant, F.col("v"), 10).collect()] == [(0, 2)]


def test_error_rates_and_throughput_without_rows(spark):
    empty = spark.createDataFrame([], "model string, event_time timestamp, e boolean")
    assert profile.error_rates(empty, F.col("e")).first()["success_rate"] == 0.0
    one = spark.sql("SELECT 'a' AS model, timestamp'2024-01-01' AS event_time")
    assert profile.throughput(one).first()["requests_per_second"] == 0.0


def test_error_categories_first_match_wins(spark):
    rows = [("Connection timeout", 503), ("Connection reset", None), (None, 500), ("bad", 422), ("bad", None)]
    df = spark.createDataFrame(rows, "message string, status int")
    names = ["timeout", "connection_error", "server_error", "client_error", "other"]
    assert {r["category"]: r["n"] for r in profile.error_counts(df, names).collect()} == dict.fromkeys(names, 1)


def test_user_without_prices(spark):
    df = spark.sql(
        "SELECT 1L AS user_id, 'purchase' AS event_type, cast(null AS double) AS price UNION ALL SELECT 2L, 'view', 4.0D"
    )
    got = {r["user_id"]: r for r in features.user_price_stats(df).collect()}
    assert got[1]["user_event_count"] == 0 and got[1]["user_purchase_rate"] == 0.0 and got[1]["user_price_mean"] == 0.0
    assert got[2]["user_price_std"] == 0.0


def test_trailing_window_has_no_row_loss_with_gaps(spark):
    df = spark.sql(
        """SELECT to_date(d) AS event_date, t AS event_type, p AS product_id, 1L AS user_id, 1.0D AS price, 's' AS user_session
           FROM VALUES ('2024-01-01','purchase',1L), ('2024-01-02','view',1L), ('2024-01-03','purchase',2L), ('2024-01-04','purchase',1L)
           AS v(d, t, p)"""
    )
    dates = {str(r[0]): (str(r[1]), str(r[2])) for r in features.lagged_demand_dates(df, 2).collect()}
    assert dates == {"2024-01-04": ("2024-01-01", "2024-01-03")}
    got = {(str(r["target_date"]), r["product_id"]): r["total_events"] for r in features.demand_dataset(df, 2).collect()}
    assert got == {("2024-01-04", 1): 2, ("2024-01-04", 2): 1}


def test_joint_encoding_equals_the_separate_operators(tables):
    joint = features.encode_categories(tables.shop_events, features.ENCODED)
    apart = features.popular_flags(
        features.frequency_encode(tables.shop_events, features.ENCODED), features.ENCODED
    ).select(joint.columns)
    assert joint.exceptAll(apart).count() == 0 and apart.exceptAll(joint).count() == 0
