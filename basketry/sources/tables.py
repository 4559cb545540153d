"""The given tables, and the canonical inputs derived from them by views.

Nothing is generated: every input is a projection, join or aggregate of the
given parquet tables, so the work of a query grows with those tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..operators import features
from ..operators.metrics import melt_scores
from .readers import read_table

SPLIT_DATE = "2024-01-16"


class Tables:
    """Lazily built views over one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    # --- event log --------------------------------------------------------

    @cached_property
    def all_events(self) -> DataFrame:
        """Every event, time as a UTC timestamp."""
        return self.raw("events").select(
            "event_id",
            F.col("ts").cast("timestamp").alias("event_time"),
            "user_id",
            "event_type",
            "value",
            F.get_json_object("props", "$.k").cast("long").alias("k"),
        )

    RAW_TYPES = {"view": "view", "cart": "click", "purchase": "purchase"}

    def events_of(self, *kinds: str) -> DataFrame:
        """Events of the given types, filtered on the stored type so the scan can use it."""
        raw = [self.RAW_TYPES[kind] for kind in kinds]
        return (
            self.all_events.where(F.col("event_type").isin(raw))
            .select(
                "event_id",
                "event_time",
                F.when(F.col("event_type") == "click", "cart")
                .otherwise(F.col("event_type"))
                .alias("event_type"),
                F.col("k").alias("product_id"),
                F.when(F.col("event_id") % 50 != 0, F.col("value")).alias("price"),
                "user_id",
                F.concat_ws("-", "user_id", F.to_date("event_time")).alias("user_session"),
            )
        )

    @cached_property
    def event_log(self) -> DataFrame:
        """Views, carts and purchases without catalogue columns (no join)."""
        return self.events_of("view", "cart", "purchase")

    @cached_property
    def catalog(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_type").alias("category_id"),
            F.when(F.col("p_partkey") % 10 != 0, F.col("p_brand")).alias("brand"),
        )

    @cached_property
    def shop_events(self) -> DataFrame:
        """Canonical event table.  The catalogue is joined without a hint: the
        planner broadcasts it only while its size allows, and a product with
        very many events is split at run time (see ``session.RUNTIME_SETTINGS``)."""
        return self.event_log.join(self.catalog, "product_id", "left").select(
            "event_id", "event_time", "event_type", "product_id", "category_id",
            "brand", "price", "user_id", "user_session",
        )

    @cached_property
    def dated_events(self) -> DataFrame:
        return self.event_log.withColumn("event_date", F.to_date("event_time"))

    @cached_property
    def duplicated_events(self) -> DataFrame:
        return self.shop_events.unionByName(self.shop_events.where(F.col("event_id") % 20 == 0))

    @cached_property
    def reference(self) -> DataFrame:
        return self.numeric_events.where(F.col("event_time") < F.lit(SPLIT_DATE).cast("timestamp"))

    @cached_property
    def current(self) -> DataFrame:
        return self.numeric_events.where(F.col("event_time") >= F.lit(SPLIT_DATE).cast("timestamp"))

    @cached_property
    def numeric_events(self) -> DataFrame:
        """Numeric columns watched for drift."""
        return self.event_log.select(
            "event_time",
            "price",
            F.col("product_id").cast("double").alias("product_id"),
            F.hour("event_time").cast("double").alias("hour"),
            X.purchase_label().cast("double").alias("target"),
        )

    DRIFT_COLUMNS = ["price", "product_id", "hour", "target"]
    DRIFT_CATEGORIES = ["event_type", "brand", "category_id"]

    @cached_property
    def mixed_events(self) -> DataFrame:
        """Numeric and categorical columns watched for drift."""
        return self.shop_events.select(
            "event_time",
            "price",
            F.col("product_id").cast("double").alias("product_id"),
            F.hour("event_time").cast("double").alias("hour"),
            X.purchase_label().cast("double").alias("target"),
            *self.DRIFT_CATEGORIES,
        )

    @cached_property
    def mixed_reference(self) -> DataFrame:
        return self.mixed_events.where(F.col("event_time") < F.lit(SPLIT_DATE).cast("timestamp"))

    @cached_property
    def mixed_current(self) -> DataFrame:
        return self.mixed_events.where(F.col("event_time") >= F.lit(SPLIT_DATE).cast("timestamp"))

    @cached_property
    def line_reference(self) -> DataFrame:
        return self._line_items(F.col("l_shipdate") < F.lit("1998-07-01").cast("timestamp_ntz"))

    @cached_property
    def line_current(self) -> DataFrame:
        return self._line_items(F.col("l_shipdate") >= F.lit("1998-07-01").cast("timestamp_ntz"))

    LINE_COLUMNS = ["l_extendedprice", "l_quantity", "l_discount"]

    def _line_items(self, condition) -> DataFrame:
        return self.raw("lineitem").where(condition).select(*self.LINE_COLUMNS)

    # --- daily feature tables, stamped at the next midnight -----------------

    @cached_property
    def daily_user_features(self) -> DataFrame:
        return features.daily_snapshot(self.dated_events, ["user_id"], "user")

    @cached_property
    def daily_product_features(self) -> DataFrame:
        return features.daily_snapshot(self.dated_events, ["product_id"], "product")

    @cached_property
    def daily_pair_features(self) -> DataFrame:
        return features.daily_snapshot(self.dated_events, ["user_id", "product_id"], "pair")

    @cached_property
    def purchases(self) -> DataFrame:
        return self.events_of("purchase").select(
            "event_id", "user_id", "product_id", F.col("event_time").alias("event_timestamp")
        )

    # --- scoring ------------------------------------------------------------

    @cached_property
    def requests(self) -> DataFrame:
        """Raw scoring requests as strings, some of them broken on purpose."""
        key = F.col("o_orderkey")
        amount = F.col("o_totalprice")
        return self.raw("orders").select(
            key.alias("request_id"),
            F.when(key % 150 == 0, "invalid")
            .otherwise(F.col("o_custkey").cast("string"))
            .alias("user_id"),
            F.when(key % 175 == 0, None)
            .when(key % 100 == 0, (-amount).cast("string"))
            .otherwise(amount.cast("string"))
            .alias("transaction_amount"),
        )

    @cached_property
    def online_users(self) -> DataFrame:
        return features.online_user_features(self.event_log)

    @cached_property
    def predictions(self) -> DataFrame:
        """One row per event: label and the scores of two models."""
        return self.all_events.select(
            "event_id",
            "event_time",
            X.purchase_label().alias("y"),
            (F.pmod(F.col("event_id") * 7919, F.lit(1000)) / 1000).alias("a"),
            (F.col("value") / (F.col("value") + 50)).alias("b"),
            F.col("value").alias("latency_a"),
            (F.col("value") * 1.25).alias("latency_b"),
        )

    MODELS = ["a", "b"]

    @cached_property
    def scored(self) -> DataFrame:
        """Predictions in long form: (event_id, event_time, model, y, score, latency)."""
        return melt_scores(self.predictions, self.MODELS, ["event_id", "event_time", "y"])

    @cached_property
    def repeated_scores(self) -> DataFrame:
        """Every request scored twice; model b is unstable for a few requests."""
        wobble = F.when(
            (F.col("model") == "b") & (F.col("repeat") == 2) & (F.col("event_id") % 1000 == 0), 0.001
        ).otherwise(0.0)
        return (
            self.scored.withColumn("repeat", F.explode(F.array(F.lit(1), F.lit(2))))
            .withColumn("score", F.col("score") + wobble)
            .withColumnRenamed("event_id", "request_id")
        )

    @cached_property
    def on_demand_inputs(self) -> DataFrame:
        """Purchases with the stored features a request-time view needs."""
        users = features.user_stats(self.event_log).select(
            "user_id", "user_total_views", "user_purchase_frequency"
        )
        products = features.product_stats(self.event_log).select(
            "product_id", "product_total_views", "product_view_to_purchase_rate"
        )
        pairs = features.user_product_stats(self.event_log).select(
            "user_id", "product_id", "user_product_view_count"
        )
        requests = self.events_of("purchase").select(
            "event_id",
            "user_id",
            "product_id",
            F.hour("event_time").alias("hour"),
            X.day_of_week("event_time").alias("day_of_week"),
            "price",
        )
        return (
            requests.join(users, "user_id", "left")
            .join(products, "product_id", "left")
            .join(pairs, ["user_id", "product_id"], "left")
        )

    # --- monitoring -----------------------------------------------------------

    ALERT_TYPES = [
        "DATA_DRIFT", "ACCURACY_DROP", "CONCEPT_DRIFT",
        "MISSING_VALUES", "PREDICTION_DRIFT", "VALUE_RANGE",
    ]

    @cached_property
    def alerts(self) -> DataFrame:
        kinds = F.array(*[F.lit(t) for t in self.ALERT_TYPES])
        value = F.col("value")
        return self.all_events.where(F.col("event_type").isin("error", "signup")).select(
            F.col("event_id").alias("alert_id"),
            F.col("event_time").alias("alert_time"),
            F.when(value > 100, "CRITICAL").when(value > 20, "WARNING").otherwise("INFO").alias("level"),
            F.element_at(kinds, (F.pmod(F.col("k"), F.lit(6)) + 1).cast("int")).alias("type"),
            F.concat(F.lit("value "), value.cast("string")).alias("message"),
            F.when(F.col("event_type") == "error", "value").alias("metric"),
            value.alias("value"),
            F.lit(20.0).alias("threshold"),
            F.create_map(F.lit("user_id"), F.col("user_id").cast("string")).alias("context"),
        )

    @cached_property
    def failed_requests(self) -> DataFrame:
        """Error events as failed requests with a message and a status code."""
        k = F.col("k")
        return self.all_events.where(F.col("event_type") == "error").select(
            F.col("event_id").alias("request_id"),
            F.when(k % 5 == 0, "Read Timeout after 10s")
            .when(k % 5 == 1, "Connection refused")
            .otherwise("request failed")
            .alias("message"),
            F.when(k % 5 == 2, 503).when(k % 5 == 3, 422).otherwise(None).cast("int").alias("status"),
        )

    @cached_property
    def runs(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("run_id"),
            F.col("p_brand").alias("experiment"),
            F.col("p_retailprice").alias("metric"),
        )

    @cached_property
    def model_versions(self) -> DataFrame:
        """Version history per model: the orders of a customer play the versions."""
        return self.raw("orders").select(
            F.col("o_custkey").alias("model_id"),
            F.col("o_orderkey").alias("version"),
            F.col("o_orderdate").cast("timestamp").alias("created_at"),
            F.when(F.col("o_orderstatus") == "P", "Production")
            .when(F.col("o_orderstatus") == "F", "Archived")
            .otherwise("None")
            .alias("stage"),
        )

    @cached_property
    def retrain_checks(self) -> DataFrame:
        """One check per day: drift and accuracy drop against the whole period."""
        overall = self.event_log.agg(
            F.struct(
                F.avg("price").alias("price"),
                F.avg(X.purchase_label()).alias("share"),
                F.min("event_time").alias("first"),
            )
        ).scalar()
        day = F.col("event_date")
        return (
            self.dated_events.groupBy("event_date")
            .agg(
                F.avg("price").alias("day_price"),
                F.avg(X.purchase_label()).alias("day_share"),
                F.count(F.lit(1)).alias("new_rows"),
            )
            .withColumn("all", overall)
            .select(
                F.date_format(day, "yyyy-MM-dd").alias("check_id"),
                F.date_add(day, 1).cast("timestamp").alias("as_of"),
                (F.abs(F.col("day_price") / F.col("all.price") - 1) * 3).alias("drift_score"),
                ((F.col("all.share") - F.col("day_share")) * 3).alias("accuracy_drop"),
                "new_rows",
                F.when(F.dayofmonth(day) > 5, F.date_sub(F.to_date("all.first"), 20).cast("timestamp"))
                .alias("model_created_at"),
                F.when(
                    F.dayofmonth(day) >= 10,
                    (F.floor(F.dayofmonth(day) / 10) * 10 - 1).cast("int"),
                ).alias("_offset"),
                F.col("all.first").alias("_first"),
            )
            .withColumn(
                "last_retrain_at",
                F.date_add(F.to_date("_first"), F.col("_offset")).cast("timestamp"),
            )
            .drop("_offset", "_first")
        )

    @cached_property
    def demand_set(self) -> DataFrame:
        return features.demand_dataset(self.dated_events)

    @cached_property
    def demand_predictions(self) -> DataFrame:
        return self.demand_set.select(
            "target_date",
            "product_id",
            F.col("demand").cast("double").alias("y"),
            (F.col("views") * 0.5).alias("p"),
        )
