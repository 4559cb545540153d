"""Structured Streaming jobs over the event log.

Jobs whose result must hold every event are built from additive parts: each
micro-batch writes its own counts into the shared folder, where they are merged
level by level (``parts.Parts``), and the current result is an aggregate of what
is left.  It does not depend on the order or the lateness of events, a repeated
batch changes nothing, and no state is kept in executors.

Jobs that must emit while the stream runs (closed windows, pairs of scores) keep
state and take the allowed lateness as an argument; ``collect_batches`` raises if
any row was dropped as too late, unless the caller allows it.
"""

from __future__ import annotations

import threading
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from ..operators import alerts, decisions, drift
from ..operators.features import count_type
from ..session import new_path
from ..sources import quarantine
from ..sources.readers import incremental_read
from .parts import Parts

LATENESS = "10 minutes"
WINDOW = "5 minutes"


def event_stream(spark: SparkSession, sf_dir: str, bytes_per_trigger: int = 1 << 30) -> DataFrame:
    """The event table, a file or a folder of files, as a stream; time cast so that it can be a watermark."""
    path = f"{sf_dir.rstrip('/')}/events.parquet"
    return typed_events(
        incremental_read(spark, path, spark.read.parquet(path).schema, bytes_per_trigger=bytes_per_trigger)
    )


def typed_events(raw: DataFrame) -> DataFrame:
    return raw.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("event_time"),
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("long").alias("k"),
    )


# --- sinks ------------------------------------------------------------------------

def run_batches(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    name: str,
    mode: str = "append",
    interval: str | None = None,
    checkpoint: str | None = None,
):
    """Start ``write`` per micro-batch.  Without an interval: process what is there and stop.

    With a ``checkpoint`` of an earlier run the stream goes on where that run ended.
    """
    writer = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint or new_path(stream.sparkSession, f"{name}-checkpoint"))
    )
    if interval:
        return writer.trigger(processingTime=interval).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def _batch_files(path: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(
            f"{path}/batch={batch_id}"
        )

    return write


def latest_update(updates: DataFrame, keys: list[str]) -> DataFrame:
    """Newest version of every key written by an update-mode query."""
    others = [c for c in updates.columns if c not in (*keys, "batch_id")]
    return (
        updates.groupBy(*keys)
        .agg(F.max_by(F.struct(*others), "batch_id").alias("_row"))
        .select(*keys, "_row.*")
    )


class LateRows(RuntimeError):
    """A stateful job dropped rows that came after the allowed lateness."""


class DroppedRows(StreamingQueryListener):
    """Rows that stateful operators leave out as too late, summed over every batch of each run of a query.

    A query keeps the progress of its last hundred batches only; this is told of all of them.
    """

    def __init__(self):
        self.rows: dict[str, int] = {}
        self.ended: dict[str, threading.Event] = {}

    def _end(self, run: str) -> threading.Event:
        return self.ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        run = str(event.progress.runId)
        late = sum(int(state.numRowsDroppedByWatermark) for state in event.progress.stateOperators)
        self.rows[run] = self.rows.get(run, 0) + late

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def of(self, query, timeout: float = 120.0) -> int:
        """The sum for a query that has ended; its last event follows all of its progress."""
        run = str(query.runId)
        if not self._end(run).wait(timeout):
            raise TimeoutError(f"no end of stream {run} was reported within {timeout} seconds")
        return self.rows.pop(run, 0)


def collect_batches(stream: DataFrame, name: str, mode: str = "append", allow_late: bool = False) -> DataFrame:
    """Run to completion and read back what all micro-batches wrote."""
    spark = stream.sparkSession
    path = new_path(spark, name)
    dropped = DroppedRows()
    spark.streams.addListener(dropped)
    try:
        late = dropped.of(run_batches(stream, _batch_files(path), name, mode))
    finally:
        spark.streams.removeListener(dropped)
    if late and not allow_late:
        raise LateRows(f"{name}: {late} rows came later than the allowed lateness")
    schema = stream.withColumn("batch_id", F.lit(0).cast("long")).schema
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(path)


def collect_parts(stream: DataFrame, part: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """Run to completion; ``part`` of every micro-batch, one below the other."""
    spark = stream.sparkSession
    path = new_path(spark, name)

    def write(batch: DataFrame, batch_id: int) -> None:
        part(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    run_batches(stream, write, name)
    schema = part(spark.createDataFrame([], stream.schema)).schema
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(path)


def csv_stream_apart(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    required: list[str] = (),
    bytes_per_trigger: int = 1 << 30,
    header: bool = True,
    folder: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(good rows, broken lines) of CSV files read as a stream; a repeated batch replaces its own output."""
    how = quarantine.csv_options(header)
    raw = incremental_read(spark, path, quarantine.with_line(schema), "csv", bytes_per_trigger, how)
    lines = quarantine.tagged(raw, schema, required, how)
    folder = folder or new_path(spark, "csv-stream-apart")
    run_batches(
        lines,
        lambda batch, number: quarantine.write_sides(batch, f"{folder}/data/batch={number}"),
        "csv-apart",
        checkpoint=f"{folder}/checkpoint",
    )
    return quarantine.read_sides(spark, f"{folder}/data", schema)


def merged_parts(
    stream: DataFrame,
    part: Callable[[DataFrame], DataFrame],
    merge: Callable[[DataFrame], DataFrame],
    name: str,
    folder: str | None = None,
    fanout: int = 8,
) -> DataFrame:
    """Run to completion; the merged parts of every micro-batch so far.

    ``part`` reduces a batch, ``merge`` the rows of several parts to those of one.
    With a ``folder`` a later call goes on after the files that are already in it,
    also when a run was broken off between any two steps.
    """
    spark = stream.sparkSession
    folder = folder or new_path(spark, name)
    schema = part(spark.createDataFrame([], stream.schema)).schema
    parts = Parts(spark, f"{folder}/parts", schema, merge, fanout)
    run_batches(stream, lambda batch, number: parts.add(part(batch), number), name, checkpoint=f"{folder}/checkpoint")
    return parts.current()


# --- jobs ---------------------------------------------------------------------------

def inference_parts(requests: DataFrame) -> DataFrame:
    """Requests and errors by window, model and latency: additive, whatever the batches."""
    return requests.groupBy(F.window("event_time", WINDOW)["start"].alias("window_start"), "model", "latency").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("is_error") == 1).alias("errors")
    )


def merge_inference(parts: DataFrame) -> DataFrame:
    return parts.groupBy("window_start", "model", "latency").agg(F.sum("n").alias("n"), F.sum("errors").alias("errors"))


SKETCH_SIZE = 4096


def sketch_parts(requests: DataFrame) -> DataFrame:
    """One row per window and model, with a quantile sketch of the latencies: bounded, however many requests.

    A sketch holds a window of up to ``SKETCH_SIZE`` latencies exactly and a larger
    one in at most about three times as many values; the rank of its quantiles is
    then off by less than 0.3 % of the window.
    """
    known = F.col("latency").cast("double")
    return requests.groupBy(F.window("event_time", WINDOW)["start"].alias("window_start"), "model").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(known).alias("known"),
        F.sum(known).alias("total"),
        F.sum(known * known).alias("squares"),
        F.count_if(F.col("is_error") == 1).alias("errors"),
        F.kll_sketch_agg_double(known, SKETCH_SIZE).alias("sketch"),
    )


def merge_sketches(parts: DataFrame) -> DataFrame:
    return parts.groupBy("window_start", "model").agg(
        *[F.sum(c).alias(c) for c in ("n", "known", "total", "squares", "errors")],
        F.kll_merge_agg_double("sketch", SKETCH_SIZE).alias("sketch"),
    )


def sketched_inference(merged: DataFrame) -> DataFrame:
    """The figures of ``current_inference`` from merged sketches; a window without any latency has null ones."""
    mean = F.try_divide(F.col("total"), F.col("known"))
    variance = F.greatest(F.col("squares") / F.col("known") - mean * mean, F.lit(0.0))
    return merged.select(
        "window_start",
        "model",
        F.col("n").alias("requests"),
        mean.alias("latency_mean"),
        F.when(F.col("known") > 0, F.sqrt(variance)).alias("latency_std"),
        F.when(F.col("known") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(0.95))).alias("latency_p95"),
        (F.col("n") / 300.0).alias("requests_per_second"),
        (F.col("errors") / F.col("n")).alias("error_rate"),
    )


def newest_requests(requests: DataFrame, n: int = 1000) -> DataFrame:
    """The newest ``n`` requests of every model, ties to the larger id; merging it again changes nothing.

    The rows are cut inside each task before the shuffle, so that a model with most
    of the requests sends ``n`` rows from each task.
    """
    newest = Window.partitionBy("model").orderBy(F.desc("event_time"), F.desc("request_id"))
    return requests.withColumn("_place", F.row_number().over(newest)).where(F.col("_place") <= n).drop("_place")


def last_requests(stream: DataFrame, n: int = 1000, name: str = "newest", folder: str | None = None) -> DataFrame:
    """Figures of the last ``n`` requests of each model; what is kept is bounded by n, models and levels."""
    cut = lambda df: newest_requests(df, n)
    return window_metrics(merged_parts(stream, cut, cut, name, folder), n)


def window_metrics(kept: DataFrame, n: int) -> DataFrame:
    """Latency, throughput and errors of a window of ``n`` requests (errors per capacity, as a full window has)."""
    seconds = (F.unix_micros(F.max("event_time")) - F.unix_micros(F.min("event_time"))) / 1e6
    quantile = lambda q: F.percentile("latency", F.lit(q))
    return kept.groupBy("model").agg(
        F.count(F.lit(1)).alias("total_requests"),
        quantile(0.5).alias("latency_p50"),
        quantile(0.95).alias("latency_p95"),
        quantile(0.99).alias("latency_p99"),
        F.avg("latency").alias("latency_mean"),
        F.stddev_pop("latency").alias("latency_std"),
        F.min("latency").alias("latency_min"),
        F.max("latency").alias("latency_max"),
        F.coalesce(F.when(seconds > 0, F.count(F.lit(1)) / seconds), F.lit(0.0)).alias("requests_per_second"),
        (F.count_if(F.col("is_error") == 1) / F.lit(float(n))).alias("error_rate"),
    )


def current_inference(parts: DataFrame) -> DataFrame:
    """Latency, throughput and error share per model and five-minute window, from all parts so far."""
    keys = ["window_start", "model"]
    counts = parts.groupBy(*keys, "latency").agg(F.sum("n").alias("n"), F.sum("errors").alias("errors"))
    of_window = Window.partitionBy(*keys)
    size = F.sum(F.when(F.col("latency").isNotNull(), F.col("n"))).over(of_window)
    mean = F.sum(F.col("latency") * F.col("n")).over(of_window) / size
    upto = F.sum("n").over(of_window.orderBy(F.col("latency").asc_nulls_last()))
    placed = counts.withColumns({"size": size, "mean": mean, "upto": upto})
    gap = F.col("latency") - F.col("mean")
    return (
        placed.groupBy(*keys)
        .agg(
            F.sum("n").alias("requests"),
            F.max("mean").alias("latency_mean"),
            F.sqrt(F.sum(F.col("n") * gap * gap) / F.max("size")).alias("latency_std"),
            F.min(F.when(F.col("upto") >= F.ceil(0.95 * F.col("size")), F.col("latency"))).alias("latency_p95"),
            F.sum("errors").alias("errors"),
        )
        .withColumn("requests_per_second", F.col("requests") / 300.0)
        .withColumn("error_rate", F.col("errors") / F.col("requests"))
        .drop("errors")
    )


def inference_metrics(stream: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """The same figures from kept state, for windows to be emitted while the stream runs."""
    return (
        stream.withWatermark("event_time", lateness)
        .groupBy(F.window("event_time", WINDOW).alias("window"), "model")
        .agg(
            F.count(F.lit(1)).alias("requests"),
            F.avg("latency").alias("latency_mean"),
            F.stddev_pop("latency").alias("latency_std"),
            F.percentile_approx("latency", 0.95, 10_000).alias("latency_p95"),
            F.count_if(F.col("is_error") == 1).alias("errors"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            "model",
            "requests",
            "latency_mean",
            "latency_std",
            "latency_p95",
            (F.col("requests") / 300.0).alias("requests_per_second"),
            (F.col("errors") / F.col("requests")).alias("error_rate"),
        )
    )


def request_stream(events: DataFrame) -> DataFrame:
    """Every event as a request answered by two models."""
    cells = F.array(
        F.struct(F.lit("a").alias("model"), F.col("value").alias("latency")),
        F.struct(F.lit("b").alias("model"), (F.col("value") * 1.25).alias("latency")),
    )
    return events.select(
        F.col("event_id").alias("request_id"),
        "event_time",
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("is_error"),
        F.inline(cells),
    )


def user_activity(stream: DataFrame, threshold: int = 3, name: str = "activity", folder: str | None = None) -> DataFrame:
    """Event count and last activity per user, with the cold flag; no state is kept between batches."""

    def part(batch: DataFrame) -> DataFrame:
        return batch.groupBy("user_id").agg(
            F.count(F.lit(1)).alias("event_count"), F.max("event_time").alias("last_seen")
        )

    def merge(parts: DataFrame) -> DataFrame:
        return parts.groupBy("user_id").agg(
            F.sum("event_count").alias("event_count"), F.max("last_seen").alias("last_seen")
        )

    return merged_parts(stream, part, merge, name, folder).withColumn(
        "is_cold", F.when(F.col("event_count") < threshold, 1).otherwise(0)
    )


def score_stream(events: DataFrame, model: str) -> DataFrame:
    """(request_id, event_time, score) of one of the two models."""
    score = {
        "production": F.pmod(F.col("event_id") * 7919, F.lit(1000)) / 1000,
        "shadow": F.col("value") / (F.col("value") + 50),
    }[model]
    return events.select(F.col("event_id").alias("request_id"), "event_time", score.alias("score"))


def pair_scores(production: DataFrame, shadow: DataFrame) -> DataFrame:
    """Both models' scores of each request compared: every pair, whenever its halves arrived.

    The streams write their scores as they come; the pairs are a join of what was written.
    """
    left = collect_batches(production, "production-scores").select(
        "request_id", "event_time", F.col("score").alias("production_score")
    )
    right = collect_batches(shadow, "shadow-scores").select("request_id", F.col("score").alias("shadow_score"))
    return decisions.compare_scores(left.join(right, "request_id"), "production_score", "shadow_score")


def shadow_compare(production: DataFrame, shadow: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """The same comparison as a stream: pairs are emitted as soon as both halves are there.

    The time condition lets both sides forget requests that can no longer match.
    """
    left = production.withWatermark("event_time", lateness).select(
        "request_id", "event_time", F.col("score").alias("production_score")
    )
    right = shadow.withWatermark("event_time", lateness).select(
        F.col("request_id").alias("shadow_request_id"),
        F.col("event_time").alias("shadow_time"),
        F.col("score").alias("shadow_score"),
    )
    near = F.expr(
        "shadow_request_id = request_id"
        " AND shadow_time BETWEEN event_time - INTERVAL 5 MINUTES AND event_time + INTERVAL 5 MINUTES"
    )
    joined = left.join(right, near, "inner").select(
        "request_id", "event_time", "production_score", "shadow_score"
    )
    return decisions.compare_scores(joined, "production_score", "shadow_score")


def drift_monitor(stream: DataFrame, reference: DataFrame, columns: list[str], name: str = "drift") -> DataFrame:
    """Drift summary of every event-time day against the reference (columns and ``event_time`` in the stream).

    Batches write counts by day, column and value; the reference is counted once.
    A day's figures do not depend on how its events were dealt to batches.
    """

    def part(batch: DataFrame) -> DataFrame:
        return drift.value_counts_by(batch.withColumn("day", F.to_date("event_time")), columns, ["day"])

    def merge(parts: DataFrame) -> DataFrame:
        return parts.groupBy("day", "column", "value").agg(F.sum("n").alias("n"))

    current = merged_parts(stream, part, merge, name)
    return drift.daily_summary(drift.value_counts_by(reference, columns, []), current, len(columns))


def drift_alerts(daily: DataFrame) -> DataFrame:
    """The data alerts of every day of ``drift_monitor``."""
    return alerts.data_alerts(daily)


def feature_update(stream: DataFrame, name: str = "features", folder: str | None = None) -> DataFrame:
    """Keep per-user counts current: one additive part per micro-batch, merged by level."""

    def part(batch: DataFrame) -> DataFrame:
        return batch.groupBy("user_id").agg(
            F.count(F.lit(1)).alias("total_events"),
            count_type("view").alias("total_views"),
            count_type("click").alias("total_carts"),
            count_type("purchase").alias("total_purchases"),
            F.max("event_time").alias("event_timestamp"),
        )

    return merged_parts(stream, part, current_features, name, folder)


def current_features(parts: DataFrame) -> DataFrame:
    counts = [c for c in parts.columns if c.startswith("total_")]
    return parts.groupBy("user_id").agg(
        F.max("event_timestamp").alias("event_timestamp"), *[F.sum(c).alias(c) for c in counts]
    )
