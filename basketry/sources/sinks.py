"""Sinks: processed events, feature groups with a manifest, snapshots, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_processed(df: DataFrame, path: str) -> None:
    """Snappy parquet, one directory per event date so date filters prune.

    The rebalance hint gathers the rows of a date before writing, so a task does
    not open a file per date; AQE splits a date with very many rows over several
    tasks and joins small ones.
    """
    (
        df.withColumn("event_date", F.to_date("event_time"))
        .hint("rebalance", "event_date")
        .write.partitionBy("event_date")
        .option("compression", "snappy")
        .mode("errorifexists")
        .parquet(path)
    )


def write_feature_groups(groups: dict[str, DataFrame], path: str, run_ts: Column) -> DataFrame:
    """Write every feature group and return the manifest (also written as JSON).

    Row counts come from the written files, so nothing is computed twice.
    """
    spark = next(iter(groups.values())).sparkSession
    manifest = None
    for name, df in groups.items():
        target = f"{path}/{name}"
        df.write.mode("errorifexists").parquet(target)
        entry = (
            spark.read.schema(df.schema)
            .parquet(target)
            .agg(F.count(F.lit(1)).alias("row_count"))
            .select(
                F.lit(name).alias("feature_group"),
                "row_count",
                F.concat_ws(",", *[F.lit(c) for c in df.columns]).alias("columns"),
                run_ts.alias("prepared_at"),
            )
        )
        manifest = entry if manifest is None else manifest.unionByName(entry)
    manifest.write.mode("errorifexists").json(f"{path}/manifest")
    return spark.read.schema(manifest.schema).json(f"{path}/manifest")


def snapshot_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS"))


def reference_snapshot(current: DataFrame, path: str) -> DataFrame:
    """The drift reference: the first table ever saved under ``path``.

    A folder without its success marker is an interrupted write and is replaced.
    """
    spark = current.sparkSession
    if not snapshot_exists(spark, path):
        current.write.mode("overwrite").parquet(path)
    return spark.read.schema(current.schema).parquet(path)


def write_json_report(report: DataFrame, path: str) -> DataFrame:
    """One-row nested report as JSON; returned as read back."""
    report.write.mode("errorifexists").json(path)
    return report.sparkSession.read.schema(report.schema).json(path)


def write_leaderboard(board: DataFrame, path: str) -> DataFrame:
    """A leaderboard has one row per model, so one CSV and one JSON file each."""
    board.coalesce(1).write.mode("errorifexists").option("header", True).csv(f"{path}/csv")
    board.coalesce(1).write.mode("errorifexists").json(f"{path}/json")
    return (
        board.sparkSession.read.schema(board.schema).option("header", True).csv(f"{path}/csv")
    )
