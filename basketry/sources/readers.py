"""Typed scans: parquet, CSV with a declared schema, file streams, limits and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expressions import id_bucket
from ..operators.selection import take_share


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, columns: list[str] | None = None
) -> DataFrame:
    """CSV with a header and a declared schema (no inference pass over the file).

    A broken line is an error; ``quarantine.read_csv_apart`` goes on and keeps it apart.
    """
    df = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )
    return df.select(*columns) if columns else df


def first_rows(df: DataFrame, n_rows: int = 100_000, order=("event_time", "event_id")) -> DataFrame:
    """First rows in a stated order; planned as a per-partition top-n."""
    return df.orderBy(*order).limit(n_rows)


def stable_sample(df: DataFrame, fraction: float = 0.05, id_col: str = "event_id") -> DataFrame:
    """Rows whose id hashes below the fraction: same rows on every recomputation."""
    return df.where(id_bucket(id_col, 10_000) < int(fraction * 10_000))


def exact_sample(df: DataFrame, fraction: float = 0.05, id_col: str = "event_id") -> DataFrame:
    """floor(fraction x rows) rows, those with the smallest id hashes: two small counts, then a filter."""
    return take_share(df, id_col, fraction)


def incremental_read(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    file_format: str = "parquet",
    bytes_per_trigger: int = 1 << 30,
    options: dict[str, object] | None = None,
) -> DataFrame:
    """A file or a folder of files as a stream, in micro-batches of about ``bytes_per_trigger``.

    The size of a batch follows the volume, not the number of files.  CSV files
    are read with ``options`` such as ``header``.
    """
    reader = spark.readStream.schema(schema).option("maxBytesPerTrigger", bytes_per_trigger)
    for name, value in (options or {}).items():
        reader = reader.option(name, value)
    # A pattern that matches this one name: without one, a stream takes folders only.
    name = path.rstrip("/")
    return reader.format(file_format).load(f"{name[:-1]}[{name[-1]}]")
