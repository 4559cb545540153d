"""CSV input with broken lines: every line ends in one of two tables, none is lost or half read.

A line is broken if it has another number of fields than the schema, holds a value
that is not of its column's type, or lacks a value that the caller requires.  Broken
lines are kept as they came, with the file and the reason.  Both sides are written
in one pass over the input, for tables and for the batches of a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import new_path

LINE = "_line"
FIELDS = "wrong number of fields"


def csv_options(header: bool = True, **more) -> dict[str, object]:
    """Reader options under which a broken line is kept beside what could be read of it; quotes are doubled."""
    kept = {"enforceSchema": True, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": LINE}
    return {"header": header, "quote": '"', "escape": '"', **more, **kept}


def with_line(schema: T.StructType) -> T.StructType:
    if LINE in schema.names:
        raise ValueError(f"a column must not be named {LINE}")
    return T.StructType([*schema.fields, T.StructField(LINE, T.StringType())])


def _texts(options: dict[str, object]) -> dict[str, str]:
    """Reader options as those of the functions for single lines, which know no header."""
    return {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in options.items() if k != "header"}


def _reason(schema: T.StructType, required: list[str], options: dict[str, object]) -> Column:
    """Why a line is broken; null for a good one.  The first fault in the order of the columns counts."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields] + [T.StructField(LINE, T.StringType())])
    columns = ", ".join(f"`{f.name}` string" for f in text.fields)
    fields = F.from_csv(LINE, columns, _texts(options))
    unreadable = F.coalesce(
        *[
            F.when(
                fields[f.name].isNotNull() & F.col(f"`{f.name}`").isNull(),
                f"{f.name}: not of type {f.dataType.simpleString()}",
            )
            for f in schema.fields
            if not isinstance(f.dataType, T.StringType)
        ],
        F.lit("unreadable"),
    )
    missing = F.coalesce(
        *[F.when(F.col(f"`{c}`").isNull(), f"{c}: missing") for c in required], F.lit(None).cast("string")
    )
    return F.when(F.col(LINE).isNull(), missing).when(fields[LINE].isNotNull(), FIELDS).otherwise(unreadable)


def tagged(raw: DataFrame, schema: T.StructType, required: list[str] = (), options: dict[str, object] | None = None) -> DataFrame:
    """The columns of ``schema`` with ``_line``, ``_file`` and ``_reason``; ``raw`` is read with ``with_line(schema)``.

    A line that lacks a required value was read without a fault: its line is
    put together again from its values.
    """
    columns = [F.col(f"`{c}`") for c in schema.names]
    options = options or csv_options()
    reason = _reason(schema, list(required), options)
    again = F.to_csv(F.struct(*columns), _texts(options))
    return raw.select(
        *columns,
        F.when(reason.isNotNull(), F.coalesce(F.col(LINE), again)).alias(LINE),
        F.col("_metadata.file_path").alias("_file"),
        reason.alias("_reason"),
    )


def write_sides(lines: DataFrame, folder: str) -> None:
    """Good and broken lines apart, in one pass.  Written again, a folder holds the same."""
    broken = F.col("_reason").isNotNull()
    lines.withColumn("broken", broken).write.mode("overwrite").partitionBy("broken").parquet(folder)


def read_sides(spark: SparkSession, folder: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(good rows with the columns of ``schema``, broken lines as line, file, reason)."""
    whole = T.StructType(
        [*schema.fields, *[T.StructField(c, T.StringType()) for c in (LINE, "_file", "_reason")], T.StructField("broken", T.BooleanType())]
    )
    written = spark.read.schema(whole).parquet(folder)
    good = written.where(~F.col("broken")).select(*[F.col(f"`{c}`") for c in schema.names])
    bad = written.where("broken").select(
        F.col(LINE).alias("line"), F.col("_file").alias("file"), F.col("_reason").alias("reason")
    )
    return good, bad


def read_csv_apart(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    required: list[str] = (),
    header: bool = True,
    folder: str | None = None,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """(good rows, broken lines) of CSV files; empty files give two empty tables."""
    how = csv_options(header, **options)
    raw = spark.read.schema(with_line(schema)).options(**how).csv(path)
    folder = folder or new_path(spark, "csv-apart")
    write_sides(tagged(raw, schema, required, how), folder)
    return read_sides(spark, folder, schema)
