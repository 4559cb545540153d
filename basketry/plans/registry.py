"""Registry of the named queries and of the SQL each one is checked against."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import tune
from ..sources.tables import Tables
from .views_sql import COMMON

DIGITS = 6
# Means of cent prices are often exact halves of the last digit kept; the two
# engines sum in different orders and would round such a value either way.  The
# same small shift on both sides moves those values off the boundary.
SHIFT = "1e-10"


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    oracle: str | None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        tune(spark)
        return rounded(self.build(Tables(spark, sf_dir)))


CATALOG: dict[str, Query] = {}


def query(name: str, oracle: str | None = None):
    """Register a query; ``oracle`` may use every view of ``views_sql.COMMON``."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in CATALOG:
            raise ValueError(f"query {name} is registered twice")
        sql = None
        if oracle:
            body = oracle.strip().replace(f", {DIGITS})", f" + {SHIFT}, {DIGITS})")
            sql = f"WITH {COMMON}\nSELECT * FROM (\n{body}\n)"
        CATALOG[name] = Query(name, build, sql)
        return build

    return register


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six digits (and no negative zero), the form both engines agree on."""
    return df.select(
        *[
            (F.round(F.col(f"`{f.name}`") + float(SHIFT), DIGITS) + F.lit(0.0)).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
