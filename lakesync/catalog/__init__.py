"""Runnable queries, one per operator, over the driver's tables.

Each module registers queries with the DuckDB SQL that must give the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesync.operators.windows import instant_micros
from lakesync.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The tables of one folder, read on first use: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = configure(spark), folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def only(self, name: str, *columns: str) -> DataFrame:
        """Some columns of a table, or all."""
        return getattr(self, name).select(*columns or "*")


def query(name: str, sql: str | None = None):
    """Register a function of ``Tables`` under ``name``, with its expected result as SQL."""

    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: shown(build(Tables(spark, folder)))
        if sql:
            ORACLES[name] = sql
        return build

    return register


def shown(df: DataFrame) -> DataFrame:
    """Engine-neutral output: instants as epoch microseconds, decimals as text."""
    columns = []
    for f in df.schema.fields:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = instant_micros(column).alias(f.name)
        elif isinstance(f.dataType, T.DecimalType):
            column = column.cast("string").alias(f.name)
        columns.append(column)
    return df.select(*columns)


def load() -> None:
    """Import every module that registers queries."""
    from lakesync.catalog import changes, jobs, mapped, scalars, sources, stored  # noqa: F401
