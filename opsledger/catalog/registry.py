"""Registered queries: a Spark callable per name and, where SQL can say it, the same query as SQL text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The given parquet tables below one folder."""

    NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
             "embeddings", "pages", "benchmark", "labels", "conversations")

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name not in self.NAMES:
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))


def query(name: str, sql: str | None = None):
    def keep(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            SQL[name] = sql
        return fn
    return keep


def money_out(col) -> Column:
    """Exact money as double for comparison, four decimals."""
    return (F.col(col) if isinstance(col, str) else col).cast("decimal(20,4)").cast("double")


def with_money(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: money_out(n) for n in names})


def sql_money(expression: str) -> str:
    return f"CAST(CAST({expression} AS DECIMAL(20,4)) AS DOUBLE)"
