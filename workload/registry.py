"""Registered queries: name -> Spark callable, and where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6, only=None) -> DataFrame:
    """Round every double column, so that sums taken in another order compare equal."""
    return df.select(*[
        F.round(F.col(f"`{f.name}`"), digits).alias(f.name)
        if f.dataType.typeName() == "double" and (only is None or f.name in only) else F.col(f"`{f.name}`")
        for f in df.schema.fields])


def r(c: Column, digits: int = 6) -> Column:
    return F.round(c, digits)
