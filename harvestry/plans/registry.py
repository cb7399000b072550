"""Registered queries: each reads the given tables, most with the SQL they must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under its own name."""
    def add(plan):
        QUERIES[plan.__name__] = plan
        if sql:
            ORACLE_SQL[plan.__name__] = sql
        return plan
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def to6(*names: str) -> list[Column]:
    """Doubles rounded for comparison: their sums depend on the order of addition."""
    return [F.round(name, 6).alias(name) for name in names]


def stamp(moment: Column | str) -> Column:
    """Seconds as text."""
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")
