"""A registry: each query stands beside the SQL it is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import table

Plan = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Plan] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """t.orders is the table orders of a folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    def sql(self, text: str) -> DataFrame:
        """Spark SQL in which {orders} stands for the table orders."""
        names = {w.split("}")[0] for w in text.split("{")[1:]}
        return self.spark.sql(text, **{n: getattr(self, n) for n in names})


def query(sql: str | None = None, name: str | None = None):
    """Register f(tables) under its name, with SQL for DuckDB."""

    def add(f):
        key = name or f.__name__
        QUERIES[key] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            ORACLES[key] = sql
        return f

    return add


def same_sql(name: str, text: str, oracle: str | None = None) -> None:
    """Register a query that both engines run from the same SQL text, or nearly."""
    plain = text.replace("{", "").replace("}", "")
    query(oracle or plain, name)(lambda t: t.sql(text))
