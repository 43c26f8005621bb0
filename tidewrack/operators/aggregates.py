"""Aggregation against skew."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_counts(df: DataFrame, keys: list[str], value: str, alias: str) -> DataFrame:
    """Exact count of distinct values per key in two steps, so that a hot key's values spread over all tasks."""
    return df.select(*keys, value).distinct().groupBy(*keys).agg(F.count(value).alias(alias))


def salted(df: DataFrame, keys: list[str], partial: dict[str, Column], final: dict[str, Column], salts: int = 16) -> DataFrame:
    """Aggregates without a map-side half (lists, for one) in two steps: by key and salt, then by key."""
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(salts))
    halves = df.groupBy(*keys, salt.alias("_salt")).agg(*[c.alias(n) for n, c in partial.items()])
    return halves.groupBy(*keys).agg(*[c.alias(n) for n, c in final.items()])
