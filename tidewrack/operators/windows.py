"""Window forms that Spark's SQL lacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def over_groups(df: DataFrame, keys: list[str], order: str, preceding: int, following: int, measure: Column, alias: str) -> DataFrame:
    """GROUPS BETWEEN preceding PRECEDING AND following FOLLOWING: frames counted in peer groups, as a RANGE over dense ranks."""
    df = df.withColumn("_group", F.dense_rank().over(Window.partitionBy(*keys).orderBy(order)))
    frame = Window.partitionBy(*keys).orderBy("_group").rangeBetween(-preceding, following)
    return df.withColumn(alias, measure.over(frame)).drop("_group")


def qualify(df: DataFrame, window: Column, condition) -> DataFrame:
    """Rows for which condition(window value) holds."""
    return df.withColumn("_value", window).where(condition(F.col("_value"))).drop("_value")


def sessions(df: DataFrame, keys: list[str], time: str, gap: str) -> DataFrame:
    """df with `session`, numbered from 1 per key: a new one after each pause longer than `gap` (an interval)."""
    w = Window.partitionBy(*keys).orderBy(time)
    opens = F.col(time) > F.lag(time).over(w) + F.expr(f"INTERVAL {gap}")
    df = df.withColumn("_opens", F.coalesce(opens.cast("int"), F.lit(1)))
    return df.withColumn("session", F.sum("_opens").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_opens")
