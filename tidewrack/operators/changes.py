"""UPDATE, DELETE and MERGE as new versions of a DataFrame; write the result beside the old one and swap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def update_where(df: DataFrame, condition: Column, **values: Column) -> DataFrame:
    """Rows for which condition is true get the values; others, and those where it is null, stay."""
    return df.select(*[F.when(condition, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in df.columns])


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which condition is true go; those where it is null stay."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def merge(df: DataFrame, changes: DataFrame, key: str, deleted: str = "deleted") -> DataFrame:
    """Upserts and, where `deleted`, deletes: changes win over df's rows.  Several changes of one key are an error."""
    changes = changes.withColumn("_changes", F.count("*").over(Window.partitionBy(key)))
    changes = changes.where(F.assert_true(F.col("_changes") == 1, "a key has several changes").isNull()).drop("_changes")
    kept = df.join(changes.select(key), key, "left_anti")
    return kept.unionByName(changes.where(~F.col(deleted)).select(*df.columns))
