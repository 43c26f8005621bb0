"""Files in other formats, with schemas given rather than inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def write(df: DataFrame, path: str, kind: str, partition_by: tuple[str, ...] = (), **options) -> None:
    df.write.format(kind).options(**options).partitionBy(*partition_by).mode("overwrite").save(path)


def read(spark: SparkSession, path: str, kind: str, schema: StructType | str | None = None, **options) -> DataFrame:
    reader = spark.read.format(kind).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)
