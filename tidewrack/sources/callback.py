"""A data source whose partitions are made by a Python callback."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition



def register(spark: SparkSession, name: str, schema: str, parts: int, make) -> None:
    """After this spark.read.format(name).load() has a partition for each i < parts: the Arrow batch make(i)."""

    class Part(InputPartition):
        def __init__(self, i: int):
            self.i = i

    class Reader(DataSourceReader):
        def partitions(self):
            return [Part(i) for i in range(parts)]

        def read(self, partition):
            yield make(partition.i)

    class Source(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return schema

        def reader(self, schema):
            return Reader()

    spark.dataSource.register(Source)


def numbers(spark: SparkSession, n: int, parts: int = 4) -> DataFrame:
    """0 to n - 1 and their squares, made in the tasks."""

    def make(i: int) -> pa.RecordBatch:
        own = range(i * n // parts, (i + 1) * n // parts)
        return pa.RecordBatch.from_pydict({"i": pa.array(own, pa.int64()), "square": pa.array([x * x for x in own], pa.int64())})

    register(spark, "tidewrack_numbers", "i long, square long", parts, make)
    return spark.read.format("tidewrack_numbers").load()
