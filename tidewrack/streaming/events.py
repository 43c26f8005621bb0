"""Structured Streaming over event tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def stream(spark: SparkSession, path: str, time: str = "ts") -> DataFrame:
    """A Parquet file or folder as a stream; an event time without a zone becomes one with it, as watermarks need."""
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rstrip("/").rpartition("/")
    rows = spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder)
    return rows.withColumn(time, F.col(time).cast("timestamp"))


def tumbling(rows: DataFrame, time: str, size: str, delay: str, keys: list[str], *measures) -> DataFrame:
    return rows.withWatermark(time, delay).groupBy(F.window(time, size).alias("window"), *keys).agg(*measures)


def running_totals(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Custom state: per key the number of rows and sum so far, a row per key and batch."""

    def step(k: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, total = state.get if state.exists else (0, 0.0)
        for part in parts:
            n, total = n + len(part), total + float(part[value].sum())
        state.update((n, total))
        yield pd.DataFrame({key: [k[0]], "n": [n], "total": [total]})

    kind = rows.schema[key].dataType.simpleString()
    return rows.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, n long, total double", "n long, total double", "update", GroupStateTimeout.NoTimeout)


def drain(rows: DataFrame, folder: str, mode: str = "append") -> DataFrame:
    """All that a stream of the present files gives, as a table written to a fresh folder (of complete output the last batch)."""
    done = {}

    def write(batch: DataFrame, n: int) -> None:
        done[n] = f"{folder}/{n}"
        batch.write.mode("overwrite").parquet(done[n])

    each_batch(rows, write, folder + "-state", mode)
    numbers = sorted(done)[-1:] if mode == "complete" else sorted(done)
    if not numbers:
        return rows.sparkSession.createDataFrame([], rows.schema)
    return rows.sparkSession.read.schema(rows.schema).parquet(*[done[n] for n in numbers])


def each_batch(rows: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Run a stream of the present files through write(batch, number)."""
    rows.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
