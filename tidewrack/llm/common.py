"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_bucket(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo `modulus`; a null id falls in bucket -1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus, F.lit(-1))


def fold_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def let(value: Column, body) -> Column:
    """body(value), with value computed once per row even where it is used inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def fresh_name(columns: list[str], name: str) -> str:
    """name, with underscores added until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under spark.checkpoint.dir.

    Where the session names none, a master that is one machine gets a temporary
    one; on a cluster machines would not share it, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="tidewrack-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read back: a cut in the lineage that outlives executors."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def key_filter(rows: DataFrame, hashed: Column, words: int = 1 << 19):
    """A test for arrays of hashes: False only where no row has that value of `hashed` (a long).

    A bitmap of `words` * 64 places, 4 MB, whatever the number of rows: few rows
    leave few false answers, and with very many it lets all through.  So it may
    only spare work, and an exact join must follow.
    """
    import numpy as np

    found = rows.select(F.pmod(hashed, F.lit(words * 64)).alias("place"))
    found = found.groupBy(F.expr("cast(place div 64 AS int)").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(place % 64 AS int)))"))
    bitmap = np.zeros(words, np.int64)
    for word, bits in found.collect():  # at most `words` rows
        bitmap[word] = bits
    shared = rows.sparkSession.sparkContext.broadcast(bitmap.view(np.uint64))

    def test(values):
        place = values % (words * 64)
        return (shared.value[place // 64] >> (place % 64).astype(np.uint64)) & np.uint64(1) == 1

    return test


def crc_bucket_sql(column: str, modulus: int) -> str:
    """crc_bucket in DuckDB's SQL, which has no crc32: bit by bit over the decimal digits."""
    digits = f"list_transform(range(1, len(CAST({column} AS VARCHAR)) + 1), lambda i: CAST(ord(substr(CAST({column} AS VARCHAR), CAST(i AS INT), 1)) AS BIGINT))"
    bits = "list_reduce(list_prepend(xor(a, b), [0::BIGINT for k in range(8)]), lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))"
    return f"coalesce(xor(list_reduce(list_prepend(4294967295::BIGINT, {digits}), lambda a, b: {bits}), 4294967295) % {modulus}, -1)"
