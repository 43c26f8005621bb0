"""Other formats: written to the shared folder, and read back."""

from __future__ import annotations

import re
import tempfile
import uuid

from ..sources import callback, files
from .query import query


def scratch(spark) -> str:
    """A fresh path in the folder that driver and executors share; where the session names none, a temporary one if it is one machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="tidewrack-")
    return f"{root.rstrip('/')}/files-{uuid.uuid4().hex}"


_ROWS = "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer"


def _round_trip(t, kind, **options):
    rows = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    path = scratch(t.spark)
    files.write(rows, path, kind, **options)
    return files.read(t.spark, path, kind, rows.schema, **options)


query(_ROWS, "source_csv")(lambda t: _round_trip(t, "csv", header=True))
query(_ROWS, "source_json")(lambda t: _round_trip(t, "json"))
query(_ROWS, "source_orc")(lambda t: _round_trip(t, "orc"))
query(_ROWS, "source_parquet")(lambda t: _round_trip(t, "parquet", compression="zstd"))


@query("SELECT n_name AS value FROM nation")
def source_text(t):
    path = scratch(t.spark)
    files.write(t.nation.select("n_name"), path, "text")
    return files.read(t.spark, path, "text")


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment = 'MACHINERY'")
def source_partitioned(t):
    """One folder per segment; the filter reads one folder only."""
    path = scratch(t.spark)
    files.write(t.customer.select("c_custkey", "c_mktsegment").repartition("c_mktsegment"), path, "parquet", ("c_mktsegment",))
    return files.read(t.spark, path, "parquet").where("c_mktsegment = 'MACHINERY'")


@query("SELECT range AS i, range * range AS square FROM range(1000)")
def source_callback(t):
    return callback.numbers(t.spark, 1000)
