"""Streaming queries over the events table, run until its present rows are done."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.tables import table
from ..streaming import events as S
from .query import query
from .sources import scratch


def _events(t):
    return S.stream(t.spark, f"{t.sf_dir}/events.parquet")


@query("""
SELECT strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events
WHERE time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events) GROUP BY ALL""")
def stream_tumbling(t):
    """Windows that the watermark has closed."""
    rows = S.tumbling(_events(t), "ts", "1 day", "1 hour", ["event_type"], F.count("*").alias("n"))
    return S.drain(rows.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_type", "n"), scratch(t.spark))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def stream_counts(t):
    return S.drain(_events(t).groupBy("event_type").agg(F.count("*").alias("n")), scratch(t.spark), "complete")


@query("SELECT DISTINCT event_type FROM events")
def stream_distinct(t):
    rows = _events(t).withWatermark("ts", "60 days").dropDuplicatesWithinWatermark(["event_type"])
    return S.drain(rows.select("event_type"), scratch(t.spark))


@query("SELECT user_id, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY user_id")
def stream_running_totals(t):
    rows = S.drain(S.running_totals(_events(t), "user_id", "value"), scratch(t.spark), "update")
    return rows.groupBy("user_id").agg(F.max("n").alias("n"), F.round(F.max_by("total", "n"), 4).alias("total"))


@query("SELECT event_id, c_mktsegment FROM events JOIN customer ON user_id = c_custkey WHERE event_type = 'purchase'")
def stream_static_join(t):
    customer = table(t.spark, t.sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    return S.drain(_events(t).where("event_type = 'purchase'").join(customer, "user_id").select("event_id", "c_mktsegment"), scratch(t.spark))


@query("""
SELECT a.event_id AS click, b.event_id AS purchase FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_type = 'click' AND b.event_type = 'purchase'
AND b.ts BETWEEN a.ts AND a.ts + INTERVAL 6 HOUR""")
def stream_stream_join(t):
    clicks = _events(t).where("event_type = 'click'").withWatermark("ts", "1 hour").select("user_id", F.col("ts").alias("at"), F.col("event_id").alias("click"))
    buys = _events(t).where("event_type = 'purchase'").withWatermark("ts", "1 hour").select(F.col("user_id").alias("buyer"), F.col("ts").alias("then"), F.col("event_id").alias("purchase"))
    met = clicks.join(buys, F.expr("user_id = buyer AND then BETWEEN at AND at + INTERVAL 6 HOURS"))
    return S.drain(met.select("click", "purchase"), scratch(t.spark))


@query("SELECT event_id, event_type FROM events WHERE value > 50")
def stream_each_batch(t):
    out = scratch(t.spark)
    rows = _events(t).where("value > 50").select("event_id", "event_type")
    S.each_batch(rows, lambda batch, n: batch.write.mode("overwrite").parquet(f"{out}/batch={n}"), out + "-state")
    return t.spark.read.schema("event_id long, event_type string").parquet(out).select("event_id", "event_type")
