"""Mixing sources to target weights by Pfair scheduling, in DataFrame functions only.

Target weights are rounded to integers whose sum W is the schedule's period.
Block i of a source of weight w is released in slot floor(i*W/w) and due by
slot ceil((i+1)*W/w); earliest deadline first gives each slot to one block, so
after t slots each source has had within less than one block of t*w/W.  The
period's schedule is worked out once and repeats, so a row's slot follows from
its number within its source alone.  Rows of a source are taken in the order of
md5(key).  Every row stays, once: a source that runs out leaves its later slots
empty, and these are closed up, so the others keep their shares of one another.

The bound holds for the rounded weights: a share is rounded to a multiple of about
1 / resolution, and to one such step at least.

Defined cases: a null source is a source of its own; a source without a positive
weight, where weights are given, has no share: its rows follow after all others,
mixed by their counts; weights of absent sources do not matter; of equal deadlines
the first source in order of name is due; null keys sort first; repeated keys
stay as separate rows, in any order among themselves; texts are not looked at, so
their length does not matter; an empty table gives an empty result; extra columns
pass through, and the added columns replace any of the same name.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import let

#: Rows numbered by one task at a time, about.
ROWS_PER_BUCKET = 2_000
ADDED = ("weight", "block", "release", "deadline", "slot", "mix_position")


def schedule(counts: DataFrame, weights: dict | None, resolution: int, temperature: float) -> DataFrame:
    """One row per slot of the period: src, turn (the block's number in the period), slot_in, weight, period.

    At most max(resolution, sources) + sources rows.
    """
    one = counts.agg(F.sort_array(F.collect_list(F.struct("src", "n"))).alias("s"))
    if weights is None:
        shares = F.transform("s", lambda x: F.pow(x.n.cast("double"), F.lit(temperature)))
    else:
        given = F.create_map(*[F.lit(y) for k, v in weights.items() for y in ("\0" if k is None else f"s{k}", float(v))])
        shares = F.transform("s", lambda x: F.coalesce(F.try_element_at(given, x.src), F.lit(0.0)))
    one = one.withColumn("shares", shares)
    one = one.withColumn("total", F.aggregate("shares", F.lit(0.0), lambda a, x: a + x))
    one = one.withColumn("w", F.transform("shares", lambda x: F.greatest(F.lit(1), F.round(x / F.col("total") * resolution).cast("int"))))
    one = one.withColumn("period", F.aggregate("w", F.lit(0), lambda a, x: a + x)).where("period > 0")

    def step(acc, t):
        ready = F.transform(
            acc.done,
            lambda d, i: let(
                F.get("w", i),
                lambda w: F.when(
                    (d < w) & (F.floor(d.cast("long") * F.col("period") / w) <= t),
                    F.struct(F.ceil((d.cast("long") + 1) * F.col("period") / w).alias("due"), i.alias("i")),
                ),
            ),
        )
        return let(
            F.array_min(ready),
            lambda best: F.struct(
                F.transform(acc.done, lambda d, i: F.when(i == best.i, d + 1).otherwise(d)).alias("done"),
                F.concat(acc.picks, F.array(best.i)).alias("picks"),
            ),
        )

    picks = F.aggregate(
        F.sequence(F.lit(0), F.col("period") - 1),
        F.struct(F.transform("w", lambda _: F.lit(0)).alias("done"), F.array().cast("array<int>").alias("picks")),
        step,
        lambda acc: acc.picks,
    )
    slots = one.select("s", "w", "period", F.posexplode(picks).alias("slot_in", "i"))
    order = Window.partitionBy("i").orderBy("slot_in")
    return slots.select(
        F.get("s", F.col("i")).src.alias("src"),
        (F.row_number().over(order) - 1).alias("turn"),
        "slot_in",
        F.get("w", F.col("i")).alias("weight"),
        "period",
    )


def mix_sources(
    docs: DataFrame,
    weights: dict | None = None,
    *,
    source: str = "source",
    key: str = "doc_id",
    block_rows: int = 64,
    resolution: int = 1000,
    temperature: float = 0.5,
) -> DataFrame:
    """docs with weight, block, release, deadline, slot and mix_position (from 0, gapless).

    Without `weights` a source's target is its row count to the power `temperature`.
    """
    kept = [c for c in docs.columns if c not in ADDED]
    if weights is not None:
        given = {k: w for k, w in weights.items() if w > 0}
        named = F.coalesce(F.col(source).cast("string").isin([str(k) for k in given if k is not None]), F.lit(None in given))
        options = {"source": source, "key": key, "block_rows": block_rows, "resolution": resolution, "temperature": temperature}
        rest = mix_sources(docs.where(~named), **options)
        docs = docs.where(named)
        if not rest.isEmpty():
            first = _mixed(docs, kept, given, **options)
            ahead = first.agg(F.count("*").alias("rows"), (F.coalesce(F.max("slot"), F.lit(-1)) + 1).alias("slots")).first()
            moved = {c: F.col(c) + ahead.slots for c in ("release", "deadline", "slot")} | {"mix_position": F.col("mix_position") + ahead.rows}
            return first.unionByName(rest.withColumns(moved))
        weights = given
    return _mixed(docs, kept, weights, source=source, key=key, block_rows=block_rows, resolution=resolution, temperature=temperature)


def _mixed(docs: DataFrame, kept: list[str], weights: dict | None, *, source: str, key: str, block_rows: int, resolution: int, temperature: float) -> DataFrame:
    digits = max(0, math.ceil(math.log(max(docs.count(), 1) / ROWS_PER_BUCKET, 16)))
    rows = docs.select(
        *kept,
        F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("\0")).alias("_mix_src"),
        F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")).alias("_mix_digest"),
    ).withColumn("_mix_bucket", F.substring("_mix_digest", 1, digits))
    sizes = rows.groupBy(F.col("_mix_src").alias("src"), F.col("_mix_bucket").alias("bucket")).agg(F.count("*").alias("n"))
    plan = schedule(sizes.groupBy("src").agg(F.sum("n").alias("n")), weights, resolution, temperature)
    totals = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = sizes.select("src", "bucket", "n", F.coalesce(F.sum("n").over(totals), F.lit(0)).alias("before"))
    buckets = buckets.join(plan.where("turn = 0").select("src", "weight"), "src").select(
        F.col("src").alias("_mix_src"), F.col("bucket").alias("_mix_bucket"), F.col("n").alias("_mix_rows"), F.col("before").alias("_mix_before"), F.col("weight").alias("_mix_weight")
    )

    # rows before each slot: running sums within stretches of slots, plus the stretches before
    blocks = sizes.groupBy("src").agg(F.sum("n").alias("n")).join(plan.where("turn = 0").select("src", "weight", "period"), "src")
    blocks = blocks.select(
        "src", "n", "weight", "period", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / block_rows))).alias("block")
    )
    blocks = blocks.withColumn("turn", F.pmod("block", "weight").cast("int")).join(plan.select("src", "turn", "slot_in"), ["src", "turn"])
    blocks = blocks.select(
        "src",
        "block",
        (F.floor(F.col("block") / F.col("weight")) * F.col("period") + F.col("slot_in")).alias("slot"),
        F.least(F.lit(block_rows), F.col("n") - F.col("block") * block_rows).alias("rows"),
        F.floor(F.col("block") * F.col("period") / F.col("weight")).alias("release"),
        F.ceil((F.col("block") + 1) * F.col("period") / F.col("weight")).alias("deadline"),
    ).withColumn("stretch", F.floor(F.col("slot") / 4096))
    stretches = blocks.groupBy("stretch").agg(F.sum("rows").alias("rows"))
    stretches = stretches.select("stretch", F.coalesce(F.sum("rows").over(Window.orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead"))
    inside = F.coalesce(F.sum("rows").over(Window.partitionBy("stretch").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = blocks.withColumn("inside", inside).join(stretches, "stretch")
    blocks = blocks.select("src", "block", F.struct("slot", "release", "deadline", (F.col("ahead") + F.col("inside")).alias("first")).alias("place"))

    # the blocks that each bucket's rows fall in, so that rows are shuffled once, by bucket
    spans = buckets.withColumn("first_block", F.floor(F.col("_mix_before") / block_rows))
    last = F.floor((F.col("_mix_before") + F.col("_mix_rows") - 1) / block_rows)
    spans = spans.withColumn("_mix_block", F.explode(F.sequence("first_block", last)))
    spans = spans.join(blocks, (F.col("src") == F.col("_mix_src")) & (F.col("block") == F.col("_mix_block")))
    spans = spans.groupBy("_mix_src", "_mix_bucket", "_mix_before", "_mix_weight").agg(F.sort_array(F.collect_list(F.struct("block", "place"))).alias("_mix_places"))

    number = F.row_number().over(Window.partitionBy("_mix_src", "_mix_bucket").orderBy("_mix_digest", key)) - 1
    rows = rows.withColumn("_mix_number", number).join(spans, ["_mix_src", "_mix_bucket"])
    rows = rows.withColumn("_mix_number", F.col("_mix_number") + F.col("_mix_before"))
    block = F.floor(F.col("_mix_number") / block_rows)
    rows = rows.withColumn("_mix_block", block).withColumn("_mix_at", F.get("_mix_places", (block - F.floor(F.col("_mix_before") / block_rows)).cast("int"))["place"])
    return rows.select(
        *kept,
        F.col("_mix_weight").cast("int").alias("weight"),
        F.col("_mix_block").cast("long").alias("block"),
        F.col("_mix_at.release").cast("long").alias("release"),
        F.col("_mix_at.deadline").cast("long").alias("deadline"),
        F.col("_mix_at.slot").cast("long").alias("slot"),
        (F.col("_mix_at.first") + F.col("_mix_number") % block_rows).cast("long").alias("mix_position"),
    )


def op3_mix_sources(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix_sources(docs).select("doc_id", "source", *ADDED)


ORACLE_OP3 = """
WITH RECURSIVE c AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
w AS (SELECT source, n, greatest(1, CAST(round(sqrt(n) / (SELECT sum(sqrt(n)) FROM c) * 1000) AS INT)) AS w,
      row_number() OVER (ORDER BY source) - 1 AS i FROM c),
p AS (SELECT list(w ORDER BY i) AS ws, sum(w)::BIGINT AS period FROM w),
e(t, done, pick) AS (
  SELECT -1::BIGINT, [0 FOR x IN ws], NULL::BIGINT FROM p
  UNION ALL
  SELECT t + 1, [CASE WHEN k - 1 = b.i THEN done[k] + 1 ELSE done[k] END FOR k IN range(1, len(done) + 1)], b.i
  FROM (SELECT e.t, e.done, p.period, list_min([
      CASE WHEN e.done[k] < ws[k] AND floor(e.done[k]::BIGINT * period / ws[k]) <= e.t + 1
           THEN {'due': ceil((e.done[k]::BIGINT + 1) * period / ws[k])::BIGINT, 'i': (k - 1)::BIGINT} END
      FOR k IN range(1, len(ws) + 1)]) AS b FROM e, p WHERE e.t + 1 < p.period)
),
s AS (SELECT pick AS i, t AS slot_in, row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS turn FROM e WHERE t >= 0),
r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '')), doc_id) - 1 AS number FROM documents),
j AS (SELECT r.doc_id, r.source, w.w AS weight, number, number // 64 AS block, p.period, s.slot_in
      FROM r JOIN w ON r.source IS NOT DISTINCT FROM w.source CROSS JOIN p JOIN s ON s.i = w.i AND s.turn = (number // 64) % w.w)
SELECT doc_id, source, weight::INT AS weight, block::BIGINT AS block,
  floor(block * period / weight)::BIGINT AS release, ceil((block + 1) * period / weight)::BIGINT AS deadline,
  ((block // weight) * period + slot_in)::BIGINT AS slot,
  (row_number() OVER (ORDER BY (block // weight) * period + slot_in, number) - 1)::BIGINT AS mix_position
FROM j
"""
