"""Document fingerprints by winnowing, in DataFrame functions only.

A text's words (A-Z lower-cased) give a hash for each run of `k` words; of each
window of `window` successive hashes the smallest is kept, the rightmost of
equal ones, with its position.  Any run of k + window - 1 words that two texts
share puts a common hash into both fingerprints; no run shorter than k words
does.  A text of fewer words than k has one hash, of all of them.

Hashes are compared for the minimum by their leading 33 bits, which leaves room
to carry the position in the same number (up to 2**30 words); the fingerprint
holds whole hashes.

Defined cases: a null text is empty and has an empty fingerprint; two empty
fingerprints are alike to degree 1; null ids come last in descending order, and
equal ids are ordered by a hash of the text; a lone document is its own next;
an empty table gives an empty result; repeated rows are rows of their own; a very
long text is hashed whole in one task.  Other columns pass through, but
`fingerprint` and `next` of the input are replaced, each by the function that adds it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fold_ascii, fresh_name, let

K, WINDOW = 5, 16
_PLACES = 30
#: Documents ordered by one task, at least; never more than MOST_BUCKETS tasks.
ROWS_PER_BUCKET, MOST_BUCKETS, CELLS = 1_000, 100_000, 128


def fingerprint_of(text: Column, k: int = K, window: int = WINDOW) -> Column:
    """struct<hashes: array<bigint>, positions: array<int>>, by position."""
    words = F.array_remove(F.split(fold_ascii(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), "")
    hashes = let(
        words,
        lambda w: F.when(F.size(w) >= k, F.transform(F.sequence(F.lit(0), F.size(w) - k), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)])))
        .when(F.size(w) > 0, F.array(F.xxhash64(F.array_join(w, " "))))
        .otherwise(F.array().cast("array<bigint>")),
    )
    pack = lambda h, i: F.shiftleft(F.shiftrightunsigned(h, 31), _PLACES).bitwiseOR(F.lit((1 << _PLACES) - 1) - i)
    least = lambda p: (
        F.when(F.size(p) > window, F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(p) - window + 1), lambda i: F.array_min(F.slice(p, i, window)))))
        .when(F.size(p) > 0, F.array(F.array_min(p)))
        .otherwise(p)
    )
    place = lambda p: ((1 << _PLACES) - 1 - p.bitwiseAND((1 << _PLACES) - 1)).cast("int")
    return let(
        hashes,
        lambda h: let(
            let(F.transform(h, pack), least),
            lambda p: F.struct(F.transform(p, lambda x: F.get(h, place(x))).alias("hashes"), F.transform(p, place).alias("positions")),
        ),
    )


def fingerprint(docs: DataFrame, text: str = "text", k: int = K, window: int = WINDOW) -> DataFrame:
    return docs.withColumn("fingerprint", fingerprint_of(F.col(text), k, window))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two fingerprints' hashes."""
    return let(
        F.struct(F.array_distinct(a.hashes).alias("a"), F.array_distinct(b.hashes).alias("b")),
        lambda s: let(
            F.size(F.array_intersect(s.a, s.b)),
            lambda both: F.when((F.size(s.a) == 0) & (F.size(s.b) == 0), 1.0).otherwise(both / (F.size(s.a) + F.size(s.b) - both)),
        ),
    )


def with_next(docs: DataFrame, columns: list[str], key: str = "doc_id", text: str = "text", derive=lambda d: d) -> DataFrame:
    """derive(docs) with `next`, a struct of `columns` of the next document by descending key; the first follows the last.

    Ranges of keys are ordered by a task each.  Their bounds come from
    approximate percentiles, interpolated; each range's last row gets the first
    row of the following range, of which there are at most MOST_BUCKETS.
    """
    stats = docs.agg(F.count("*").alias("n"), F.percentile_approx(key, [i / CELLS for i in range(CELLS + 1)], 10_000).alias("bounds")).first()
    bounds = sorted(set(stats.bounds or [0]))
    buckets = max(1, min(MOST_BUCKETS, stats.n // ROWS_PER_BUCKET))
    parts = -(-buckets // max(1, len(bounds) - 1))
    limits = F.array(*[F.lit(int(b)).cast("long") for b in bounds])
    taken = derive(docs).columns
    at, in_cell, more, first_of, head, head_key = (fresh_name(taken, c) for c in ("_bucket", "_cell", "_more", "_follow", "_head", "_head_key"))
    next_of = {c: fresh_name(taken, f"_next_{c}") for c in columns}
    cell = F.size(F.filter(limits, lambda b: b <= F.col(key)))
    low, high = F.get(limits, F.col(in_cell) - 1), F.get(limits, F.col(in_cell))
    inside = F.when(high > low, F.least(F.lit(parts - 1), F.floor((F.col(key) - low) / (high - low) * parts)))
    bucket = F.when(F.col(key).isNull(), -1).otherwise(F.col(in_cell) * parts + F.coalesce(inside, F.lit(0))).cast("long")
    placed = lambda d: d.withColumn(in_cell, cell).withColumn(at, bucket).drop(in_cell)

    order = [F.col(key).desc_nulls_last(), F.xxhash64(text)]
    firsts = placed(docs.select(key)).groupBy(at).agg(F.max(key).alias("_first"))
    ring = Window.orderBy(F.col(at).desc())  # a row per bucket
    around = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # (a null first key is that of the null ids' bucket, so "no following bucket" is told by the bucket)
    follow = F.when(F.lead(at).over(ring).isNull(), F.first("_first").over(around)).otherwise(F.lead("_first").over(ring))
    firsts = firsts.select(at, follow.alias(first_of))
    # the first row of each bucket: ids and texts of at most MOST_BUCKETS documents
    heads = docs.join(F.broadcast(firsts.select(first_of).distinct()), docs[key].eqNullSafe(F.col(first_of)), "left_semi")
    heads = derive(heads).groupBy(key).agg(F.min_by(F.struct(*columns), F.xxhash64(text)).alias(head)).select(F.col(key).alias(head_key), head)
    heads = firsts.join(heads, F.col(first_of).eqNullSafe(F.col(head_key))).select(at, head)

    # single columns, since a struct of them would be shuffled besides them
    follow = Window.partitionBy(at).orderBy(*order)
    rows = placed(derive(docs)).select("*", *[F.lead(c).over(follow).alias(next_of[c]) for c in columns], F.lead(F.lit(1)).over(follow).alias(more))
    rows = rows.join(heads, at)
    own = F.struct(*[F.col(next_of[c]).alias(c) for c in columns])
    rows = rows.withColumn("next", F.when(F.col(more).isNotNull(), own).otherwise(F.col(head)))
    return rows.drop(at, head, more, *next_of.values())


def op7_fingerprints(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(docs, ["text", "fingerprint"], derive=fingerprint)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), n - half), F.substring("next.text", F.lit(1), half)))
    rows = rows.withColumn("edited_fp", fingerprint_of(F.col("edited")))
    show = lambda c: F.array_join(F.zip_with(f"{c}.hashes", f"{c}.positions", lambda h, p: F.concat(F.hex(h), F.lit("@"), p)), " ")
    return rows.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        show("fingerprint").alias("fingerprint"),
        show("edited_fp").alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next.fingerprint")).alias("near_next"),
    )
