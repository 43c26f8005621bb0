"""Language identification by nearest centroids of TF-IDF n-gram vectors.

A text's vector counts the letter n-grams of its words (lower case, a space
before and after each run of letters), folded into `DIMENSIONS` places by a
hash, weighted (1 + log count) * idf and scaled to unit length.  Each learned
language has several centroids, clustered from its training vectors; a text
gets the language of the centroid nearest by cosine.

A text is rejected when it is further from its centroid than nearly all
training rows of that language are from theirs (`REJECT_QUANTILE`, plus a
margin), or when it has no letter.

Training takes the `SAMPLE` different labelled texts of each language that are
first by a hash of the text (all where there are fewer), so copies neither crowd
out other texts nor add rows: one pass over the table to hash the texts, one to
fetch the sample.  The sample gives the centroids only: document frequencies are
counted over all labelled rows, and so are their distances (to 1 / `BINS`).  The model that is sent to the tasks has at most
languages * CLUSTERS * DIMENSIONS weights.  Prediction reads every text once,
whole, without a shuffle.

Defined cases: a null or letterless text is ``und`` with score 0 and is
rejected; equal distances go to the language first in alphabetical order; a
table with nothing to learn from gives ``und`` throughout; repeated rows are
separate rows; other columns pass through, and the added columns replace any of
the same name.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import tokens
from .common import crc_bucket, stored

DIMENSIONS = 1 << 13
SIZES = (1, 2, 3)
CLUSTERS = 4
#: Different texts of a language that the model is fitted on, at most.
SAMPLE = 600
REJECT_QUANTILE, REJECT_MARGIN = 0.999, 0.2
#: Distances of training rows are counted in steps of 1 / BINS.
BINS = 1 << 12
UNKNOWN = "und"
ADDED = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("distance", T.DoubleType()), T.StructField("rejected", T.BooleanType())])


@cache
def _letters() -> np.ndarray:
    """For each code point its lower-case letter, or a space."""
    out = np.full(0x110000, 32, dtype=np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def vectors(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of folded n-grams, a row per text, and whether it has a letter."""
    n = len(texts)
    spaced = " ".join(texts) + " "
    code = np.frombuffer(spaced.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    code = np.concatenate([[np.uint32(32)], _letters()[code]])
    sizes = np.fromiter(map(len, texts), np.int64, n)
    owner = np.repeat(np.arange(n), sizes + 1)
    owner = np.concatenate([[0], owner])
    letter = code != 32
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one space stands for each run of them
    keep[0] = True
    code, owner, letter = code[keep].astype(np.uint64), owner[keep], letter[keep]
    counts = np.zeros((n, DIMENSIONS), dtype=np.float32)
    has = np.bincount(owner[letter], minlength=n) > 0
    total = np.zeros(n * DIMENSIONS, dtype=np.int64)
    for k in SIZES:
        if len(code) < k:
            continue
        m = len(code) - k + 1
        gram, inside = np.full(m, k, dtype=np.uint64), np.zeros(m, dtype=bool)
        for i in range(k):
            gram = (gram + code[i : i + m]) * tokens._BASE
            inside |= letter[i : i + m]
        if k == 3:
            inside &= letter[1 : m + 1]  # not across a space
        at = owner[k - 1 :]  # the last character's text owns the n-gram
        place = at[inside] * DIMENSIONS + (gram[inside] >> np.uint64(64 - 13)).astype(np.int64)
        total += np.bincount(place, minlength=n * DIMENSIONS)
    counts[:] = total.reshape(n, DIMENSIONS)
    return counts, has


def _weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    seen = counts > 0
    counts[seen] = 1 + np.log(counts[seen])
    counts *= idf
    norm = np.sqrt(np.einsum("ij,ij->i", counts, counts))
    counts /= np.maximum(norm, 1e-12)[:, None]
    return counts


def _cluster(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Unit centroids of unit vectors by spherical k-means, started at vectors far from one another."""
    centers = [x.mean(axis=0)]
    near = x @ (centers[0] / max(np.linalg.norm(centers[0]), 1e-12))
    picks = []
    for _ in range(min(k, len(x))):
        picks.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[picks[-1]])
    centers = x[picks]
    for _ in range(rounds):
        who = np.argmax(x @ centers.T, axis=1)
        fresh = np.stack([x[who == j].mean(axis=0) if (who == j).any() else centers[j] for j in range(len(centers))])
        fresh /= np.maximum(np.linalg.norm(fresh, axis=1), 1e-12)[:, None]
        if np.allclose(fresh, centers):
            break
        centers = fresh
    return centers


def draw(labelled: DataFrame) -> DataFrame:
    """lang and text of the SAMPLE different texts of each lang that come first by hash, once each."""
    hashed = labelled.withColumn("_hash", F.xxhash64("text"))
    different = stored(hashed.select("lang", "_hash").distinct(), "language-texts")
    # of about twice as many texts as wanted, which hardly can be too few, the first are ranked
    sizes = different.groupBy("lang").agg(F.count("*").alias("n"))
    low = different.join(F.broadcast(sizes), "lang").where(F.pmod("_hash", F.lit(1 << 30)) / (1 << 30) < 2 * SAMPLE / F.col("n"))  # a row per language
    first = Window.partitionBy("lang").orderBy(F.pmod("_hash", F.lit(1 << 30)), "_hash")
    keys = low.withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") <= SAMPLE).select("lang", "_hash")
    found = hashed.join(F.broadcast(keys), ["lang", "_hash"])  # at most SAMPLE rows per language
    # combined within tasks, so that of a text's copies each task sends one
    return found.groupBy("lang", "_hash").agg(F.first("text").alias("text")).select("lang", "text")


def fit(labelled: DataFrame, *, text: str = "text", label: str = "lang") -> dict:
    """The model: languages, idf, centroids, each centroid's language, and each language's furthest distance."""
    labelled = labelled.where(F.col(label).isNotNull() & F.col(text).isNotNull()).select(F.col(label).cast("string").alias("lang"), F.col(text).alias("text"))
    picked = draw(labelled)
    idf = _idf(labelled)
    if idf is None:
        return {"langs": []}

    def centre(table: pa.Table) -> pa.Table:
        lang = table.column("lang")[0].as_py()
        rows = []  # a language's sample is bounded
        for part in _parts(table.column("text").to_pylist()):
            counts, has = vectors(part)
            rows.append(_weigh(counts[has], idf))
        x = np.concatenate(rows)
        centers = [_cluster(x, CLUSTERS).astype("<f4").tobytes()] if len(x) else []
        return pa.table({"lang": [lang] * len(centers), "centers": centers}, schema=pa.schema([("lang", pa.string()), ("centers", pa.binary())]))

    found = sorted(picked.groupBy("lang").applyInArrow(centre, "lang string, centers binary").collect(), key=lambda r: r.lang)
    if not found:
        return {"langs": []}
    parts = [np.frombuffer(r.centers, "<f4").reshape(-1, DIMENSIONS) for r in found]
    model = {
        "langs": [r.lang for r in found],
        "idf": idf,
        "centers": np.concatenate(parts),
        "owner": np.repeat(np.arange(len(parts)), [len(p) for p in parts]),
    }
    return model | {"reach": _reach(labelled, model)}


def _idf(labelled: DataFrame) -> np.ndarray | None:
    """Inverse document frequency of each dimension over all rows with a letter; None where there are none."""

    def run(batches):
        df, n = np.zeros(DIMENSIONS, np.int64), 0
        for batch in batches:
            for part in _parts(batch.column("text").to_pylist()):
                counts, has = vectors(part)
                df += (counts[has] > 0).sum(axis=0)
                n += int(has.sum())
        tokens.release()
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(df[at], n))], names=["at", "n"])

    counted = labelled.select("text").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    found = dict(map(tuple, counted.collect()))  # at most DIMENSIONS + 1 rows
    n = found.pop(-1, 0)
    if not n:
        return None
    df = np.zeros(DIMENSIONS)
    df[list(found)] = list(found.values())
    return (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)


def _reach(labelled: DataFrame, model: dict) -> np.ndarray:
    """Per language the distance that REJECT_QUANTILE of its rows keep to its nearest centroid, and the margin."""
    shared = labelled.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        index = {lang: i for i, lang in enumerate(m["langs"])}
        for batch in batches:
            langs = np.array([index.get(x, -1) for x in batch.column("lang").to_pylist()], dtype=np.int64)
            first = 0
            for part in _parts(batch.column("text").to_pylist()):
                counts, has = vectors(part)
                who = langs[first : first + len(part)]
                cosine = np.where(m["owner"] == who[:, None], _weigh(counts, m["idf"]) @ m["centers"].T, -1)
                step = np.ceil(np.clip(1 - cosine.max(axis=1), 0, 1) * BINS).astype(np.int64)
                known = has & (who >= 0)
                keys, n = np.unique(who[known] * (BINS + 1) + step[known], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys // (BINS + 1)), pa.array(keys % (BINS + 1)), pa.array(n)], names=["who", "step", "n"])
                first += len(part)
        tokens.release()

    counted = labelled.select("lang", "text").mapInArrow(run, "who long, step long, n long").groupBy("who", "step").agg(F.sum("n").alias("n"))
    each = Window.partitionBy("who")  # at most BINS + 1 rows per language
    counted = counted.withColumn("upto", F.sum("n").over(each.orderBy("step"))).withColumn("all", F.sum("n").over(each))
    reach = np.ones(len(model["langs"]))
    for who, step in counted.where(F.col("upto") >= F.ceil((F.col("all") - 1) * REJECT_QUANTILE) + 1).groupBy("who").agg(F.min("step")).collect():
        reach[who] = step / BINS
    return reach + REJECT_MARGIN


def _parts(texts: list[str], rows: int = 128, chars: int = 1 << 19):
    """Runs of texts, bounded in number and characters (one text may exceed them)."""
    part, size = [], 0
    for t in texts:
        if part and (len(part) == rows or size + len(t) > chars):
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t)
    if part:
        yield part


def predict(docs: DataFrame, model: dict, *, text: str = "text") -> DataFrame:
    """docs with the columns of ADDED.  score is 1 - distance / 2 of the nearest centroid."""
    names = set(ADDED.fieldNames())
    docs = docs.select([c for c in docs.columns if c not in names])
    schema = T.StructType([*docs.schema.fields, *ADDED.fields])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        langs = m["langs"]
        for batch in batches:
            first = 0
            for part in _parts(batch.column(text).fill_null("").to_pylist()):
                n = len(part)
                counts, has = vectors(part)
                if langs:
                    cosine = _weigh(counts, m["idf"]) @ m["centers"].T
                    best = np.argmax(cosine, axis=1)
                    distance = np.clip(1 - cosine[np.arange(n), best], 0, 1).astype(float)
                    who = m["owner"][best]
                    rejected = ~has | (distance > m["reach"][who])
                    names = [langs[w] if h else UNKNOWN for w, h in zip(who, has)]
                    score = np.where(has, 1 - distance / 2, 0.0)
                    distance = np.where(has, distance, 1.0)
                else:
                    names, score, distance, rejected = [UNKNOWN] * n, np.zeros(n), np.ones(n), np.ones(n, dtype=bool)
                extra = [pa.array(names, pa.string()), pa.array(score), pa.array(distance), pa.array(rejected)]
                yield pa.RecordBatch.from_arrays([*batch.slice(first, n).columns, *extra], names=schema.fieldNames())
                first += n
        tokens.release()

    return docs.mapInArrow(run, schema)


def train_rows(docs: DataFrame) -> DataFrame:
    return docs.where(crc_bucket(F.col("doc_id"), 4) != 2)


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(train_rows(docs))
    out = predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", (crc_bucket(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "distance", "rejected")
