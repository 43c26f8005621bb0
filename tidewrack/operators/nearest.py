"""Nearest rows by cosine, without loss: blocks of vectors meet as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import top_per_key

#: Vectors and queries that meet in one group at most, about; tables of few vectors are cut smaller, into FEW groups.
ROWS, QUERIES, FEW = 65536, 32768, 32
#: Vectors and queries multiplied at once, and pairs scored at once.
STRIP, LANE, PAIRS = 4096, 512, 1 << 18


def nearest(rows: DataFrame, queries: DataFrame, key: str, vector: str, n: int, digits: int = 9) -> DataFrame:
    """q, key, near, rank: for each q among the keys of `queries`, the n rows of another key nearest by cosine, rounded to `digits`, then by key.

    All pairs are met, in groups of a block of rows and a block of queries, so a
    task's memory is bounded and no side is sent whole.  A product of matrices
    tells which pairs can be among a query's best of the block; only those are
    scored as `functions.vectors.cosine` does it, term by term, with its nulls.
    Keys are integers; rows without one match nothing.  Null scores come last,
    NaN first.
    """
    rows, queries = (df.select(F.col(key).alias("key"), F.col(vector).alias("vector")).where(F.col(key).isNotNull()) for df in (rows, queries))
    count = rows.count()
    blocks, lots = max(1, -(-count // ROWS), min(FEW, count // 512)), max(1, -(-queries.count() // QUERIES))
    deal = lambda df, own, parts, other, copies: df.withColumn(own, F.pmod(F.xxhash64("key"), F.lit(parts).cast("long"))).withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long"))))
    left = deal(queries, "lot", lots, "block", blocks).groupBy("block", "lot")
    right = deal(rows, "block", blocks, "lot", lots).groupBy("block", "lot")
    best = left.cogroup(right).applyInArrow(lambda a, b: _best(a, b, n, 2 * 10.0**-digits), "q long, key long, near double")
    best = best.withColumn("near", F.round("near", digits))
    return top_per_key(best, ["q"], [F.desc("near"), F.col("key")], n).withColumnRenamed("key", key)


class _Vectors:
    """Vectors as rows of a matrix, filled up with zeros; known: without nulls; plain: of a length that divides well."""

    def __init__(self, table: pa.Table):
        column = table.column("vector").combine_chunks()
        self.key = table.column("key").to_numpy()
        self.known = column.is_valid().to_numpy(zero_copy_only=False).copy()
        self.size = column.value_lengths().fill_null(0).to_numpy().astype(np.int64)
        flat = column.flatten().cast(pa.float64())
        owner = np.repeat(np.arange(len(self.size)), self.size)
        self.known[owner[flat.is_null().to_numpy(zero_copy_only=False)]] = False
        self.terms = np.zeros((max(1, self.size.max(initial=0)), len(self.size)))
        self.terms[np.arange(len(owner)) - np.repeat(np.cumsum(self.size) - self.size, self.size), owner] = flat.fill_null(0.0).to_numpy()
        total = np.zeros(len(self.size))
        for x in self.terms:
            total += x * x
        self.norm = np.sqrt(total)
        self.plain = self.known & (self.norm > 1e-100) & (self.norm < 1e100)
        self.unit = np.where(self.plain, self.terms / np.where(self.plain, self.norm, 1.0), 0.0).T.copy()


def _scores(a: _Vectors, b: _Vectors, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Cosines of the pairs i, j, in the order of a sort: infinite for NaN, minus infinite for null."""
    out = np.empty(len(i))
    for at in range(0, len(i), PAIRS):
        x, y = i[at : at + PAIRS], j[at : at + PAIRS]
        total = np.zeros(len(x))
        for s, t in zip(a.terms, b.terms):
            total += s[x] * t[y]
        length = a.norm[x] * b.norm[y]
        none = ~a.known[x] | ~b.known[y] | (a.size[x] != b.size[y]) | (length == 0)
        near = total / np.where(none, 1.0, length)
        out[at : at + PAIRS] = np.where(none, -np.inf, np.where(np.isnan(near), np.inf, near))
    return out


def _first(i: np.ndarray, near: np.ndarray, key: np.ndarray, n: int, slack: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of the pairs that may be among their query's n best once rounded; queries that have n, and their n-th best score."""
    order = np.lexsort((key, -near, i))
    i, near = i[order], near[order]
    new = np.append(True, i[1:] != i[:-1])[: len(i)]
    start = np.flatnonzero(new)
    tie = np.flatnonzero(new | np.append(True, near[1:] != near[:-1])[: len(i)])
    has = start[start + n - 1 < np.append(start[1:], len(i))]
    least = np.full(i.max(initial=-1) + 1, -np.inf)
    least[i[has]] = near[has + n - 1]
    place = np.arange(len(i)) - np.repeat(tie, np.diff(np.append(tie, len(i))))
    return order[(place < n) & (near >= least[i] - slack)], i[has], near[has + n - 1]


@np.errstate(all="ignore")
def _best(queries: pa.Table, rows: pa.Table, n: int, slack: float) -> pa.Table:
    a, b = _Vectors(queries), _Vectors(rows)
    dim = min(a.unit.shape[1], b.unit.shape[1])
    uneven = not (a.plain.all() and b.plain.all() and len({*a.size.tolist(), *b.size.tolist()}) < 2)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    for low in range(0, len(a.key), LANE):
        lane = slice(low, min(low + LANE, len(a.key)))
        floor = np.full(lane.stop - low, -np.inf)  # what a score must reach
        i, j, near = found[0]
        for at in range(0, len(b.key), STRIP):
            strip = slice(at, at + STRIP)
            guess = a.unit[lane, :dim] @ b.unit[strip, :dim].T
            odd = None  # pairs to be scored in any case
            if uneven:
                odd = ~a.plain[lane][:, None] | ~b.plain[strip] | (a.size[lane][:, None] != b.size[strip])
                guess[odd] = np.inf
            many = np.flatnonzero((guess >= floor[:, None]).sum(axis=1) > 4 * n)
            if len(many):  # the strip's own n-th best is a bound as well
                sure = np.where(a.key[lane][many][:, None] == b.key[strip], -np.inf, guess[many])
                if uneven:
                    sure[odd[many]] = -np.inf
                floor[many] = np.maximum(floor[many], np.partition(sure, -n, axis=1)[:, -n] - 2 * slack)
            x, y = np.nonzero(guess >= floor[:, None])
            other = a.key[low + x] != b.key[at + y]
            x, y = x[other], y[other] + at
            if not len(x):
                continue
            i, j, near = np.append(i, x), np.append(j, y), np.append(near, _scores(a, b, low + x, y))
            keep, full, score = _first(i, near, b.key[j], n, slack)
            i, j, near = i[keep], j[keep], near[keep]
            floor[full] = np.maximum(floor[full], score - 2 * slack)
        found.append((i + low, j, near))
    i, j, near = (np.concatenate(x) for x in zip(*found))
    score = pa.array(np.where(np.isposinf(near), np.nan, near), mask=np.isneginf(near))
    return pa.table({"q": a.key[i].astype(np.int64), "key": b.key[j].astype(np.int64), "near": score})
