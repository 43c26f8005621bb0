"""Joins that Spark has no single operator for, or that need care with skew."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Cells that a stretch of a range join is cut into, at most.
PIECES = 16


def range_join(left: DataFrame, right: DataFrame, point: str, low: str, high: str, width: float, how: str = "inner") -> DataFrame:
    """Rows with low <= point <= high, as an equi-join on cells of `width`, or finer.

    A row of `right` is repeated for each cell that its interval touches, where a
    theta join would compare all pairs.  Cells far wider than the intervals would
    bring together many pairs that do not match, so a first pass over `right`
    takes their mean length, and cells are cut to about half of that (of `width`
    at most PIECES cells).  The join is by sorting, since a hash table of all
    repeated rows would have to fit each task.  Null points and intervals match
    nothing.  `how` is inner, left, right or full; unmatched rows of `right` are
    found by their intervals, in a second pass that stops at an interval's first
    point.  Column names of the two sides must differ.
    """
    if how not in ("inner", "left", "right", "full"):
        raise ValueError(f"range_join does not know {how!r}")
    usual = right.where(F.col(low) <= F.col(high)).agg(F.avg(F.col(high).cast("double") - F.col(low).cast("double"))).first()[0]
    pieces = 1 if usual is None or usual != usual else PIECES if PIECES * usual <= 2 * width else max(1, round(2 * width / usual))
    cell = lambda c: F.floor(F.col(c).cast("double") / (width / pieces))
    spread = lambda spans: spans.withColumn("_cell", F.explode(F.when(F.col(low) <= F.col(high), F.sequence(cell(low), cell(high)))))

    def join(points, spans, one, two, kind):
        return one.join(two.hint("merge"), (points["_cell"] == spans["_cell"]) & (points[point] >= spans[low]) & (points[point] <= spans[high]), kind)

    points, spans = left.withColumn("_cell", cell(point)), spread(right)
    matched = join(points, spans, points, spans, "left" if how in ("left", "full") else "inner").drop("_cell")
    if how in ("inner", "left"):
        return matched
    points, spans = points.select(point, "_cell").distinct(), spread(right.select(low, high).distinct())
    met = join(points, spans, spans, points, "left_semi").select(F.col(low).alias("_low"), F.col(high).alias("_high")).distinct()
    lone = right.join(met, right[low].eqNullSafe(F.col("_low")) & right[high].eqNullSafe(F.col("_high")), "left_anti")
    return matched.unionByName(lone, allowMissingColumns=True)


def asof_join(left: DataFrame, right: DataFrame, by: list[str], left_on: str, right_on: str, columns: list[str]) -> DataFrame:
    """left with `columns` of the latest right row of the same `by` whose time is not after left's; null where there is none.

    Both sides are unioned and scanned once in time order, so it costs one
    shuffle and one sort, however many right rows precede each left row.  Of
    right rows of equal time the one largest by `columns` counts; at equal times
    right rows come first.
    """
    a = left.select(*left.columns, F.lit(None).cast(_struct_type(right, columns)).alias("_match"), F.col(left_on).alias("_at"), F.lit(1).alias("_side"))
    b = right.select(
        *[F.col(c) if c in by else F.lit(None).cast(left.schema[c].dataType).alias(c) for c in left.columns],
        F.struct(*columns).alias("_match"),
        F.col(right_on).alias("_at"),
        F.lit(0).alias("_side"),
    )
    seen = Window.partitionBy(*by).orderBy("_at", "_side", "_match").rowsBetween(Window.unboundedPreceding, 0)
    both = a.unionByName(b).withColumn("_match", F.last("_match", ignorenulls=True).over(seen))
    return both.where("_side = 1").select(*left.columns, *[F.col(f"_match.{c}").alias(c) for c in columns])


def _struct_type(df: DataFrame, columns: list[str]):
    return df.select(F.struct(*columns).alias("s")).schema["s"].dataType


def salted_join(large: DataFrame, small: DataFrame, on: str, salts: int = 16, how: str = "inner") -> DataFrame:
    """Equi-join of a side with hot keys: its rows of a key go to `salts` tasks, and the other side is repeated to each.

    The join is by sorting: Spark knows the size of `small` before its rows are
    repeated, and might send a table of all repeated rows to each task.  `how` is
    inner, left, right or full; as rows of `small` are repeated, its unmatched
    ones are added once, from the keys that `large` lacks.
    """
    if how in ("right", "full"):
        lone = small.join(large.select(on).distinct().hint("merge"), on, "left_anti")
        return salted_join(large, small, on, salts, "inner" if how == "right" else "left").unionByName(lone, allowMissingColumns=True)
    if how not in ("inner", "left"):
        raise ValueError(f"salted_join does not know {how!r}")
    large = large.withColumn("_salt", F.pmod(F.xxhash64(*[c for c, t in large.dtypes if not t.startswith("map")]), F.lit(salts)).cast("int"))
    small = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return large.join(small.hint("merge"), [on, "_salt"], how).drop("_salt")


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows of each key.  Spark cuts each task's rows to n per key before the shuffle (WindowGroupLimit)."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("rank", rank).where(F.col("rank") <= n)
