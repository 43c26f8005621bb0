import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewrack.functions.vectors import cosine
from tidewrack.operators import aggregates, changes, joins, nearest, scripts, windows
from tidewrack.streaming import events


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_range_join_edges(spark):
    points = spark.createDataFrame([(1, 0.0), (2, 10.0), (3, -3.5), (4, None)], "id int, p double")
    spans = spark.createDataFrame([("a", 0.0, 10.0), ("b", -4.0, -3.0), ("c", 5.0, 1.0), ("d", None, 2.0)], "name string, lo double, hi double")
    got = rows(joins.range_join(points, spans, "p", "lo", "hi", 3.0).select("id", "name"))
    assert got == [(1, "a"), (2, "a"), (3, "b")]
    assert joins.range_join(points, spans.limit(0), "p", "lo", "hi", 3.0).count() == 0


def test_asof_join_ties_and_nulls(spark):
    left = spark.createDataFrame([(1, "k", 5), (2, "k", 1), (3, "x", 9), (4, None, 5)], "id int, k string, t int")
    right = spark.createDataFrame([("k", 3, "old"), ("k", 5, "now"), ("k", 5, "also"), ("k", 6, "late")], "k string, t int, v string")
    assert rows(joins.asof_join(left, right, ["k"], "t", "t", ["v"]).select("id", "v")) == [(1, "now"), (2, None), (3, None), (4, None)]


def test_salted_join_is_a_join(spark):
    large = spark.createDataFrame([(i, 0 if i % 3 else i) for i in range(90)], "i int, k int")
    small = spark.createDataFrame([(0, "hot"), (3, "three"), (999, "none")], "k int, v string")
    assert rows(joins.salted_join(large, small, "k", 4)) == rows(large.join(small, "k"))
    assert rows(joins.salted_join(large, small, "k", 4, "left").select("i", "v")) == rows(large.join(small, "k", "left").select("i", "v"))


def test_outer_joins_give_unmatched_rows_once(spark):
    large = spark.createDataFrame([(1, 1), (2, 1), (3, 8), (4, None)], "i int, k int")
    small = spark.createDataFrame([(1, "a"), (9, "b"), (9, "b"), (None, "c")], "k int, v string")
    for how in ("right", "full"):
        assert rows(joins.salted_join(large, small, "k", 4, how).select("i", "k", "v")) == rows(large.join(small, "k", how).select("i", "k", "v"))
    points = spark.createDataFrame([(1, 2.0), (2, 50.0), (3, None)], "id int, p double")
    spans = spark.createDataFrame([("a", 0.0, 40.0), ("b", 60.0, 90.0), ("b", 60.0, 90.0), ("c", None, 1.0), ("d", 5.0, 4.0)], "name string, lo double, hi double")
    for how in ("left", "right", "full"):
        want = points.join(spans, (points.p >= spans.lo) & (points.p <= spans.hi), how)
        assert rows(joins.range_join(points, spans, "p", "lo", "hi", 3.0, how)) == rows(want)


def test_nearest_is_the_join_of_all_pairs(spark, monkeypatch):
    from tidewrack.plans.registry import QUERIES

    for name, size in (("ROWS", 40), ("QUERIES", 12), ("STRIP", 32), ("LANE", 4), ("PAIRS", 50)):
        monkeypatch.setattr(nearest, name, size)
    r = random.Random(7)
    some = lambda n: [r.uniform(-1, 1) for _ in range(n)]
    common = some(5)
    data = [(i, some(5)) for i in range(90)] + [(100 + i, common) for i in range(40)] + [(200 + i, [x * (i + 1) for x in common]) for i in range(20)]
    data += [(300, None), (301, None), (310, [0.0] * 5), (320, [1.0, None, 2.0, 3.0, 4.0]), (330, some(3)), (331, some(3)), (340, []), (350, [float("nan")] + some(4)), (40, some(5)), (None, some(5))]
    df = spark.createDataFrame(data, "i long, v array<float>")
    for some_rows in (df, df.where("i >= 300"), df.where("i = 40 OR i IS NULL"), df.limit(0)):
        queries = some_rows.where("i % 10 = 0")
        pairs = some_rows.join(queries.select(F.col("i").alias("q"), F.col("v").alias("w")), F.col("i") != F.col("q")).withColumn("near", F.round(cosine(F.col("v"), F.col("w")), 9))
        columns = ["q", "i", F.col("near").cast("string"), "rank"]  # NaN equals itself as a string
        want = rows(joins.top_per_key(pairs, ["q"], [F.desc("near"), F.col("i")], 5).select(columns))
        assert rows(nearest.nearest(some_rows, queries, "i", "v", 5).select(columns)) == want
        if want:  # strips and lanes, of which workers know the module's sizes only
            some_pairs = nearest._best(*(x.selectExpr("i AS key", "v AS vector").where("i IS NOT NULL").toArrow() for x in (queries, some_rows)), 5, 2e-9)
            here = spark.createDataFrame([tuple(x.values()) for x in some_pairs.to_pylist()], "q long, i long, near double").withColumn("near", F.round("near", 9))
            assert rows(joins.top_per_key(here, ["q"], [F.desc("near"), F.col("i")], 5).select(columns)) == want
    plan = QUERIES["vector_nearest"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_scripts(spark):
    text = "SELECT 1 AS a; SELECT 'x;--y' AS b -- no; end\n; ; SELECT nope; /* ; */ SELECT 2 - 1 AS c;"
    assert scripts.statements(text) == ["SELECT 1 AS a", "SELECT 'x;--y' AS b", "SELECT nope", "SELECT 2 - 1 AS c"]
    stopped, whole = scripts.run_script(spark, text), scripts.run_script(spark, text, go_on=True)
    assert len(stopped) == 3 and stopped[2].error and [r.rows.first()[0] for r in whole if r.rows] == [1, "x;--y", 1]
    assert scripts.run_script(spark, " -- nothing") == []


def test_samples(spark):
    from tidewrack.plans.registry import QUERIES

    sf = "/root/testdata/sf0.01"
    every = {r.o_orderkey for r in spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey").collect()}
    one, two = (sorted(r.o_orderkey for r in QUERIES["sample_rows"](spark, sf).collect()) for _ in range(2))
    assert one == two and len(set(one)) == len(one) and set(one) <= every
    assert abs(len(one) - 0.1 * len(every)) < 5 * (0.09 * len(every)) ** 0.5


def test_session_windows_at_the_gap(spark):
    start = datetime(2024, 1, 1)
    events = spark.createDataFrame([(1, start + timedelta(minutes=m)) for m in (0, 10, 20, 31, 41)], "u int, t timestamp")
    spark_own = events.groupBy("u", F.session_window("t", "10 minutes")).agg(F.count("*").alias("n"))
    own = windows.sessions(events, ["u"], "t", "10 MINUTES").groupBy("u", "session").agg(F.count("*").alias("n"))
    assert rows(spark_own.select("n")) == rows(own.select("n")) == [(2,), (3,)]


def test_top_per_key_and_aggregates(spark):
    df = spark.createDataFrame([("a", i) for i in range(10)] + [("b", None)], "k string, v int")
    assert rows(joins.top_per_key(df, ["k"], [F.desc_nulls_last("v")], 2).select("k", "v")) == [("a", 8), ("a", 9), ("b", None)]
    assert rows(aggregates.distinct_counts(df, ["k"], "v", "n")) == [("a", 10), ("b", 0)]
    lists = aggregates.salted(df, ["k"], {"v": F.collect_list("v")}, {"v": F.sort_array(F.flatten(F.collect_list("v")))}, 3)
    assert rows(lists) == [("a", list(range(10))), ("b", [])]


def test_windows(spark):
    df = spark.createDataFrame([(i, "k", i // 3) for i in range(9)], "i int, k string, g int")
    got = rows(windows.over_groups(df, ["k"], "g", 1, 0, F.count("*"), "n").select("i", "n"))
    assert got == [(i, 3 if i < 3 else 6) for i in range(9)]
    start = datetime(2024, 1, 1)
    events = spark.createDataFrame([(1, start + timedelta(minutes=m)) for m in (0, 5, 15, 40)] + [(2, start)], "u int, t timestamp")
    assert rows(windows.sessions(events, ["u"], "t", "10 MINUTES").select("u", "session")) == [(1, 1), (1, 1), (1, 1), (1, 2), (2, 1)]


def test_changes_keep_rows_where_the_condition_is_null(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 9)], "k int, v int")
    assert rows(changes.delete_where(df, F.col("v") > 6)) == [(1, 5), (2, None)]
    assert rows(changes.update_where(df, F.col("v") > 6, v=F.lit(0))) == [(1, 5), (2, None), (3, 0)]
    new = spark.createDataFrame([(1, 7, False), (3, 0, True), (4, 4, False)], "k int, v int, deleted boolean")
    assert rows(changes.merge(df, new, "k")) == [(1, 7), (2, None), (4, 4)]
    with pytest.raises(Exception, match="several changes"):
        changes.merge(df, new.union(new), "k").collect()


def test_plans_push_down(spark):
    from tidewrack.plans.registry import QUERIES

    plan = QUERIES["filter_range"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "PushedFilters: [" in plan and "GreaterThanOrEqual(o_totalprice,50000.0)" in plan
    assert "o_custkey" not in plan.split("ReadSchema:")[1].split(">")[0]


def test_drained_streams_are_files_beside_their_state(spark, tmp_path):
    source = str(tmp_path / "in.parquet")
    spark.createDataFrame([(i, i % 3, datetime(2024, 1, 1)) for i in range(30)], "i long, k long, ts timestamp").repartition(3).write.parquet(source)
    read = lambda: spark.readStream.schema("i long, k long").option("maxFilesPerTrigger", 1).parquet(source)
    counts = [(k, sum(range(k, 30, 3))) for k in range(3)]
    cases = [("all", "append", read(), [(i, i % 3) for i in range(30)]), ("sums", "complete", read().groupBy("k").agg(F.sum("i")), counts), ("none", "append", read().where("i < 0"), [])]
    for name, mode, stream, want in cases:
        out = events.drain(stream, f"file://{tmp_path}/{name}", mode)
        assert out.inputFiles() and all(f"{tmp_path}/{name}/" in f for f in out.inputFiles())
        assert (tmp_path / f"{name}-state" / "commits" / "2").exists()
        assert rows(out) == sorted(want, key=str)


def test_theta_exists_looks_at_the_largest_only(spark, tmp_path):
    from tidewrack.plans.registry import QUERIES

    customer = [(n, b) for n in (1, 2, None) for b in (None, -10.0, 6000.0, 6000.0)] + [(3, None), (4, float("nan"))]
    spark.createDataFrame(customer, "c_nationkey int, c_acctbal double").write.parquet(f"{tmp_path}/customer.parquet")
    supplier = [(1, 1, 999.0), (1, 1, 999.0), (2, 2, 1000.0), (3, 3, 0.0), (4, None, 0.0), (5, 2, None), (6, 4, 9e9), (7, 9, 0.0)]
    spark.createDataFrame(supplier, "s_suppkey long, s_nationkey int, s_acctbal double").write.parquet(f"{tmp_path}/supplier.parquet")
    df = QUERIES["subquery_theta_exists"](spark, str(tmp_path))
    assert rows(df) == [(1,), (1,), (6,)]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" not in plan and "max(c_acctbal" in plan


def test_range_join_cuts_wide_stretches(spark):
    """Cells follow the intervals' length, so that few pairs which do not match meet; no side is sent whole."""
    points = spark.range(4000).select(F.col("id").alias("i"), (F.col("id") * 0.7).alias("p"))
    spans = spark.range(3000).select(F.col("id").alias("s"), (F.col("id") * 1.1).alias("lo"), (F.col("id") * 1.1 + 25).alias("hi"))
    for how in ("inner", "left", "right", "full"):
        got = joins.range_join(points, spans, "p", "lo", "hi", 100.0, how)
        assert rows(got) == rows(points.join(spans, F.expr("p BETWEEN lo AND hi"), how))
        plan = got._jdf.queryExecution().toString()
        assert "SortMergeJoin [_cell" in plan and "BroadcastHashJoin [_cell" not in plan and "/ 12.5)" in plan
    for span in (spans.selectExpr("s", "lo", "lo AS hi"), spans.selectExpr("s", "lo", "lo + 300 AS hi"), spans.selectExpr("s", "lo", "double('NaN') AS hi").where("s < 0")):
        got = joins.range_join(points, span, "p", "lo", "hi", 100.0, "full")
        assert rows(got) == rows(points.join(span, F.expr("p BETWEEN lo AND hi"), "full"))


def test_salted_join_sends_no_side_whole(spark):
    large = spark.range(1000).select("id", (F.col("id") % 7).alias("k"))
    small = spark.range(5, 9).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    for how in ("inner", "left", "right", "full"):
        got = joins.salted_join(large, small, "k", 4, how)
        assert rows(got.select("id", "k", "v")) == rows(large.join(small, "k", how).select("id", "k", "v"))
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
