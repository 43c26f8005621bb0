import random
from collections import defaultdict

import corpus_pipeline as P
from pyspark.sql import functions as F
from tidewrack.llm import packing as K
from test_ngram_join import brute
from test_packing import ids_of

import numpy as np


def test_stages_against_brute_force(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    left = {}
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        left[name] = [r.asDict() for r in docs.collect()]
        ids = [r["doc_id"] for r in left[name]]
        assert len(set(ids)) == len(ids) and set(ids) <= {r.doc_id for r in before.collect()}
    assert all(len(r["text"].split()) and r["n_chars"] == len(r["text"]) for r in left["quality"])
    rows = [(r["doc_id"], r["text"]) for r in left["language"]]
    stays = {int(c) for _, _, c in brute(rows, P.SHINGLE, P.PERCENT)}
    assert {r["doc_id"] for r in left["near_duplicates"]} == stays
    assert sorted(map(str, left["mixing"])) == sorted(map(str, left["near_duplicates"]))
    want = {r["doc_id"]: ids_of(r["text"]) for r in left["mixing"]}
    got, sequences = defaultdict(list), defaultdict(list)
    for r in P.packing(spark, docs, sf).collect():
        got[r.doc_id].append((r.piece, r.ids))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert {d: np.frombuffer(b"".join(x for _, x in sorted(p)), "<u4").tolist() for d, p in got.items()} == want
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 1024
    whole = P.run(spark, sf).collect()
    assert sorted((r.doc_id, r.piece) for r in whole) == sorted((d, p) for d, x in got.items() for p, _ in x)


def test_repeated_null_and_empty_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(20)
    twice = docs.unionByName(docs.withColumn("doc_id", docs.doc_id.cast("long")))
    kept = P.near_duplicates(spark, twice, "")
    once = P.near_duplicates(spark, docs, "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in once.collect())
    schema = docs.schema
    odd = spark.createDataFrame([(None, None, None, None, None), (None, "a b", None, "s", 3), (1, None, "en", None, None), (2, "", None, None, 0)], schema)
    for rows in (odd, docs.limit(0)):
        for _, stage in P.STAGES:
            rows = spark.createDataFrame(stage(spark, rows, "").collect() or [], stage(spark, rows, "").schema)
            if "text" not in rows.columns:
                break


def words(n, seed):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(10**6)}" for _ in range(n))


def test_rows_go_not_ids(spark):
    a, b, c = words(80, 1), words(80, 2), words(80, 3)
    near = a + " and a little more"
    rows = [(3, a), (5, near), (5, b), (None, near), (None, c), (None, c), (7, ""), (7, ""), (8, c + " x"), (9, b), (9, b), (5, b)]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = sorted(((r.doc_id, r.text) for r in P.near_duplicates(spark, docs, "").collect()), key=str)
    assert left == sorted([(3, a), (5, b), (7, ""), (7, ""), (8, c + " x")], key=str)


CLASHES = ["weight", "block", "slot", "mix_position", "n_words", "lost", "kept", "clean_text", "score", "rejected", "lang_pred", "key", "n", "s1", "component", "_near_key", "_near_at", "_mix_src", "Score", "_rest", "a.b", "_group", "_position", "sequence_id", "piece"]


def test_columns_of_any_name_pass_through(spark):
    base = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40)
    names = [c for c in CLASHES if c != "Score"]
    docs = base.select("*", *[F.concat(F.lit(c), F.col("doc_id")).alias(c) for c in names])
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns, name
        got = out.collect()
        assert got and all(r[c] == f"{c}{r.doc_id}" for r in got for c in names), name
        docs = spark.createDataFrame(got, docs.schema)
    assert P.packing(spark, docs, "").count()


def test_mixing_shuffles_texts_once_and_sorts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = P.mixing(spark, docs, "")._jdf.queryExecution().executedPlan().toString()
    wide = [x for x in plan.splitlines() if "Exchange" in x and "_rest" in x]
    assert len(wide) <= 2


def test_sequences_follow_the_mixed_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(K, "GROUP_PIECES", 1000)
    n, first = {"a": 3600, "b": 1600, "c": 400}, {"a": 0, "b": 10**5, "c": 10**6}
    rows = [(i, s, f"{s} " * (1 + i % 300)) for s, k in n.items() for i in range(first[s], first[s] + k)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(7, "text")
    mixed = P.mixing(spark, docs, "")
    mixed.write.parquet(str(tmp_path / "mixed"))
    source, size = {r[0]: r[1] for r in rows}, len(rows)
    target = {s: k**0.5 / sum(x**0.5 for x in n.values()) for s, k in n.items()}
    # a stretch has about 933 documents; c has 1/6 of the slots, so its 400 rows last for two whole stretches
    for given in (spark.read.parquet(str(tmp_path / "mixed")), mixed):
        sequences = defaultdict(list)
        for r in P.packing(spark, given, "").collect():
            sequences[r.sequence_id].append(r.doc_id)
        order = [d for s in sorted(sequences) for d in dict.fromkeys(sequences[s])]
        assert len(order) == size
        place = {r.doc_id: i for i, r in enumerate(spark.read.parquet(str(tmp_path / "mixed")).orderBy(F.col("_metadata.file_path"), F.col("_metadata.row_index")).collect())}
        stretch = -(-size // 6)
        for k in range(6):
            assert {place[d] for d in order[k * stretch : (k + 1) * stretch]} == set(range(k * stretch, min((k + 1) * stretch, size)))
        for k in range(2):
            part = [source[d] for d in order[k * stretch : (k + 1) * stretch]]
            for s, share in target.items():
                assert abs(part.count(s) - share * len(part)) <= 2 * 64
