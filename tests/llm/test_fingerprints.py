import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tidewrack.llm import fingerprints as P


def _hashes(shown):
    return {x.split("@")[0] for x in shown.split()}


def _jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = sorted(((r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()), reverse=True)
    got = {r.doc_id: r for r in P.op7_fingerprints(spark, sf).collect()}
    assert len(got) == len(docs)
    near_edited = near_next = 0
    for (d, text), (after, follow) in zip(docs, docs[1:] + docs[:1]):
        r, half = got[d], len(text) // 2
        edited = text[: len(text) - half] + follow[:half]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        places = [int(x.split("@")[1]) for x in r.fingerprint.split()]
        words = len(re.findall(r"[^\x20\x09-\x0D]+", text))
        grams = max(1, words - P.K + 1) if words else 0
        assert places == sorted(set(places)) and (not words or places)
        # every window of hashes holds a kept one
        for a, b in zip([-1, *places], [*places, grams]):
            assert b - a <= P.WINDOW or grams <= P.WINDOW
        near_edited, near_next = near_edited + r.near_edited, near_next + r.near_next
        own, changed, following = (_hashes(f) for f in (r.fingerprint, r.edited_fingerprint, got[after].fingerprint))
        assert (r.near_edited, r.near_next) == pytest.approx((_jaccard(own, changed), _jaccard(own, following)))
    assert near_edited > 4 * near_next


def test_minima_are_rightmost_and_match_plain_winnowing(spark):
    text = "to be or not to be that is the question " * 7 + "whether it is nobler in the mind to suffer"
    row = spark.createDataFrame([(text,)], "text string")
    hashes = row.select(F.transform(F.sequence(F.lit(0), F.lit(len(text.split()) - 3)), lambda i: F.xxhash64(*[F.get(F.split("text", " "), i + j) for j in range(3)])).alias("h")).first().h
    want, w = set(), 4
    for i in range(len(hashes) - w + 1):
        part = [(h & (2**64 - 1)) >> 31 for h in hashes[i : i + w]]
        want.add(i + max(j for j in range(w) if part[j] == min(part)))
    got = row.select(P.fingerprint_of(F.col("text"), 3, w).alias("f")).first().f
    assert list(zip(got.hashes, got.positions)) == [(hashes[i], i) for i in sorted(want)]


def test_match_guarantee_and_odd_texts(spark):
    shared = " ".join(f"s{i}" for i in range(P.K + P.WINDOW - 1))
    data = [(1, " ".join(f"a{i}" for i in range(99)) + f" {shared} x y z"), (2, f"q {shared} " + "b c d " * 50), (3, None), (4, ""), (5, " \n"), (6, "two words"), (None, "two  WORDS"), (8, "w " * 100_000)]
    docs = spark.createDataFrame([(a, b, 0) for a, b in data], "doc_id long, text string, fingerprint int").drop("fingerprint")
    got = {r.doc_id: set(r.fingerprint.hashes) for r in P.fingerprint(docs).collect()}
    assert got[1] & got[2] and not got[3] and not got[4] and not got[5]
    assert got[6] == got[None] and len(got[6]) == 1 and len(got[8]) == 1


def test_next_in_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(P, "ROWS_PER_BUCKET", 7)
    monkeypatch.setattr(P, "CELLS", 4)
    ids = [*range(0, 300, 3), 10**12, -5, 10**12 + 1, *range(5000, 5100)]
    for extra in ([], [None]):
        docs = spark.createDataFrame([(i, f"t{i}") for i in ids + extra], "doc_id long, text string")
        order = sorted(ids, reverse=True) + extra
        want = {d: f"t{n}" for d, n in zip(order, order[1:] + order[:1])}
        assert {r.doc_id: r.next.text for r in P.with_next(docs, ["text"]).collect()} == want
    same = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b")], "doc_id long, text string")
    assert P.with_next(same, ["text"]).count() == 3
    one = spark.createDataFrame([(7, "lone")], "doc_id long, text string")
    assert P.with_next(one, ["text"]).first().next.text == "lone"
    assert P.with_next(one.limit(0), ["text"]).count() == 0


def test_clashing_names_pass_through(spark):
    own = ["_bucket", "_cell", "_more", "_follow", "_head", "_head_key", "_next_text", "_First"]
    docs = spark.createDataFrame([(i, f"t{i}", -7, *range(len(own))) for i in range(5)], ["doc_id", "text", "next", *own])
    rows = P.with_next(docs, ["text"]).collect()
    assert len(rows) == 5
    for r in rows:
        assert [r[c] for c in own] == list(range(len(own))) and r.next.text == f"t{(r.doc_id - 1) % 5}"
