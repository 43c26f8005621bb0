import random

import numpy as np

from tidewrack.llm import language as L

WORDS = {"aa": "stone river walking under garden", "bb": "fjørd bjørk sømand ælde grød", "cc": "ciudad señor mañana pequeño año"}


def texts(lang, n, seed):
    r = random.Random(seed)
    return [" ".join(r.choices(WORDS[lang].split(), k=30)) + "." for _ in range(n)]


def test_learns_predicts_and_rejects(spark):
    rows = [(i, t, lang) for lang in WORDS for i, t in enumerate(texts(lang, 40, lang))]
    train = spark.createDataFrame([*rows, (1, None, "aa"), (2, "", "bb"), (3, "text", None)], "doc_id long, text string, lang string")
    model = L.fit(train)
    assert model["langs"] == ["aa", "bb", "cc"]
    tests = [(1, t, lang, 5.0) for lang in WORDS for t in texts(lang, 5, lang + "x")]
    odd = [(2, None, "und", 1.0), (3, "", "und", 1.0), (4, "123 !? 456", "und", 1.0), (None, "qqq zzz xxx vvv kkk" * 3, "far", 1.0), (6, " ".join(texts("aa", 3000, 9)), "aa", 1.0)]
    docs = spark.createDataFrame(tests + odd + tests, "doc_id long, text string, want string, score double")
    got = L.predict(docs, model).collect()
    assert len(got) == 2 * len(tests) + len(odd)
    for r in got:
        assert 0 <= r.score <= 1
        if r.want == "far":
            assert r.rejected and r.lang_pred in WORDS
        else:
            assert r.lang_pred == r.want and r.rejected == (r.want == "und")


def test_nothing_to_learn_or_predict(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = L.fit(empty)
    one = L.predict(spark.createDataFrame([(1, "words", None)], empty.schema), model).collect()
    assert one[0].lang_pred == "und" and one[0].rejected and one[0].score == 0
    assert L.predict(empty, model).count() == 0


def test_vectors_match_plain_counting():
    texts = ["Ab c", "", "é1é", "abc"]
    counts, has = L.vectors(texts)
    assert has.tolist() == [True, False, True, True]
    # " ab c ": letters 3, pairs with a letter 5 (" a","ab","b "," c","c "), triples around a letter 3
    assert counts.sum(axis=1).tolist() == [11, 0, 2 + 4 + 2, 3 + 4 + 3]
    assert np.array_equal(L.vectors(["abc"])[0][0], counts[3])


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    want = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    got = [r for r in L.op1_language_id(spark, sf).collect() if r.held_out]
    assert sum(want[r.doc_id] == r.lang_pred for r in got) >= 0.97 * len(got)


def test_copies_neither_hide_a_language_nor_fill_the_sample(spark, monkeypatch):
    monkeypatch.setattr(L, "SAMPLE", 30)
    rows = [(t, "aa") for t in texts("aa", 10, 1)] + [(texts("aa", 1, 7)[0], "aa")] * 4000
    rows += [(t, "bb") for t in texts("bb", 100, 2)] + [(texts("bb", 1, 8)[0], "bb")] * 500
    train = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    assert L.fit(train)["langs"] == ["aa", "bb"]
    drawn = [(r.lang, r.text) for r in L.draw(train).collect()]
    assert len(set(drawn)) == len(drawn)
    assert {x for x in drawn if x[0] == "aa"} == {(k, t) for t, k in rows if k == "aa"}
    assert sum(k == "bb" for k, _ in drawn) == 30


def test_frequencies_and_reach_cover_all_rows(spark, monkeypatch):
    monkeypatch.setattr(L, "SAMPLE", 8)
    rows = [(t, lang) for lang in WORDS for t in texts(lang, 200, lang + "y")] + [("stone qqq zzz", "aa")] * 3
    train = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    model = L.fit(train)
    counts, _ = L.vectors([t for t, _ in rows])
    idf = np.log((1 + len(rows)) / (1 + (counts > 0).sum(axis=0))) + 1
    assert np.allclose(model["idf"], idf, atol=1e-5)
    x = L._weigh(counts, model["idf"])
    for i, lang in enumerate(model["langs"]):
        mine = x[[k == lang for _, k in rows]]
        far = 1 - (mine @ model["centers"][model["owner"] == i].T).max(axis=1)
        assert abs(model["reach"][i] - L.REJECT_MARGIN - np.quantile(far, L.REJECT_QUANTILE, method="higher")) <= 1 / L.BINS + 1e-5
