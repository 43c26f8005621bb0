import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewrack.llm import lm_score as L

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, order=L.ORDER, mu=L.MU):
    split = [["<s>", *re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(FOLD)), None] for _, t, _ in rows]
    grams, after = Counter(), Counter()
    for ws, (_, _, train) in zip(split, rows):
        for i in range(1, len(ws)) if train else ():
            for n in range(min(order, i + 1)):
                grams[tuple(ws[i - n : i + 1])] += 1
                after[tuple(ws[i - n : i])] += 1
    total, distinct = after[()], sum(len(g) == 1 for g in grams)

    def p(history, w):
        if not history:
            return (grams[(w,)] + 1) / (total + distinct + 1)
        return (grams[(*history, w)] + mu * p(history[1:], w)) / (after[history] + mu)

    for ws in split:
        known = sum(grams[(w,)] > 0 for w in ws[1:])
        scores = [sum(math.log10(p(tuple(ws[max(0, i - n) : i]), ws[i])) for i in range(1, len(ws))) for n in (0, order - 1)]
        yield len(ws) - 1, known, total, *scores


@pytest.mark.parametrize("order, fan", [(3, 64), (3, 2), (1, 64), (4, 3)])
def test_against_brute_force_over_many_blocks(spark, order, fan):
    texts = ["The cat sat on the mat", None, "", "  \n", "the CAT\x0bsat", "dog", "dog", "ÄÖ äö 😀 the", "a b " * 2000, "the cat ran on the mat again " * 3]
    rows = [(i, t, i % 3 != 1) for i, t in enumerate(texts * 6)] + [(None, "null id", True), (None, "null mark", None)]
    docs = spark.createDataFrame([(*r, 1.5) for r in rows], "doc_id long, text string, train boolean, score double").withColumn("place", F.monotonically_increasing_id())
    got = {r.place: r for r in L.score_texts(docs, F.col("train"), order=order, block_bytes=9000, fan=fan, lane=5).collect()}
    assert len(got) == len(rows)
    for (_, r), want in zip(sorted(got.items()), brute(rows, order)):
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[:3]
        assert (r.base_score, r.score) == pytest.approx(want[3:], abs=1e-7)


def test_traversal_carries_the_longest_context_that_is_a_state():
    symbol, place, owner = L.symbols(pa.chunked_array([["a b c", "b c", "a b"]]))
    grams = L.levels(symbol, place, 3)
    counts = [np.bincount(at[(at >= 0) & (owner < 1)], minlength=len(keys)) for keys, _, at in grams]  # the first text is the training text
    automaton = L.Automaton(grams, counts, 1.0, 9.0)
    word = grams[0][2].astype(np.int64)
    state = np.array([automaton.start])
    for w in word[1:3]:  # "a b" from the start: a state of two words, whose failure arc leads to "b"
        state, _ = automaton.step(state, np.array([w]))
    assert automaton.fail_to[state[0]] == 1 + word[2] and automaton.fail_to[1 + word[2]] == 0
    state, _ = automaton.step(np.array([0]), word[2:3])
    assert state[0] == 1 + word[2]


def test_nothing_to_learn_or_score(spark):
    docs = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    r = L.score_texts(docs, F.lit(False)).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (3, 0, 0, 0.0, 0.0)
    assert L.score_texts(docs.limit(0), F.lit(True)).count() == 0


def test_held_out_texts_are_likelier_than_by_words_alone(spark):
    r = L.op2_lm_score(spark, "/root/testdata/sf0.01").where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert r.s > r.b
