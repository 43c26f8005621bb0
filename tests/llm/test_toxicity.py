from collections import Counter

import numpy as np

from tidewrack.llm import toxicity as X


def test_grammar_tells_kinds_of_clauses_apart():
    g = X.Grammar()
    of = lambda text: {" ".join(m) for m in g.marks(text)}
    assert of("You are an idiot.") == {"insult directed"}
    assert of("An idiot, you.") == {"insult directed"}
    assert of("Such trash") == {"insult bare"}
    assert of("You are not an idiot.") == {"insult negated"}
    assert of("They wrote that the man was a moron") == {"insult reported"}
    assert of("We will kill. You") == {"threat bare"}
    assert of("I will hurt you!") == {"threat directed"}
    assert of("no. idiot") == {"insult bare"}
    assert of("idiotic idioms") == of("") == set()
    assert g.marks("scum " * 9)["insult", "bare"] == 9
    assert g.marks("idiot moron scum trash you") == {("insult", "directed"): 4}
    assert g.marks("You scum trash, idiot; moron clown") == {("insult", "directed"): 3, ("insult", "bare"): 2}
    assert of("not an idiot, you") == {"insult negated"}


def docs_of(spark, data):
    return spark.createDataFrame(data, "doc_id long, text string, score string")


def test_learns_words_from_several_contexts(spark):
    bad = [(i, f"{chr(97 + i % 26)}a zorblax b{chr(97 + i % 26)}. filler words here", "x") for i in range(30)]
    copies = [(100 + i, "quorb same copy text", "x") for i in range(30)]
    good = [(200 + i, f"plain filler {chr(97 + i % 26)} words here same copy text", "x") for i in range(60)]
    docs = docs_of(spark, bad + copies + good)
    labels = spark.createDataFrame([(r[0], 1) for r in bad + copies] + [(r[0], 0) for r in good] + [(1, 1), (500, None)], "doc_id long, toxic int")
    grammar, weights = X.fit(docs, labels)
    assert grammar.of("zorblax")[0] == "insult" and grammar.of("quorb")[0] == "other" and grammar.of("filler")[0] != "threat"
    tests = [(1, None, "s"), (2, "", "s"), (None, "zorblax", "s"), (4, "a fine day", "s"), (4, "a fine day", "s"), (5, "you zorblax " * 50_000, "s")]
    got = X.score(docs_of(spark, tests), grammar, weights).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    by = {r.text: r.score for r in got}
    assert by[None] == by[""] == by["a fine day"] < 0.5 < 0.7 < by["zorblax"] <= by["you zorblax " * 50_000]


def test_without_labels_or_rows(spark):
    docs = docs_of(spark, [])
    grammar, weights = X.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert np.allclose(weights[:-1], list(X.PRIOR.values()))
    assert X.score(docs, grammar, weights).count() == 0


def test_scores_against_plain_reading(spark):
    """Marks of every text by another route: clause by clause, without machines."""
    def plain(g, text):
        found = Counter()
        clause = []
        for w in [*X._TOKEN.findall((text or "").lower()), "."]:
            if w not in X._CLAUSE_ENDS:
                clause.append(w)
                continue
            kinds = ["quote" if x in X._QUOTES else g.of(x)[0] for x in clause]
            held = [g.of(x)[1] for x, k in zip(clause, kinds) if k in ("insult", "threat")]
            for i, k in enumerate(kinds):
                if k in ("insult", "threat"):
                    near = [j for j in range(i) if kinds[j] == "negation"]
                    how = "negated" if near and i - near[-1] <= 4 else "reported" if {"reported", "quote"} & set(kinds[:i]) else "directed" if "target" in kinds else "bare"
                    found[k, how] += max(held)
            clause = []
        return found

    sf = "/root/testdata/sf0.01"
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    g = X.Grammar({"the": 0.5, "und": 0.25}, {"ingt": 2.0})
    for text in texts[:300]:
        assert g.marks(text) == plain(g, text)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    want = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = [r for r in X.op10_toxicity(spark, sf).where("held_out").collect() if r.doc_id in want]
    caught = sum(r.predicted for r in got if want[r.doc_id])
    assert caught >= 0.9 * sum(want[r.doc_id] for r in got)
    assert sum(r.predicted for r in got if not want[r.doc_id]) <= 0.01 * len(got)
