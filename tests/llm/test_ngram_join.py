import random
import re

import numpy as np
import pytest

from tidewrack.llm import ngram_join as J
from tidewrack.llm import signature_tree as S
from tidewrack.llm.components import components

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute(rows, k=4, percent=85):
    sets = [shingles(t, k) for _, t in rows]
    comp = list(range(len(rows)))

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    by = {}
    for i, s in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        for j in {j for x in s for j in by[x] if j < i}:
            both = len(s & sets[j])
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                comp[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted((str(d), len(sets[i]), str(least.get(find(i)))) for i, (d, _) in enumerate(rows))


def got(spark, rows, **kw):
    docs = spark.createDataFrame([(*r, 3) for r in rows], "doc_id long, text string, n int")
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in J.jaccard_components(docs, **kw).collect())


def edited(words, r, n):
    words = list(words)
    for _ in range(n):
        words[r.randrange(len(words))] = f"e{r.random()}"
    return " ".join(words)


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in J.op4_ngram_join(spark, sf).collect()) == brute(rows)


def test_odd_rows(spark):
    rows = [(5, "One two"), (3, "one TWO"), (None, "one two"), (7, None), (8, ""), (9, " \n"), (7, None), (1, "lone row here with words"), (2, "a b c d"), (4, "a b c d e"), (2, "other text under the id two"), (None, "null id only"), (10, "w " * 50_000), (11, "w w w w")]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == []


@pytest.mark.parametrize("group", [6, 2048])
def test_near_copies_and_shared_passages(spark, monkeypatch, group):
    monkeypatch.setattr(J, "GROUP_NODES", group)
    monkeypatch.setattr(J, "SET_NODES", group)
    r = random.Random(4)
    word = lambda: f"w{r.randrange(5000)}"
    base = [word() for _ in range(120)]
    passage = " ".join(word() for _ in range(55))
    rows = [(i, edited(base, r, r.randrange(6))) for i in range(40)]
    rows += [(100 + i, " ".join(word() for _ in range(r.randrange(40, 90))) + " " + passage) for i in range(40)]
    chain = [word() for _ in range(200)]
    for i in range(15):
        chain = edited(chain, r, 3).split()
        rows.append((300 - i, " ".join(chain)))
    for percent, k in ((85, 4), (80, 5), (60, 2)):
        assert got(spark, rows, percent=percent, k=k) == brute(rows, k, percent)


def sizes_of_sets(r):
    for n in (1, 3, 5, 6, 7, 9, 12, 20, 21, 33, 60, 140, 500, 3000):
        for _ in range(6):
            yield n + r.randrange(1 + n // 5)


@pytest.mark.parametrize("percent", [60, 80, 85, 95])
def test_alike_sets_share_a_part(percent):
    """At the threshold exactly: as many shingles differ as may, taken from either side."""
    r = random.Random(percent)
    for n in sizes_of_sets(r):
        for _ in range(4):
            a = {r.getrandbits(64) for _ in range(n)}
            b = set(a)
            while True:
                c = set(b)
                if r.random() < 0.6 and len(c) > 1:
                    c.remove(r.choice(sorted(c)))
                else:
                    c.add(r.getrandbits(64))
                if 100 * len(a & c) < percent * len(a | c):
                    break
                b = c
            if a == b:
                continue
            h = np.array(sorted(a) + sorted(b), np.uint64)
            sig, owner = J.part_signatures(h, np.array([0, len(a), len(a) + len(b)]), percent)
            both = set(sig[owner == 0].tolist()) & set(sig[owner == 1].tolist())
            end, _, most = J.intervals(percent)
            interval = int(np.searchsorted(end, min(len(a), len(b))))
            need = int(most[interval]) + 1 - (len(a) + len(b)) * (100 - percent) // (100 + percent)
            assert need >= 1
            both = [s for s in both if s & 127 == interval]
            assert len(both) >= need or any(s & 128 for s in both), (n, len(a), len(b))


def test_parts_of_texts_that_share_a_passage_do_not_meet():
    r = random.Random(2)
    passage = [r.getrandbits(64) for _ in range(50)]
    met = 0
    for _ in range(200):
        a, b = (sorted({*passage, *(r.getrandbits(64) for _ in range(r.randrange(150, 600)))}) for _ in range(2))
        sig, owner = J.part_signatures(np.array(a + b, np.uint64), np.array([0, len(a), len(a) + len(b)]), 85)
        met += bool(set(sig[owner == 0].tolist()) & set(sig[owner == 1].tolist()))
    assert met <= 4


def test_tree_loses_no_pair(monkeypatch):
    monkeypatch.setattr(S, "WINDOW", 256)
    r = random.Random(1)
    sets = []
    for _ in range(60):
        base = {r.getrandbits(64) for _ in range(r.choice((1, 3, 30, 200, 700)))}
        sets.append(base)
        sets.append({x for x in base if r.random() > 0.1} | {r.getrandbits(64)})
    leaves = []
    for i, s in enumerate(sets):
        width = S.width_of(len(s))
        bits = 0
        for x in s:
            if x % width < S.WINDOW:
                bits |= 1 << (x % width)
        leaves.append(S.leaf(i, len(s), bits, width, i))
    met = set()
    root = S.build(leaves)
    S.traverse(root, root, 70, lambda i, j: met.add((min(i, j), max(i, j))), lambda p, q: True)
    alike = {(i, j) for j in range(len(sets)) for i in range(j) if 100 * len(sets[i] & sets[j]) >= 70 * len(sets[i] | sets[j])}
    assert alike and alike <= met and len(met) < len(sets) ** 2 / 8


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(10, 40)] + [(100, 99), (101, 99), (5, 5)], "a long, b long")
    assert {(r.node, r.component) for r in components(edges).collect()} == {(i, 10) for i in range(10, 41)} | {(99, 99), (100, 99), (101, 99)}
    assert components(edges.limit(0)).count() == 0


def test_large_texts_with_a_common_passage_are_no_candidates(spark, monkeypatch):
    """Sizes at the lower end of an interval, at 80 percent: their parts are many and small."""
    seen = []
    by_bits = J.candidates_by_bits
    monkeypatch.setattr(J, "candidates_by_bits", lambda rows, percent: seen.append(by_bits(rows, percent)) or seen[-1])
    r = random.Random(5)
    end, _, _ = J.intervals(80)
    size = int(end[np.searchsorted(end, 3000)]) + 10
    word = lambda: f"w{r.getrandbits(40):x}"
    passage = [word() for _ in range(40)]
    texts = [[word() for _ in range(size + r.randrange(50))] + passage for _ in range(24)]
    texts.append([*texts[0][:-400], *(word() for _ in range(400))])  # alike
    texts.append([*texts[1][:-800], *(word() for _ in range(800))])  # not quite
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    assert got(spark, rows, k=5, percent=80) == brute(rows, 5, 80)
    assert seen[0].count() <= 2


def test_groups_of_the_same_nodes_meet_once(spark):
    rows = [(10 * s, n, n // 2) for s in range(40) for n in ((1, 2, 5) if s % 2 else (1, 5))]
    rows += [(7, 2, 1), (7, 3, 1)] + [(9, n, n) for n in (2, 3)]
    given = spark.createDataFrame(rows, "sig long, node long, component long").selectExpr("*", "cast(0 as int) AS mark")
    groups = J.distinct_groups(given).collect()
    assert sorted((g.size, g.times) for g in groups) == [(2, 1), (2, 20), (3, 20)]
    assert len({g.deal for g in groups if g.sig % 10 == 0}) == 1
