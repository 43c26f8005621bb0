from collections import Counter

from tidewrack.llm import mixing as M

SCHEMA = "doc_id long, source string, slot string, text string"


def test_deviation_is_below_one_block(spark):
    docs = spark.createDataFrame([(i, f"s{i % 3}", "x", "t") for i in range(900)], SCHEMA)
    out = M.mix_sources(docs, {"s0": 5, "s1": 3, "s2": 2}, block_rows=4, resolution=10).collect()
    assert len(out) == 900 and sorted(r.mix_position for r in out) == list(range(900))
    blocks = {(r.source, r.block): (r.slot, r.weight) for r in out}
    assert all(r.release <= r.slot < r.deadline for r in out)
    assert len({s for s, _ in blocks.values()}) == len(blocks)
    done, slots = Counter(), {s: k[0] for k, (s, _) in blocks.items()}
    weights = {k[0]: w for k, (_, w) in blocks.items()}
    left = Counter(k[0] for k in blocks)
    for t in range(max(slots) + 1):
        if t in slots:
            done[slots[t]] += 1
        for s, w in weights.items():
            if done[s] < left[s]:
                assert abs(done[s] - (t + 1) * w / 10) < 1
    assert [r.slot for r in sorted(out, key=lambda r: r.mix_position)] == sorted(r.slot for r in out)


def test_nulls_repeats_and_empty(spark):
    data = [(None, None, "a", "x"), (None, None, "a", "x"), (1, "s", None, None), (1, "s", None, None), (2, "only", "b", "")]
    out = M.mix_sources(spark.createDataFrame(data, SCHEMA)).collect()
    assert len(out) == 5 and sorted(r.mix_position for r in out) == [0, 1, 2, 3, 4]
    assert M.mix_sources(spark.createDataFrame([], SCHEMA)).count() == 0


def test_absent_zero_and_unnamed_weights(spark):
    docs = spark.createDataFrame([(i, f"s{i % 3}", "x", "t") for i in range(90)] + [(99, None, "x", "t")], SCHEMA)
    for weights, last in (({"none": 1}, {"s0", "s1", "s2", None}), ({"s0": 2, "s1": 0, "gone": 5}, {"s1", "s2", None}), ({None: 1, "s2": 1}, {"s0", "s1"}), ({}, {"s0", "s1", "s2", None})):
        out = sorted(M.mix_sources(docs, weights, block_rows=4).collect(), key=lambda r: r.mix_position)
        assert [r.mix_position for r in out] == list(range(91))
        tail = sum(r.source in last for r in out)
        assert all(r.source in last for r in out[91 - tail :])
        assert [r.slot for r in out] == sorted(r.slot for r in out)


def test_skewed_source_over_buckets(spark, monkeypatch):
    monkeypatch.setattr(M, "ROWS_PER_BUCKET", 10)
    docs = spark.createDataFrame([(i, "hot" if i % 3 else f"s{i % 5}", "x", "t") for i in range(600)], SCHEMA)
    out = M.mix_sources(docs, block_rows=5).collect()
    assert sorted(r.mix_position for r in out) == list(range(600))
    assert max(Counter((r.source, r.block) for r in out).values()) == 5
