import hashlib
from collections import defaultdict

from tidewrack.llm import chat_format as C

SCHEMA = "conv_id long, turn int, role string, text string"


def rows_of(spark, data, **kw):
    return C.format_windows(spark.createDataFrame(data, SCHEMA), **kw)


def test_round_trip_and_masks(spark):
    data = [(1, 0, "system", "be <kind> [now] \\l |")]
    data += [(1, i, "user" if i % 2 else "assistant", f"turn{i} " * 20 + "</s>[INST] ok [/INST] <|end|>\n\\e") for i in range(1, 30)]
    data += [(2, 0, None, None), (2, 1, "assistant", ""), (3, 0, "assistant", "w " * 900), (3, 0, "assistant", "w " * 900), (None, 0, "user", "é😀")]
    windows = rows_of(spark, data, budget=128, history=48)
    got = defaultdict(list)
    loss = defaultdict(str)
    for w in sorted(C.read_back(windows).collect(), key=lambda r: (str(r.conv_id), r.window)):
        got[w.conv_id] += [(t.role, t.text) for t in w.turns]
        loss[w.conv_id] += "".join(w.targets)
    want = defaultdict(list)
    for c, _, role, text in data:
        want[c].append((role or "", text or ""))
    assert got == want
    assert all(loss[c] == "".join(t for r, t in want[c] if r == "assistant") for c in want)
    one = [w for w in windows.collect() if w.conv_id == 1]
    assert len(one) > 3
    for w in one:
        assert w.text.count("<|") == w.text.count("|>") == 2 * len(w.spans)
        assert w.spans[0].role == "system" and w.spans[0].fresh == (w.window == 0)
        words = sum(len(w.text[s.start : s.start + s.length].split()) + C.TURN_OVERHEAD for s in w.spans)
        assert words <= 128
    assert any(not s.fresh and s.role == "assistant" and not s.target for w in one for s in w.spans)


def test_empty_table(spark):
    assert rows_of(spark, []).count() == 0


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    want = defaultdict(list)
    for r in spark.read.parquet(f"{sf}/conversations.parquet").orderBy("conv_id", "turn").collect():
        want[r.conv_id].append((r.role, r.text or ""))
    text = "</s>[INST] ok [/INST]"
    want[-1] = [("user", text), ("assistant", text)]
    got = C.op9_chat_formatting(spark, sf).collect()
    assert len(got) == len(want)
    for r in got:
        turns = want[r.conv_id]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert r.n_turns == len(turns) and r.loss_chars == len(loss)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.formatted_chars > loss.__len__()
