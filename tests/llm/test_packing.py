import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tidewrack.llm import packing as P

CODER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(text):
    return [*CODER.encode(text or "", add_special_tokens=False).ids, 2]


def check(rows, want, most):
    """rows: doc, piece, start, length, crc, sequence, offset"""
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r[0]].append(r)
        sequences[r[5]].append((r[6], r[3]))
    assert docs.keys() == want.keys()
    for d, pieces in docs.items():
        pieces.sort(key=lambda r: r[1])
        ids = want[d]
        assert [p[1] for p in pieces] == list(range(-(-len(ids) // most)))
        at = 0
        for p in pieces:
            assert p[2] == at and (len(pieces) == 1 or p[1] == 0 or p[3] == most)
            assert p[4] == zlib.crc32(np.array(ids[at : at + p[3]], "<u4").tobytes())
            at += p[3]
        assert at == len(ids)
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= most
    return len(sequences)


def test_query_against_tokenizers(spark):
    sf = "/root/testdata/sf0.001"
    want = {r.doc_id: ids_of(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = P.op5_best_fit_packing(spark, sf).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset").collect()
    used = check([tuple(r) for r in got], want, 1024)
    assert used <= 1.02 * sum(map(len, want.values())) / 1024 + 2


def test_odd_texts(spark):
    texts = [None, "", " ", "a", "  x", "x  ", "a  b 　c", "don't \t\r\n <|endoftext|> £5", "word " * 5000, "x" * 3000, "\n", "é à  ü 😀", "a", "a", " a", "z\x1c y\x85 w"]
    docs = spark.createDataFrame([(i, t, 7, 9) for i, t in enumerate(texts)], "doc_id long, text string, length int, `group` int")
    pieces = P.tokenize(docs, most=16)
    out = P.pack(pieces, most=16).collect()
    rows = [(r.doc_id, r.piece, r.start, r.length, zlib.crc32(r.ids), r.sequence_id, r.offset) for r in out]
    check(rows, {i: ids_of(t) for i, t in enumerate(texts)}, 16)
    assert out[0].group == 9
    assert P.pack(P.tokenize(docs.limit(0))).count() == 0


def test_clashing_names_and_equal_rows_spread(spark, monkeypatch):
    monkeypatch.setattr(P, "GROUP_PIECES", 50)
    docs = spark.createDataFrame([(None, "same", f"g{i}", i, "p") for i in range(600)], "doc_id long, text string, _group string, sequence_id long, _position string")
    out = P.pack(P.tokenize(docs), most=1024).collect()
    assert sorted(r["_group"] for r in out) == sorted(f"g{i}" for i in range(600))
    sizes = defaultdict(int)
    for r in out:
        sizes[r.sequence_id >> 32] += 1
    assert len(sizes) == 12 and max(sizes.values()) <= 2 * sorted(sizes.values())[6]


def test_null_and_repeated_ids_over_groups(spark, monkeypatch):
    monkeypatch.setattr(P, "GROUP_PIECES", 3)
    docs = spark.createDataFrame([(None, "some text")] * 5 + [(1, "other text here")] * 5, "doc_id long, text string")
    out = P.pack(P.tokenize(docs)).collect()
    assert len(out) == 10
    spans = defaultdict(list)
    for r in out:
        spans[r.sequence_id].append((r.offset, r.length))
    for s in spans.values():
        s.sort()
        assert s[0][0] == 0 and all(a[0] + a[1] == b[0] for a, b in zip(s, s[1:]))
