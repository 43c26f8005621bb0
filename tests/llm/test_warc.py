import glob
import struct
from urllib.parse import urlparse

import pytest
import zstandard

from tidewrack.llm import warc as W
from tidewrack.llm.common import shared_dir, stored

SCHEMA = "page_id long, url string, html string, payload int"


def round_trip(spark, data, **kw):
    folder = shared_dir(spark, "warc-test")
    archives = stored(W.write_pages(spark.createDataFrame(data, SCHEMA), folder, **kw), "archives")
    assert sum(a.records for a in archives.collect()) == len(data)
    return W.read_pages(archives).collect(), folder


def test_round_trip_with_revisits(spark):
    big = "<p>é😀</p>" * 400_000
    data = [(1, "http://a/ü?x=1#y", "same", 0), (2, None, "same", 0), (3, "http://b", None, 0), (4, "c", "", 0), (5, "d", big, 0), (6, "e", "one\r\n\r\n", 0), (None, "f", "same", 0), (7, "g", "t", 0), (7, "g", "t", 0)]
    rows, _ = round_trip(spark, data)
    got = sorted((r.page_id if r.page_id is not None else -1, r.record_type, r.refers_to, r.payload_bytes, r.url) for r in rows)
    assert got == sorted([
        (1, "revisit", 2, 4, "http://a/ü?x=1#y"), (2, "response", None, 4, None), (3, "revisit", 4, 0, "http://b"), (4, "response", None, 0, "c"),
        (5, "response", None, len(big.encode()), "d"), (6, "response", None, 7, "e"), (-1, "response", None, 4, "f"), (7, "response", None, 1, "g"), (7, "response", None, 1, "g"),
    ])
    assert {r.page_id: r.payload for r in rows}[5] == big.encode()
    assert all(r.payload_digest == W.digest_of({1: b"same", 2: b"same", 5: big.encode()}[r.page_id]) for r in rows if r.page_id in (1, 2, 5))
    rows, _ = round_trip(spark, [(i, "u", "ab" if i < 3 else "longer", 0) for i in range(6)], least_bytes=3)
    assert sorted(r.record_type for r in rows) == ["response"] * 4 + ["revisit"] * 2


def test_empty_table(spark):
    rows, folder = round_trip(spark, [])
    assert rows == [] and not glob.glob(urlparse(folder).path + "/*")


def test_archive_format_and_faults():
    records = [W.page_record(i, "u", b"text %d " % i * 50, None) for i in range(40)]
    archive = W.write_archive(records)
    assert struct.unpack_from("<I", archive)[0] == W.DICTIONARY_MAGIC
    assert list(W.frames(archive)) == records
    extra = struct.pack("<II", 0x184D2A50, 3) + b"abc"
    assert list(W.frames(archive + extra)) == records
    plain = zstandard.ZstdCompressor().compress(records[0])
    assert list(W.frames(plain)) == records[:1]
    for broken in (archive[:-5], archive[:6], archive[:30], archive + b"garbage!!"):
        with pytest.raises(W.WarcError):
            list(W.frames(broken))
    one = records[0]
    for bad in (b"HTTP" + one, one.replace(b"WARC-Date", b"WARC-Dull"), one[:-1], one + b"x", one.replace(b"text 0", b"text 1"), one.replace(b"Content-Length: 3", b"Content-Length: x")):
        with pytest.raises(W.WarcError):
            W.page_of(*W.parse_record(bad))
