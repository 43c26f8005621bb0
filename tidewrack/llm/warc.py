"""WARC archives in Zstandard frames: a writer and a reader.

An archive opens with a skippable frame (magic 0x184D2A5D) that holds the
compression dictionary, itself a Zstandard frame; then comes one frame per
record, compressed with that dictionary.  The reader loads the dictionary from
the leading frame, decodes one frame at a time, and checks each record: the
version line, the fields a record must have, the block's declared length, the
two line ends after it, and block and payload digests.

Records with equal payloads are stored once: the one of the largest id is a
response, the rest are revisits that name it.  The groups are found from
digests alone, with combining aggregation, so a payload shared by a third of
the pages puts no third of the pages into one task.

Defined cases: a null payload is empty; a null url is left out; a null id gets
a record without a place among equals (always a response); repeated rows of the
largest id are all responses; an empty table writes no archive; columns other
than those named are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_dir, stored

DICTIONARY_MAGIC = 0x184D2A5D
#: Of each archive's first records at most so many, and bytes of each, go into its dictionary.
SAMPLE_RECORDS, SAMPLE_BYTES, DICTIONARY_BYTES = 64, 16_384, 32_768
#: An archive is closed at this size, about; it is the unit that is read back.
ARCHIVE_BYTES = 16 << 20
LEVEL = 3
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HEAD = re.compile(rb"WARC/1\.[01]\r\n")


class WarcError(ValueError):
    """A malformed archive or record."""


def digest_of(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("WARC-Block-Digest", "sha1:" + digest_of(block)), ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", "sha1:" + digest_of(payload)),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=-._~")))
    if refers_to is not None:
        fields += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", PROFILE)]
        return record(fields, http)
    return record(fields, http + payload)


def dictionary_frame(samples: list[bytes]) -> tuple[bytes, zstandard.ZstdCompressionDict]:
    """The skippable frame for a dictionary trained on samples, or of their raw bytes where they are too few."""
    try:
        data = zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        data = b"".join(samples)[:DICTIONARY_BYTES] or b"WARC/1.1\r\n"
    body = zstandard.ZstdCompressor(level=LEVEL).compress(data)
    return struct.pack("<II", DICTIONARY_MAGIC, len(body)) + body, zstandard.ZstdCompressionDict(data)


def write_archive(records: list[bytes]) -> bytes:
    frame, dictionary = dictionary_frame([r[:SAMPLE_BYTES] for r in records[:SAMPLE_RECORDS]])
    coder = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True)
    return b"".join([frame, *map(coder.compress, records)])


def frames(archive: bytes) -> Iterator[bytes]:
    """Each record's bytes.  The dictionary frame may be absent; other skippable frames are passed over."""
    at, view, dictionary = 0, memoryview(archive), None
    decoder = zstandard.ZstdDecompressor()
    while at < len(view):
        if len(view) - at < 8:
            raise WarcError("archive ends within a frame")
        magic, size = struct.unpack_from("<II", view, at)
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            body = view[at + 8 : at + 8 + size]
            if len(body) < size:
                raise WarcError("archive ends within a skippable frame")
            if magic == DICTIONARY_MAGIC and at == 0:
                data = bytes(body)
                if data[:4] == b"\x28\xb5\x2f\xfd":
                    data = zstandard.ZstdDecompressor().decompress(data)
                dictionary = zstandard.ZstdCompressionDict(data)
                decoder = zstandard.ZstdDecompressor(dict_data=dictionary)
            at += 8 + size
            continue
        one = decoder.decompressobj()
        parts = []
        try:
            while not one.eof and at < len(view):
                step = view[at : at + (1 << 20)]
                parts.append(one.decompress(step))
                at += len(step)
        except zstandard.ZstdError as e:
            raise WarcError(f"bad frame: {e}") from e
        if not one.eof:
            raise WarcError("archive ends within a record's frame")
        at -= len(one.unused_data)
        yield b"".join(parts)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Fields by lower-case name, and the block."""
    if not _HEAD.match(data):
        raise WarcError("no WARC version line")
    stop = data.find(b"\r\n\r\n")
    if stop < 0:
        raise WarcError("header without an end")
    fields = {}
    for line in data[:stop].decode().split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise WarcError(f"bad header line {line!r}")
        fields[name.strip().lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise WarcError(f"no {name}")
    if not fields["content-length"].isdigit():
        raise WarcError("bad content-length")
    size = int(fields["content-length"])
    block, rest = data[stop + 4 : stop + 4 + size], data[stop + 4 + size :]
    if len(block) != size or rest != b"\r\n\r\n":
        raise WarcError("content-length does not fit the record")
    if (want := fields.get("warc-block-digest")) and want != "sha1:" + digest_of(block):
        raise WarcError("block digest differs")
    return fields, block


def page_of(fields: dict[str, str], block: bytes) -> dict:
    """A page's row, from its record."""

    def page(name):
        value = re.fullmatch(r"<urn:page:(-?\d*)>", fields.get(name, ""))
        return int(value[1]) if value and value[1] else None

    head, gap, payload = block.partition(b"\r\n\r\n")
    length = re.search(rb"(?mi)^content-length: *(\d+)\r?$", head)
    if not gap or not length:
        raise WarcError("no HTTP header")
    size, digest = int(length[1]), fields.get("warc-payload-digest", "").removeprefix("sha1:")
    revisit = fields["warc-type"] == "revisit"
    if revisit:
        if payload or fields.get("warc-profile") != PROFILE or page("warc-refers-to") is None:
            raise WarcError("bad revisit record")
    elif len(payload) != size or digest_of(payload) != digest:
        raise WarcError("payload does not fit its length or digest")
    return {
        "page_id": page("warc-record-id"),
        "url": unquote(fields["warc-target-uri"]) if "warc-target-uri" in fields else None,
        "record_type": fields["warc-type"],
        "refers_to": page("warc-refers-to") if revisit else None,
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": None if revisit else payload,
    }


READ = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def write_pages(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write archives of page_id, url and html under the URI `folder`; a row per archive: path (a URI), records, bytes."""
    pages = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    digests = pages.where(F.octet_length("payload") >= least_bytes).select("page_id", F.sha1("payload").alias("digest"))
    groups = digests.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n")
    revisits = digests.join(groups, "digest").where("page_id <> refers_to").select(F.col("page_id").alias("revisit"), "digest", "refers_to").distinct()
    # a page id may be repeated with another payload, so the digest takes part in the match
    rows = pages.join(revisits, (F.col("page_id") == F.col("revisit")) & (F.sha1("payload") == revisits.digest), "left")

    def run(batches):
        import uuid

        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        held: list[bytes] = []

        def close():
            archive = write_archive(held)
            name = f"{uuid.uuid4().hex}.warc.zst"  # a retried task writes other files; only one attempt is reported
            with store.open_output_stream(f"{root}/{name}", compression=None) as out:
                out.write(archive)
            found = {"path": [f"{folder}/{name}"], "records": [len(held)], "bytes": [len(archive)]}
            held.clear()
            return pa.RecordBatch.from_pydict(found)

        size = 0
        for batch in batches:
            for page_id, url, payload, refers_to in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to"))):
                held.append(page_record(page_id, url, payload, refers_to))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    size = 0
                    yield close()
        if held:
            yield close()

    written = rows.select("page_id", "url", "payload", "refers_to").mapInArrow(run, "path string, records long, bytes long")
    return written


def read_pages(archives: DataFrame, tasks: int = 10_000) -> DataFrame:
    """Rows of READ from the archives at `path`, each archive read by one task; at most `tasks` at a time."""

    def run(batches):
        from pyarrow import fs

        for batch in batches:
            for uri in batch.column("path").to_pylist():
                store, path = fs.FileSystem.from_uri(uri)
                with store.open_input_file(path) as f:
                    archive = f.read()
                rows, size = [], 0
                for data in frames(archive):
                    rows.append(page_of(*parse_record(data)))
                    size += len(data)
                    if size >= 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    schema = pa.schema([(n, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[k]) for n, k in (x.split() for x in READ.split(", "))])
    dealt = archives.select("path").repartition(max(1, min(tasks, archives.count())), "path")
    return dealt.mapInArrow(run, READ)


def op6_warc(spark, sf_dir: str) -> DataFrame:
    archives = write_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"), shared_dir(spark, "warc"))
    pages = read_pages(stored(archives, "archives"))
    return pages.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_OP6 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
h AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS hex FROM p),
d AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS top,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + CAST('0b' || substr(bits, CAST(5 * i + 1 AS INT), 5) AS INT), 1)), '') AS b32
  FROM (SELECT *, array_to_string(list_transform(range(1, 41), lambda i: ['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011','1100','1101','1110','1111'][
    strpos('0123456789abcdef', substr(hex, CAST(i AS INT), 1))]), '') AS bits FROM h))
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, b32 AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> top THEN top END AS refers_to FROM d
"""
