"""Best-fit packing of tokenised documents by the sum-of-squares rule.

A document's tokens end with one separator.  Documents longer than a sequence
are cut into full-length pieces, of which the first may be shorter, so a
document leaves at most one piece that is not full.  Full pieces are sequences
already.  The others are dealt at random (by a hash of their place in the table,
so equal rows spread as well) to groups of about `GROUP_PIECES`; each group places its pieces, longest first,
in the open bin that leaves the sum over residual gaps of the squared number of
open bins smallest; a bin is opened only where none fits (letting the rule open
bins as well took 1.7 % more sequences).  Groups are independent, so the work
spreads over the cluster; each leaves a few open bins.

Where the order of documents matters, `pack` takes their positions: groups are
then stretches of successive documents, of which each leaves at most one piece
that is not full, and a sequence is numbered by its first document's position,
so that sequences of a stretch hold its documents alone and follow those of the
stretch before.

`tokenize` maps texts to pieces; `pack` places pieces of given lengths and
passes other columns through, so that it moves ids only if asked to.

Defined cases: a null text is empty and becomes the separator alone; null or
repeated ids are separate documents; of pieces of equal length the earlier in its
group is placed first, and of residual gaps that serve equally well the smallest
is taken; a very long text is encoded whole by one task, in memory for some
thirty times its size; an empty table gives an empty result; other columns pass
through, and the added columns replace any of the same name.
"""

from __future__ import annotations

import base64
import math
import re
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import tokens
from .common import fresh_name, stored

MAX_TOKENS = 1024
SEPARATOR = 2
#: The vocabulary's one special token; its id follows the ranks.
SPECIAL = "<|endoftext|>"
#: Pieces placed by one task call; a bound on its memory, not on the input.
GROUP_PIECES = 20_000
#: Distinct stretches of text whose ids a worker keeps at hand, about.
POOL_STRETCHES = 500_000


@cache
def _encoding(path: str):
    """A BPE of `path`'s ranks whose pieces split as in byte-level BPE, and each id's length in bytes."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
    for piece, i in ranks.items():
        lengths[i] = len(piece)
    coder = tiktoken.Encoding("documents", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={SPECIAL: max(ranks.values()) + 1})
    return coder, lengths


class _Pool:
    """Ids of stretches met so far by this worker, by hash; emptied when full."""

    def __init__(self):
        self.keys, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        self.starts, self.ends = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)

    def add(self, keys: np.ndarray, ids: np.ndarray, stops: np.ndarray) -> None:
        at = np.searchsorted(self.keys, keys)
        ends = len(self.ids) + stops
        self.starts = np.insert(self.starts, at, np.concatenate([[len(self.ids)], ends[:-1]]))
        self.ends = np.insert(self.ends, at, ends)
        self.keys = np.insert(self.keys, at, keys)
        self.ids = np.concatenate([self.ids, ids.astype(np.uint32)])


_POOLS: dict[str, _Pool] = {}


def _ids(data: np.ndarray, offsets: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """All documents' token ids, one after another, and where each document's begin.

    No token holds a space after a non-space, so the text may be cut before any
    space that follows a non-space.  Each distinct stretch (spaces, then
    non-spaces) is encoded once, and its ids are copied to its other places.
    """
    coder, lengths = _encoding(path)
    n = len(offsets) - 1
    if not len(data):
        return np.zeros(0, np.uint32), np.zeros(n + 1, np.int64)
    space = tokens._SPACE[data]
    solid = (data > 0x20) & (data < 0x7F)
    solid[1:] |= data[:-1] == 0xC3  # U+00C0 to U+00FF
    cut = np.zeros(len(data), dtype=bool)
    cut[1:] = space[1:] & solid[:-1]
    begins = offsets[:-1][np.diff(offsets) > 0]
    cut[begins] = True
    view = data.tobytes()
    special = {int(np.searchsorted(offsets, m.start(), side="right")) - 1 for m in re.finditer(re.escape(SPECIAL.encode()), view)}
    for i in special:  # such a document stays in one piece
        cut[offsets[i] + 1 : offsets[i + 1]] = False
    start = np.flatnonzero(cut)
    end = np.append(start[1:], len(data))
    # documents' first stretches may lack the space, and last ones may lack the rest: encode these on their own
    plain = space[start] & ~space[end - 1]
    plain[np.searchsorted(start, offsets[sorted(special)])] = False
    hashes = tokens.word_hashes(data, start[plain], end[plain], fold=False)
    keys, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    pool = _POOLS.get(path)
    if pool is None or len(pool.keys) > POOL_STRETCHES:
        pool = _POOLS[path] = _Pool()
    at = np.flatnonzero(plain)[first]
    place = pool.find(keys)
    new = place < 0
    if new.any():
        spans = at[new]
        flat = coder.encode_to_numpy(b"".join([view[i:j] for i, j in zip(start[spans].tolist(), end[spans].tolist())]).decode())
        stops = np.searchsorted(np.cumsum(lengths[flat]), np.cumsum(end[spans] - start[spans]), side="left") + 1
        pool.add(keys[new], flat, stops)
        place = pool.find(keys)
    flat, known_starts, known_ends = pool.ids, pool.starts, pool.ends
    other = np.flatnonzero(~plain)
    rest = [coder.encode(view[start[i] : end[i]].decode(), allowed_special={SPECIAL}) for i in other]
    flat_rest = np.asarray([x for r in rest for x in r], dtype=np.uint32)
    rest_ends = len(flat) + np.cumsum([len(r) for r in rest], dtype=np.int64)
    flat = np.concatenate([flat, flat_rest])
    starts, ends = np.empty(len(start), np.int64), np.empty(len(start), np.int64)
    starts[plain], ends[plain] = known_starts[place[inverse]], known_ends[place[inverse]]
    starts[~plain], ends[~plain] = np.concatenate([[len(flat) - len(flat_rest)], rest_ends])[: len(other)], rest_ends
    del other
    size = ends - starts
    reach = np.concatenate([[0], np.cumsum(size)])
    out = flat[np.arange(reach[-1]) + np.repeat(starts - reach[:-1], size)]
    return out, reach[np.searchsorted(start, offsets)]


def tokenize(
    docs: DataFrame, tokenizer: str | None = None, *, text: str = "text", most: int = MAX_TOKENS, separator: int = SEPARATOR
) -> DataFrame:
    """docs' other columns with piece, start, length and ids (unsigned little-endian 32-bit), a row per piece.

    `tokenizer` is a file of base64 tokens and ranks; by default the public byte-level BPE of 50k.
    """
    import public_tokenizers

    path = tokenizer or public_tokenizers.path("byte_bpe_50k.tiktoken")
    own = ("piece", "start", "length", "ids")
    kept = [f for f in docs.schema.fields if f.name not in (*own, text)]
    docs = docs.select(*[f.name for f in kept], text)
    schema = T.StructType(
        [*kept, T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType())]
    )

    def run(batches):
        for batch in batches:
            data, offsets = tokens.bytes_of(batch.column(text))
            for a, b in tokens.chunks(offsets):
                flat, at = _ids(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], path)
                n = b - a
                ids = np.full(len(flat) + n, separator, dtype="<u4")
                ids[np.arange(len(flat)) + np.repeat(np.arange(n), np.diff(at))] = flat
                at = at + np.arange(n + 1)
                total = np.diff(at)
                pieces = -(-total // most)
                row = np.repeat(np.arange(n), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                head = total - (pieces - 1) * most
                begin = np.where(piece == 0, 0, head[row] + (piece - 1) * most)
                length = np.where(piece == 0, head[row], most)
                edges = np.concatenate([[0], np.cumsum(length)])  # the pieces follow one another
                ids = pa.Array.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer((edges * 4).astype(np.int64)), pa.py_buffer(ids)]).cast(pa.binary())
                part = batch.slice(a, n).take(pa.array(row))
                columns = [part.column(f.name) for f in kept]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(piece, pa.int32()), pa.array(begin, pa.int64()), pa.array(length, pa.int64()), ids], names=schema.fieldNames()
                )
        tokens.release()

    return docs.mapInArrow(run, schema)


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece by the sum-of-squares rule, longest pieces first."""
    count = np.zeros(capacity + 1, dtype=np.int64)  # open bins by gap; full bins do not count
    bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    which, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    opened = 0
    for i in np.argsort(-lengths, kind="stable"):
        size = int(lengths[i])
        fits = count[size:capacity]
        lefts = np.flatnonzero(fits)
        if len(lefts):
            # growth of the sum from gap left + size to gap left; a filled bin just leaves it
            grows = np.where(lefts == 0, 0, 2 * count[lefts] + 1) - 2 * fits[lefts] + 1
            left = int(lefts[np.argmin(grows)])
            gap = left + size
            b = bins[gap].pop()
            count[gap] -= 1
        else:
            left, gap, b = capacity - size, capacity, opened
            opened += 1
        which[i], offset[i] = b, capacity - gap
        if left:
            bins[left].append(b)
            count[left] += 1
    return which, offset


def pack(
    pieces: DataFrame,
    *,
    most: int = MAX_TOKENS,
    length: str = "length",
    position: str | None = None,
) -> DataFrame:
    """pieces, a table that reads the same each time (stored, say), with sequence_id and offset.  Pieces of `most` tokens never leave their place.

    `position` names a column of documents' different places from 0 in an order to keep; pieces then need a column piece, as `tokenize` gives.
    """
    pieces = pieces.select([c for c in pieces.columns if c not in ("sequence_id", "offset")])
    # a text has less than 2^31 bytes, so its pieces' numbers fit in this many bits
    bits = 32 - most.bit_length()
    if position is None:
        own = -1 - F.monotonically_increasing_id()
    else:
        own = F.shiftleft(F.col(position), bits) + F.col("piece")
    whole = pieces.where(F.col(length) >= most).select("*", own.alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    short = pieces.where(F.col(length) < most)
    if position is None:
        groups = max(1, math.ceil(short.count() / GROUP_PIECES))
        key = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups))
    else:
        documents = (pieces.agg(F.max(position)).first()[0] or 0) + 1
        stretch = math.ceil(documents / math.ceil(documents / GROUP_PIECES))
        key = F.floor(F.col(position) / stretch)
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    n_fields = len(pieces.columns)
    own_group = fresh_name(pieces.columns, "_group")

    def run(table: pa.Table) -> pa.Table:
        group = table.column(own_group)[0].as_py()
        if position is not None:
            table = table.sort_by(position)
        which, offset = place(table.column(length).to_numpy().astype(np.int64), most)
        if position is None:
            number = which + (np.int64(group) << 32)
        else:
            first = np.unique(which, return_index=True)[1]
            number = (table.column(position).to_numpy().astype(np.int64)[first] << bits)[which]
        columns = [*table.columns[:n_fields], pa.array(number), pa.array(offset)]
        return pa.Table.from_arrays(columns, names=schema.fieldNames())

    placed = short.withColumn(own_group, key).groupBy(own_group).applyInArrow(run, schema)
    return whole.unionByName(placed)


def op5_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    pieces = tokenize(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(stored(pieces, "pieces"))
