"""Language-model scores by a weighted backoff automaton over n-grams.

States are the contexts of up to `order` - 1 words seen in training, among them
the start of a text and the empty context.  A state h has an arc for every word
w seen after it, of weight log10 of (c(h w) + mu * p(w | h')) / (c(h) + mu), to
the longest end of h w that is a state; h' is h without its first word.  Its
failure arc, of weight log10 of mu / (c(h) + mu), leads to h'.  The arcs of the
empty state weigh p(w) = (c(w) + 1) / (N + V + 1), also for words never seen.
(These are Dirichlet-smoothed counts over add-one smoothed word counts; each
state's arcs, with those its failure arc leads to, sum to one.)  A text is
traversed once from left to right: it carries the state, follows failure arcs
until the state has an arc for the word, and adds up the weights of all arcs
taken.  An end symbol is a word like the others, and the last.

No task holds the whole automaton.  Documents are dealt to blocks of about
`BLOCK_BYTES` of text, each text compressed on its own for the shuffle that all
rounds read.  A block lists its distinct words and pairs, as sorted
63-bit hashes with its training counts, and sends a slice of the list to each of
`FAN` ranges of hashes.  There the counts of up to `FAN` blocks are added up; where
there are more blocks, the sums are cut in `FAN` finer slices each and meet the
sums of other groups of blocks, and so on.  So a task never adds up more than
about one block's worth, and rows grow in proportion to the blocks (times the
number of such levels, the logarithm of the blocks to base `FAN`).  Totals come
back the same way, and each block builds the states and arcs that its documents
can touch.  N and V come along as sums over ranges.  Longer n-grams follow, a round for each length,
but only where training texts of other blocks hold both n-grams of one word less
inside; of the others the block has all there are, so its own count is the total.

In a block all texts are traversed together, in lanes of `LANE` words, each
started `order` - 1 words early from the empty state: the state depends on no
more words than that, so a lane starts with the state that the text has there.

Defined cases: a null text is empty and is the end symbol alone; a null
training mark counts as held out; repeated rows are rows of their own; an empty
table gives an empty result; without training rows every word has p = 1; a very
long text is one block's, held whole in memory some thirty times its size; other
columns pass through, and the added columns replace any of the same name, as do
`_lm_train` and `_lm_block`, which are then dropped.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import tokens
from .common import crc_bucket, crc_bucket_sql

#: Text per block; a task holds a block's texts and its part of the automaton.
BLOCK_BYTES = 8 << 20
#: Blocks whose counts meet in one task, and ranges of hashes that a list is cut in.
FAN = 4096
#: Words that a lane of the traversal scores.
LANE = 256
ORDER = 3
MU = 30.0
_START, _END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
_ODD = np.uint64(1)
ADDED = T.StructType(
    [T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()), T.StructField("train_tokens", T.LongType())]
    + [T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())]
)
_OWN = ("_lm_train", "_lm_block")
_COUNTS = "node int, slice long, keys binary, counts binary"
#: Levels sent in the first round; each later round sends one more.
_FIRST = 2
_TOTALS = "node int, slice long, totals binary, vocabulary long, tokens long"


def symbols(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A start, the words and an end of each document, as hashes; each one's place in its document; its document."""
    data, offsets = tokens.bytes_of(column)
    n = len(offsets) - 1
    found, size = [], np.zeros(n, np.int64)
    for a, b in tokens.chunks(offsets):
        start, end, doc = tokens.words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        hashes = tokens.word_hashes(data[offsets[a] : offsets[b]], start, end)
        size[a:b] = np.bincount(doc, minlength=b - a)
        symbol = np.full(len(hashes) + 2 * (b - a), _END, np.uint64)
        symbol[np.arange(len(hashes)) + 2 * doc + 1] = hashes
        symbol[np.cumsum(size[a:b] + 2) - size[a:b] - 2] = _START
        found.append(symbol)
    owner = np.repeat(np.arange(n), size + 2)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(size + 2) - size - 2, size + 2)
    return np.concatenate(found) if found else np.zeros(0, np.uint64), place, owner


def levels(symbol: np.ndarray, place: np.ndarray, order: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For n = 1 to order: the distinct n-grams in order of hash, a place where each ends, and which ends at each symbol (or -1).

    Hashes of words are odd, all others even, the start's included.
    """
    out, key = [], symbol
    for n in range(1, order + 1):
        if n > 1:
            before = key[:-1]
            key = np.concatenate([key[:1], tokens.mix((before ^ (before >> np.uint64(31))) * tokens._BASE + symbol[1:])])
        ends = np.flatnonzero(place >= n - 1)
        hashed = key[ends] & ~_ODD
        if n == 1:
            hashed |= (place[ends] > 0).astype(np.uint64)
        by = np.argsort(hashed)
        hashed = hashed[by]
        fresh = np.ones(len(by), dtype=bool)
        fresh[1:] = hashed[1:] != hashed[:-1]
        at = np.full(len(symbol), -1, np.int32)
        at[ends[by]] = np.cumsum(fresh, dtype=np.int32) - 1
        out.append((hashed[fresh], ends[by[fresh]], at))
    return out


class Block:
    """The n-grams of a block's texts, with the counts of its training texts and, once they have come, the totals."""

    def __init__(self, table: pa.Table, text: str, order: int):
        self.symbol, self.place, self.owner = symbols(_texts(table.column(text)))
        self.grams = levels(self.symbol, self.place, order)
        self.offset = np.concatenate([[0], np.cumsum([len(g[0]) for g in self.grams])])
        train = table.column("_lm_train").combine_chunks().fill_null(False)
        known = np.asarray(train.to_numpy(zero_copy_only=False), dtype=bool)[self.owner]
        self.local = np.concatenate([np.bincount(at[known & (at >= 0)], minlength=len(keys)) for keys, _, at in self.grams])
        self.total = self.local.copy()

    def listed(self, turn: int) -> tuple[np.ndarray, np.ndarray]:
        """The hashes that a round sends, sorted, and their numbers among all n-grams."""
        if not turn:
            picked = np.arange(self.offset[min(_FIRST, len(self.grams))])
        else:
            n = turn + _FIRST
            first, shorter = self.grams[n - 1][1], self.grams[n - 2][2]
            elsewhere = (self.total > self.local)[self.offset[n - 2] : self.offset[n - 1]]
            picked = self.offset[n - 1] + np.flatnonzero(elsewhere[shorter[first - 1]] & elsewhere[shorter[first]])
        keys = np.concatenate([g[0] for g in self.grams])[picked]
        by = np.argsort(keys)
        return keys[by], picked[by]

    def send(self, node: int, turn: int, fan: int) -> pa.Table:
        keys, picked = self.listed(turn)
        return _slices(node, 0, _cuts(keys, fan, 1), keys, self.local[picked])

    def receive(self, answer: pa.Table, turns: int, fan: int) -> None:
        """Take the totals of the first `turns` rounds."""
        turn_of = np.asarray(answer.column("round"))
        for turn in range(turns):
            keys, picked = self.listed(turn)
            cuts = _cuts(keys, fan, 1)
            part = answer.filter(pa.array(turn_of == turn))
            for i, x in zip(part.column("slice").to_pylist(), part.column("totals")):
                self.total[picked[cuts[i] : cuts[i + 1]]] = _unpack(x.as_py())


_deflate, _inflate = zstandard.ZstdCompressor(level=1).compress, zstandard.ZstdDecompressor().decompress
#: Lowest bytes of the gaps between hashes that are sent as they are: they are noise, and the others mostly zeros.
_NOISE = 5


def _packed(text: str):
    """Batches with the column `text` compressed, text by text."""

    def run(batches):
        for batch in batches:
            i = batch.schema.get_field_index(text)
            yield batch.set_column(i, text, _pack_texts(batch.column(i)))

    return run


def _pack_texts(column: pa.Array) -> pa.Array:
    return pa.array([None if x is None else _deflate(x.encode()) for x in column.to_pylist()], pa.binary())


def _texts(packed: pa.ChunkedArray) -> pa.Array:
    return pa.array((x and _inflate(x) for x in packed.to_pylist()), pa.large_binary())


def _planes(values: np.ndarray) -> np.ndarray:
    """All lowest bytes, then all the next: small numbers then compress well."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T)


def _values(planes: np.ndarray, kind) -> np.ndarray:
    return np.ascontiguousarray(planes.reshape(8, -1).T).view(kind).ravel()


def _pack(counts: np.ndarray) -> bytes:
    return _deflate(_planes(counts).tobytes())


def _unpack(data: bytes) -> np.ndarray:
    return _values(np.frombuffer(_inflate(data), np.uint8), np.int64)


def _pack_keys(keys: np.ndarray) -> bytes:
    """Sorted hashes: how many, the low bytes of their gaps, and the high bytes compressed."""
    planes = _planes(np.diff(keys, prepend=np.uint64(0)))
    return len(keys).to_bytes(8, "little") + planes[:_NOISE].tobytes() + _deflate(planes[_NOISE:].tobytes())


def _unpack_keys(data: bytes) -> np.ndarray:
    high = 8 + _NOISE * int.from_bytes(data[:8], "little")
    return np.cumsum(_values(np.frombuffer(data[8:high] + _inflate(data[high:]), np.uint8), np.uint64), dtype=np.uint64)


def _cuts(keys: np.ndarray, fan: int, depth: int, first: int = 0) -> np.ndarray:
    """Where each of `fan` successive slices begins in sorted keys; there are fan ** depth slices of all hashes, and these begin with `first`."""
    place = ((keys >> np.uint64(32)) * np.uint64(fan**depth)) >> np.uint64(32)
    return np.searchsorted(place, np.arange(first, first + fan + 1, dtype=np.uint64))


def _slices(node: int, first: int, cuts: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> pa.Table:
    parts = [slice(a, b) for a, b in zip(cuts, cuts[1:])]
    return pa.table(
        {
            "node": pa.array(np.full(len(parts), node), pa.int32()),
            "slice": pa.array(np.arange(first, first + len(parts)), pa.int64()),
            "keys": pa.array([_pack_keys(keys[x]) for x in parts], pa.binary()),
            "counts": pa.array([_pack(counts[x]) for x in parts], pa.binary()),
        }
    )


def _added(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys of all rows, their counts added up, which of them each key of a row is, and where rows end."""
    keys = [_unpack_keys(x.as_py()) for x in table.column("keys")]
    distinct, which = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, which, np.concatenate([_unpack(x.as_py()) for x in table.column("counts")]))
    return distinct, total, which, np.cumsum([len(k) for k in keys])[:-1]


def _answer(table: pa.Table, values: np.ndarray, ends: np.ndarray, vocabulary: int, seen: int) -> pa.Table:
    whole = np.split(values, ends)
    return pa.table(
        {
            "node": table.column("node"),
            "slice": table.column("slice"),
            "totals": pa.array([_pack(x) for x in whole], pa.binary()),
            "vocabulary": pa.array(np.full(len(whole), vocabulary), pa.int64()),
            "tokens": pa.array(np.full(len(whole), seen), pa.int64()),
        }
    )


def totals(rows: DataFrame, nodes: int, fan: int, depth: int = 1) -> DataFrame:
    """For each row of counts (columns of _COUNTS, slices of `depth`) the totals over all nodes, with the range's words and tokens."""
    rows = rows.withColumn("parent", F.expr(f"cast(node div {fan} AS int)"))

    def finish(table: pa.Table) -> pa.Table:
        distinct, total, which, ends = _added(table)
        words = total[(distinct & _ODD) == _ODD]
        return _answer(table, total[which], ends, np.count_nonzero(words), words.sum())

    if nodes <= fan:
        return rows.groupBy("parent", "slice").applyInArrow(finish, _TOTALS)

    def merge(table: pa.Table) -> pa.Table:
        distinct, total, _, _ = _added(table)
        first = table.column("slice")[0].as_py() * fan
        return _slices(table.column("parent")[0].as_py(), first, _cuts(distinct, fan, depth + 1, first), distinct, total)

    def spread(table: pa.Table, answers: pa.Table) -> pa.Table:
        distinct, total, which, ends = _added(table)
        first = table.column("slice")[0].as_py() * fan
        cuts = _cuts(distinct, fan, depth + 1, first)
        for i, x in zip(answers.column("slice").to_pylist(), answers.column("totals")):
            total[cuts[i - first] : cuts[i - first + 1]] = _unpack(x.as_py())
        return _answer(table, total[which], ends, sum(answers.column("vocabulary").to_pylist()), sum(answers.column("tokens").to_pylist()))

    merged = rows.groupBy("parent", "slice").applyInArrow(merge, _COUNTS)
    above = totals(merged, math.ceil(nodes / fan), fan, depth + 1).withColumn("coarse", F.expr(f"slice div {fan}"))
    return rows.groupBy("parent", "slice").cogroup(above.groupBy("node", "coarse")).applyInArrow(spread, _TOTALS)


class Automaton:
    """States, arcs and failure arcs over the n-grams of a block that training texts hold.

    State 0 is the empty context; the gram number g of level n is state
    base[n] + g.  Arcs are sorted by state and word; those of the empty state are
    arrays by word, since it has one for every word.
    """

    def __init__(self, grams: list, counts: list[np.ndarray], mu: float, floor: float):
        order = len(grams)
        base = np.concatenate([[0, 1], 1 + np.cumsum([len(g[0]) for g in grams])])  # base[n] for level n
        self.words = len(grams[0][0])
        p = (counts[0] + 1) / floor
        self.empty_weight = np.log10(p)
        self.empty_next = np.where(counts[0] > 0, base[1] + np.arange(self.words), 0) if order > 1 else np.zeros(self.words, np.int64)
        fail_to, fail_weight, keys, weights, nexts = [np.zeros(1, np.int64)], [np.zeros(1)], [], [], []
        for n in range(1, order + 1):
            _, first, at = grams[n - 1]
            shorter = base[n - 1] + grams[n - 2][2][first] if n > 1 else np.zeros(self.words, np.int64)
            if n > 1:
                context = grams[n - 2][2][first - 1]
                p = (counts[n - 1] + mu * p[grams[n - 2][2][first]]) / (counts[n - 2][context] + mu)
                seen = counts[n - 1] > 0
                keys.append(((base[n - 1] + context) * self.words + grams[0][2][first])[seen])
                weights.append(np.log10(p[seen]))
                nexts.append((base[n] + np.arange(len(first)) if n < order else shorter)[seen])
            if n < order:
                fail_to.append(shorter)
                fail_weight.append(np.log10(mu / (counts[n - 1] + mu)))
        self.fail_to, self.fail_weight = np.concatenate(fail_to), np.concatenate(fail_weight)
        keys, weights, nexts = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (keys, weights, nexts))
        by = np.argsort(keys)
        self.arcs, self.weight, self.next = keys[by], weights[by], nexts[by]
        self.start = base[1] + grams[0][2][0] if order > 1 and len(grams[0][2]) else 0  # a block's first symbol is a start
        self.warm = order - 1

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states after one word from each state, and the weights of all arcs taken."""
        state, after, weight = state.copy(), np.empty_like(state), np.zeros(len(state))
        open_ = np.arange(len(state))
        while len(open_):
            s, w = state[open_], word[open_]
            at_end = s == 0
            done = open_[at_end]
            weight[done] += self.empty_weight[w[at_end]]
            after[done] = self.empty_next[w[at_end]]
            open_, s, w = open_[~at_end], s[~at_end], w[~at_end]
            key = s * self.words + w
            arc = np.minimum(np.searchsorted(self.arcs, key), len(self.arcs) - 1) if len(self.arcs) else np.zeros(len(key), np.int64)
            has = self.arcs[arc] == key if len(self.arcs) else np.zeros(len(key), bool)
            weight[open_[has]] += self.weight[arc[has]]
            after[open_[has]] = self.next[arc[has]]
            open_ = open_[~has]
            weight[open_] += self.fail_weight[s[~has]]
            state[open_] = self.fail_to[s[~has]]
        return after, weight

    def traverse(self, word: np.ndarray, place: np.ndarray, owner: np.ndarray, n: int, lane: int = LANE) -> np.ndarray:
        """The sum of weights of each of n documents."""
        begins = np.flatnonzero((place > 0) & ((place - 1) % lane == 0))  # first word that each lane scores
        stops = np.append(begins[1:], len(word))
        stops -= np.append(place[begins[1:]] == 1, [False])  # the start of the next document
        early = np.minimum(self.warm, place[begins] - 1)
        by = np.argsort(begins - early - stops, kind="stable")  # longest first
        begins, stops, early = begins[by], stops[by], early[by]
        at, length = begins - early, stops - begins + early
        state = np.where(place[at] == 1, self.start, 0)
        total = np.zeros(len(at), np.longdouble)
        for i in range(int(length[0]) if len(length) else 0):
            live = np.searchsorted(-length, -i, side="left")  # lanes longer than i
            state[:live], weight = self.step(state[:live], word[at[:live] + i])
            total[:live] += np.where(i < early[:live], 0.0, weight)
        out = np.zeros(n, np.longdouble)
        np.add.at(out, owner[begins], total)
        return out


def score_texts(docs: DataFrame, train, *, text: str = "text", order: int = ORDER, mu: float = MU, block_bytes: int = BLOCK_BYTES, fan: int = FAN, lane: int = LANE, keep_text: bool = True) -> DataFrame:
    """docs (without their text if not `keep_text`) with the columns of ADDED; `train` is a boolean Column that marks the texts to learn from."""
    names = {*ADDED.fieldNames(), *_OWN}
    docs = docs.select([c for c in docs.columns if c not in names])
    kept = docs.schema.fields
    docs = docs.withColumn("_lm_train", train)
    size = docs.agg(F.sum(F.octet_length(text)).alias("bytes")).first().bytes or 0
    blocks = max(1, math.ceil(size / block_bytes))
    block = F.pmod(F.xxhash64(*[f.name for f in kept if f.name != text and isinstance(f.dataType, T.AtomicType)], F.octet_length(text)), F.lit(blocks)).cast("int")
    dealt = docs.withColumn("_lm_block", block)
    packed = T.StructType([T.StructField(f.name, T.BinaryType()) if f.name == text else f for f in dealt.schema.fields])
    dealt = dealt.mapInArrow(_packed(text), packed)
    kept = [f for f in kept if keep_text or f.name != text]

    # (all columns each time, so that all rounds and the walk read one and the same shuffle)
    def first_round(table: pa.Table) -> pa.Table:
        out = Block(table, text, min(_FIRST, order)).send(table.column("_lm_block")[0].as_py(), 0, fan)
        tokens.release()
        return out

    def later_round(turn: int):
        def send(table: pa.Table, answer: pa.Table) -> pa.Table:
            block = Block(table, text, turn + _FIRST)
            block.receive(answer, turn, fan)
            out = block.send(table.column("_lm_block")[0].as_py(), turn, fan)
            del block
            tokens.release()
            return out

        return send

    grouped = dealt.groupBy("_lm_block")
    turns = max(1, order - _FIRST + 1)
    answers = totals(grouped.applyInArrow(first_round, _COUNTS), blocks, fan).withColumn("round", F.lit(0))
    for turn in range(1, turns):
        sent = grouped.cogroup(answers.groupBy("node")).applyInArrow(later_round(turn), _COUNTS)
        answers = answers.unionByName(totals(sent, blocks, fan).withColumn("round", F.lit(turn)))
    schema = T.StructType([*kept, *ADDED.fields])

    def walk(table: pa.Table, answer: pa.Table) -> pa.Table:
        n = table.num_rows
        block = Block(table, text, order)
        block.receive(answer, turns, fan)
        counts = np.split(block.total, block.offset[1:-1])
        seen = sum(answer.column("tokens").to_pylist())
        automaton = Automaton(block.grams, counts, mu, np.float64(seen + sum(answer.column("vocabulary").to_pylist()) + 1))
        word = block.grams[0][2].astype(np.int64)
        score = automaton.traverse(word, block.place, block.owner, n, lane)
        real = block.place > 0
        base = np.add.reduceat(np.where(real, automaton.empty_weight[word], 0.0).astype(np.longdouble), np.flatnonzero(~real))
        found = (np.bincount(block.owner, minlength=n) - 1, np.bincount(block.owner[real & (counts[0][word] > 0)], minlength=n), np.full(n, seen))
        found = [*found, *[np.round(x.astype(float), 8) for x in (base, score)]]
        passed = [_texts(table.column(text)).cast(pa.string()) if f.name == text else table.column(f.name) for f in kept]
        out = pa.table(dict(zip(schema.fieldNames(), [*passed, *map(pa.array, found)])))
        del block, counts, automaton, word, real
        tokens.release()
        return out

    return grouped.cogroup(answers.groupBy("node")).applyInArrow(walk, schema)


def op2_lm_score(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", (crc_bucket(F.col("doc_id"), 7) == 2).alias("held_out"))
    scored = score_texts(docs, ~F.col("held_out"), keep_text=False)
    return scored.select("doc_id", "held_out", *ADDED.fieldNames())


ORACLE_OP2 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws,
    @held@ AS held_out FROM documents),
t AS (SELECT r, held_out, unnest(list_concat(ws, [chr(10)])) AS w, unnest(list_concat([' '], ws)) AS u,
      unnest(list_concat([NULL], list_concat([' '], ws)[1:len(ws)])) AS uu FROM d),
c1 AS (SELECT w, count(*) AS c FROM t WHERE NOT held_out GROUP BY w),
c2 AS (SELECT u, w, count(*) AS c FROM t WHERE NOT held_out GROUP BY u, w),
c3 AS (SELECT uu, u, w, count(*) AS c FROM t WHERE NOT held_out AND uu IS NOT NULL GROUP BY uu, u, w),
cu AS (SELECT w AS u, c FROM c1 UNION ALL SELECT ' ', count(*) FROM d WHERE NOT held_out),
s AS (SELECT sum(c)::BIGINT AS n, count(*)::BIGINT AS v FROM c1),
x AS (SELECT r, coalesce(c1.c, 0) AS c, coalesce(c3.c, 0) AS triple, coalesce(k2.c, 0) AS known2, (coalesce(c1.c, 0) + 1) / (n + v + 1)::DOUBLE AS p,
             (coalesce(c2.c, 0) + @mu@ * p) / (coalesce(cu.c, 0) + @mu@) AS p2, n
      FROM t CROSS JOIN s LEFT JOIN c1 ON c1.w = t.w LEFT JOIN c2 ON c2.u = t.u AND c2.w = t.w LEFT JOIN cu ON cu.u = t.u
      LEFT JOIN c3 ON c3.uu = t.uu AND c3.u = t.u AND c3.w = t.w LEFT JOIN c2 AS k2 ON k2.u = t.uu AND k2.w = t.u),
g AS (SELECT r, count(*) AS n_tokens, count(*) FILTER (c > 0) AS n_known, any_value(n) AS train_tokens,
        round(fsum(log10(p)), 8) AS base_score, round(fsum(log10((triple + @mu@ * p2) / (known2 + @mu@))), 8) AS score FROM x GROUP BY r)
SELECT doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score FROM g JOIN d USING (r)
""".replace("@held@", crc_bucket_sql("doc_id", 7) + " = 2").replace("@mu@", str(MU))
