"""N-gram Jaccard join: which documents' sets of word shingles are alike, without loss.

Documents with equal sets are one node; all work is on nodes.

1. One pass over the texts gives each document's set hash, its bitmap, and
   `BANDS` pairs of minima of its shingle hashes.
2. Nodes that share a pair of minima are compared by whole sets, in groups of
   bounded size, by a signature tree; nodes already linked to one another are not
   compared again, so a group of near copies costs little more than its size.
3. Parts of sets meet.  Sets of similar size that are alike differ in at most K
   shingles (K follows from the sizes and the threshold).  The range of shingle
   hashes is cut into over K parts, so at least one part of both is the same; a
   part's signature is a hash of all shingles in it.  A part holds several
   shingles, so documents that share just a passage, a line or a few frequent
   shingles do not meet, however many they are, and no frequencies are needed.
4. Nodes of different components that share a part are the candidates left, if
   they share as many as they must: of the parts of either at most as many differ
   as shingles may at the sizes of the two.  Groups of the same nodes meet once,
   and groups with the same smallest node in one task, within bounds.  They meet
   by bitmap in a signature tree, again only across components;
   groups too large for a task are met in pairs of chunks.  Pairs that may be
   similar are then compared by whole sets: first each component's likeliest pair,
   and after the components that this links have been joined, all pairs that are
   still of different ones.  Before whole sets are sent, bitmaps of whole sets
   are compared.
5. Components of all links.

Step 2 is a short cut; steps 3 to 5 would find the same components without it.
Sets are compared by 64-bit shingle hashes, nodes by 128 bits.

Parts (step 3).  Sizes are cut into intervals; a set emits the parts of its own
interval, and of the interval before it if a set in there may be alike.  With r
the upper end of the interval, two alike sets, the smaller in it, differ in at
most K = (r + r * 100 / percent) * (100 - percent) / (100 + percent) shingles.
Empty parts are not emitted: a set with over K parts that are not empty has
one that is as in the other set.  For the few sets with fewer, single shingles
of a prefix in the order of hashes are emitted besides, under a mark of their
own, which any two such sets share; they count only for pairs of sets that need
not share a part.  Sets so small that K is 0 have no partner.
A signature's lowest bits tell its interval and that mark; a pair counts in the
interval of its smaller set only.

Defined cases: a text without words, or null, has an empty set, is linked with
nothing and is its own component; a text of fewer words than a shingle has one
shingle, all its words; rows of equal texts are one node whatever their ids; a
component's id is its smallest non-null document id (null if it has none); an
empty table gives an empty result; other columns are not carried, so their names
do not matter.  A text's set is held whole by a task (8 bytes a word), however
long.
"""

from __future__ import annotations

from collections import Counter
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import signature_tree as S
from . import tokens
from .common import key_filter, stored
from .components import components

#: Pairs of minima of each set.
BANDS = 3
#: Nodes compared in one group: a larger one is met in pairs of chunks (step 4), or cut, differently for each pair of minima (step 2).
GROUP_NODES, SET_NODES = 2048, 4096
#: Upper end of an interval of sizes by its lower end, at least.
INTERVAL = 1.4
#: Of K differences, a set is cut into K + K / SPARE_PARTS + 2 parts: at 80 percent, too, nearly all sets have over K that are not empty.
SPARE_PARTS = 4
_SEEDS = [np.uint64(x) for x in (0, 0x2545F4914F6CDD1D, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


def _sets(batches, text: str, k: int):
    """For each batch and chunk of it: the batch's rows first to last, hashes, owners, and where each document's begin."""
    for batch in batches:
        data, offsets = tokens.bytes_of(batch.column(text))
        for a, b in tokens.chunks(offsets):
            part, at = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            start, end, doc = tokens.words(part, at)
            hashes, owner = tokens.shingles(tokens.word_hashes(part, start, end), doc, b - a, k)
            yield batch.slice(a, b - a), hashes, owner, np.searchsorted(owner, np.arange(b - a + 1))
    tokens.release()


def _set_hash(h: np.ndarray, at: np.ndarray, seed: int) -> np.ndarray:
    """A hash of each document's set, 0 for an empty one."""
    out = np.zeros(len(at) - 1, np.uint64)
    has = np.flatnonzero(np.diff(at))
    if len(has):
        out[has] = np.add.reduceat(tokens.mix(h ^ _SEEDS[seed]), at[:-1][has])
    return out


def describe(docs: DataFrame, key: str, text: str, k: int, percent: int) -> DataFrame:
    """key, n, s1, s2 (hash of the set), bands (hashes of pairs of minima), held (parts that are not empty, in its interval and in the one before) and bits of each document."""

    def run(batches):
        for part, h, owner, at in _sets(batches, text, k):
            n = np.diff(at)
            has = np.flatnonzero(n)
            first = at[:-1][has]
            bands = np.zeros((len(n), BANDS), np.uint64)
            for j in range(2 * BANDS if len(has) else 0):
                least = np.minimum.reduceat(h if j == 0 else tokens.mix(h ^ _SEEDS[j]), first)
                bands[has, j // 2] = tokens.mix(bands[has, j // 2] * tokens._BASE + least + np.uint64(j))
            held = np.zeros((len(n), 2), np.int32)
            for side, (docs_of, _, _, doc, _, first) in enumerate(_cut(h, at, percent)):
                held[docs_of, side] = np.bincount(doc[first], minlength=len(docs_of))
            # bitmaps, side by side
            width = np.array([S.width_of(x) for x in n.tolist()], dtype=np.int64)
            place = np.concatenate([[0], np.cumsum(np.minimum(width, S.WINDOW))]).astype(np.int64)
            flags = np.zeros(place[-1], dtype=bool)
            bit = (h & (width[owner] - 1).astype(np.uint64)).astype(np.int64)
            near = bit < S.WINDOW
            flags[place[owner[near]] + bit[near]] = True
            bits = np.packbits(flags, bitorder="little")
            listed = [pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel())) for x in (bands.view(np.int64), held)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(key), pa.array(n), *(pa.array(_set_hash(h, at, i).view(np.int64)) for i in (0, 1)), *listed,
                    pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer((place // 8).astype(np.int32)), pa.py_buffer(bits)]),
                ],
                names=["key", "n", "s1", "s2", "bands", "held", "bits"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"key {kind}, n long, s1 long, s2 long, bands array<long>, held array<int>, bits binary")


#: A signature's bits for the number of its interval, and for the mark of single shingles.
_INTERVAL_BITS, _LOOSE = 127, 128


@cache
def intervals(percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each interval of sizes up to 2^31: upper end, largest size of a partner, and K (see above)."""
    ends, low = [], 1
    while not ends or ends[-1] < 1 << 31:
        ends.append(max(int(INTERVAL * low), 100 * low // percent))
        low = ends[-1] + 1
    end = np.array(ends, dtype=np.int64)
    partner = 100 * end // percent
    return end, partner, (end + partner) * (100 - percent) // (100 + percent)


def _cut(h: np.ndarray, at: np.ndarray, percent: int):
    """For each set's own interval, then the one before it: the documents with parts there, their intervals, and of their shingles the place in h, the document's number, the part, and where each part begins."""
    n = np.diff(at)
    end, partner, most = intervals(percent)
    own = np.searchsorted(end, n)
    for which, before in ((own, n > 0), (own - 1, (own > 0) & (n <= partner[own - 1]))):
        docs = np.flatnonzero(before & (most[which] > 0))
        size = n[docs]
        token = np.repeat(at[:-1][docs] - np.cumsum(size) + size, size) + np.arange(size.sum())
        doc = np.repeat(np.arange(len(docs)), size)
        differ = most[which[docs]]
        parts = (differ + 2 + differ // SPARE_PARTS).astype(np.uint64)
        part = ((h[token] >> np.uint64(32)) * parts[doc]) >> np.uint64(32)
        first = np.flatnonzero(np.concatenate([[True], (part[1:] != part[:-1]) | (doc[1:] != doc[:-1])])[: len(part)])
        yield docs, which[docs], token, doc, part, first


def part_signatures(h: np.ndarray, at: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of documents' parts, and each one's document; h is sorted within documents."""
    n = np.diff(at)
    _, _, most = intervals(percent)
    scrambled = tokens.mix(h ^ _SEEDS[3])
    marked = lambda sig, which, loose: sig & ~np.uint64(255) | which.astype(np.uint64) | np.uint64(loose)
    out, owners = [], []
    for docs, which, token, doc, part, first in _cut(h, at, percent):
        if not len(docs):
            continue
        size, differ = n[docs], most[which]
        mark = tokens.mix((which.astype(np.uint64) + np.uint64(1)) * tokens._BASE)
        out.append(marked(tokens.mix(np.add.reduceat(scrambled[token], first) + tokens.mix(mark[doc[first]] + part[first])), which[doc[first]], 0))
        owners.append(docs[doc[first]])
        few = np.flatnonzero(np.bincount(doc[first], minlength=len(docs)) <= differ)
        if len(few):
            reach = size[few] + (-size[few] * percent // 100) + 1
            token = np.repeat(at[:-1][docs[few]] - np.cumsum(reach) + reach, reach) + np.arange(reach.sum())
            doc = np.repeat(few, reach)
            out.append(marked(tokens.mix(scrambled[token] ^ tokens.mix(~mark[doc])), which[doc], _LOOSE))
            owners.append(docs[doc])
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(out), np.concatenate(owners)


def shared_parts(docs: DataFrame, text: str, k: int, percent: int) -> DataFrame:
    """sig, s1: the parts that different sets share, and the sets (by hash) that hold them."""

    def emit(batches):
        seen: set[int] = set()  # hashes of sets that this task has met: copies within it are sent once
        for _, h, _, at in _sets(batches, text, k):
            s1 = _set_hash(h, at, 0)
            fresh = np.ones(len(s1), dtype=bool)
            for i, s in enumerate(s1.tolist()):
                fresh[i] = s not in seen
                seen.add(s)
            sig, owner = part_signatures(h, at, percent)
            keep = fresh[owner]
            yield pa.RecordBatch.from_arrays([pa.array(sig[keep].view(np.int64)), pa.array(s1[owner[keep]].view(np.int64))], names=["sig", "s1"])

    def meet(batches):
        """Of rows sorted by sig, the runs that hold different sets; a run may go on in the next batch."""
        rest = np.zeros((2, 0), np.int64)
        schema = pa.schema([("sig", pa.int64()), ("s1", pa.int64())])

        def runs(rows):
            if not rows.shape[1]:
                return None
            first = np.flatnonzero(np.concatenate([[True], rows[0, 1:] != rows[0, :-1]]))
            several = np.minimum.reduceat(rows[1], first) != np.maximum.reduceat(rows[1], first)
            keep = np.repeat(several, np.diff(np.append(first, rows.shape[1])))
            return pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in rows], schema=schema)

        for batch in batches:
            rows = np.concatenate([rest, np.stack([batch.column(c).to_numpy() for c in ("sig", "s1")])], axis=1)
            cut = int(np.searchsorted(rows[0], rows[0, -1])) if rows.shape[1] else 0
            if cut:
                yield runs(rows[:, :cut])
            rest = rows[:, cut:]
        if (last := runs(rest)) is not None:
            yield last

    parts = docs.select(text).mapInArrow(emit, "sig long, s1 long")
    return parts.repartition("sig").sortWithinPartitions("sig").mapInArrow(meet, "sig long, s1 long")


def whole_sets(docs: DataFrame, key: str, text: str, k: int, nodes: DataFrame) -> DataFrame:
    """The columns of nodes(node, key, s1, others) but key and s1, n, and shingles (sorted hashes), from the text of one of each node's documents.

    Texts that no node may need are passed over before they are split (see
    `key_filter`), and what is shuffled is the sets of the others.
    """
    names = [f.name for f in nodes.schema.fields if f.name not in ("key", "s1")]
    wanted = key_filter(nodes, F.xxhash64("key"))
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        some = (b.filter(pa.array(wanted(b.column("_at").to_numpy()))) for b in batches)
        for part, h, _, at in _sets(some, "text", k):
            sets = pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer((at * 8).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(h))])
            yield pa.RecordBatch.from_arrays([part.column("_own"), pa.array(_set_hash(h, at, 0).view(np.int64)), pa.array(np.diff(at)), sets], names=["_own", "_s1", "n", "shingles"])

    rows = docs.select(F.col(key).alias("_own"), F.col(text).alias("text"), F.xxhash64(key).alias("_at"))
    rows = rows.mapInArrow(run, f"_own {kind}, _s1 long, n long, shingles binary")
    # an id may stand at another text, too
    return nodes.join(rows, F.col("_own").eqNullSafe(F.col("key")) & (F.col("_s1") == F.col("s1"))).select(*names, "n", "shingles")


def _groups(batches, column: str = "g"):
    """Runs of equal `column` in sorted batches, as tables."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        g = batch.column(column).to_numpy()
        cuts = [0, *(np.flatnonzero(g[1:] != g[:-1]) + 1).tolist(), len(g)]
        for a, b in zip(cuts, cuts[1:]):
            if held and held[0].column(column)[0].as_py() != g[a]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


class _Classes:
    """Disjoint sets of positions."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        self.up[self.find(j)] = self.find(i)


def link_by_sets(rows: DataFrame, percent: int) -> DataFrame:
    """Edges a, b from groups g of node, n, shingles: a spanning star of each component found in a group."""

    def run(batches):
        for group in _groups(batches):
            nodes = group.column("node").to_pylist()
            sets = [np.frombuffer(x, np.uint64) for x in group.column("shingles").to_pylist()]
            if len(nodes) < 2:
                continue
            leaves = []
            for i, s in enumerate(sets):
                width = S.width_of(len(s))
                flags = np.zeros(min(width, S.WINDOW), dtype=bool)
                bit = (s & np.uint64(width - 1)).astype(np.int64)
                flags[bit[bit < len(flags)]] = True
                leaves.append(S.leaf(i, len(s), int.from_bytes(np.packbits(flags, bitorder="little").tobytes(), "little"), width, i))
            classes = _Classes(len(nodes))

            def visit(i, j):
                if classes.find(i) == classes.find(j):
                    return
                shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * shared >= percent * (len(sets[i]) + len(sets[j]) - shared):
                    classes.join(i, j)

            def members(node):
                return (node.item,) if node.item is not None else tuple(x for c in node.children for x in members(c))

            def apart(p, q):
                """Whether some member of p is not yet linked to some member of q."""
                one = p.classes if isinstance(p.classes, int) else None
                two = q.classes if isinstance(q.classes, int) else None
                if one is None and (found := {classes.find(i) for i in members(p)}) and len(found) == 1:
                    one = p.classes = next(iter(found))  # once one class, always one
                if two is None and (found := {classes.find(i) for i in members(q)}) and len(found) == 1:
                    two = q.classes = next(iter(found))
                return p is q and p.item is None and one is None or p is not q and (one is None or two is None or classes.find(one) != classes.find(two))

            root = S.build(leaves)
            S.traverse(root, root, percent, visit, apart)
            roots = [classes.find(i) for i in range(len(nodes))]
            pairs = [(nodes[r], nodes[i]) for i, r in enumerate(roots) if nodes[r] != nodes[i]]
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*pairs)], names=["a", "b"])

    return rows.repartition("g").sortWithinPartitions("g").mapInArrow(run, "a long, b long")


def distinct_groups(rows: DataFrame) -> DataFrame:
    """sig, size, times, deal of groups sig of rows sig, mark, node, component: of those that hold the same nodes one, and how many they are.

    Groups of one component are left out.  Near copies share many parts, so
    groups with the same smallest node get the same `deal`, as long as these
    have GROUP_NODES rows or fewer, else one of several: a task that takes
    a whole deal lists a pair once.
    """
    once, again = F.xxhash64("node"), F.xxhash64("node", F.lit(1))
    members = F.count("*").alias("size"), F.min("node").alias("least"), F.bit_xor(once).alias("x"), F.bit_xor(again).alias("y")
    groups = rows.groupBy("sig", "mark").agg(*members, F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    groups = stored(groups.groupBy("mark", "size", "least", "x", "y").agg(F.min("sig").alias("sig"), F.count("*").alias("times")), "groups")
    deals = groups.groupBy("least").agg(F.ceil(F.sum("size") / GROUP_NODES).alias("deals"))
    deal = F.xxhash64("least", F.pmod(F.xxhash64("sig"), F.col("deals")))
    return groups.join(deals, "least").select("sig", "size", "times", deal.alias("deal"))


def candidates_by_bits(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs a, b of nodes of different components ca, cb that may be similar, and the parts (or single shingles) that they share, from groups g of deal, node, n, component, held, bits, side, cross, mark, times.

    A group holds the nodes that share `times` parts, whose signatures end in
    `mark`; a node has `held` parts in that interval.  Of the parts of either
    node at most as many as there are different shingles are not shared.
    """
    end, _, _ = intervals(percent)

    def run(batches):
        met: Counter = Counter()

        def flush():
            columns = [pa.array(x, pa.int64()) for x in (*zip(*met), met.values())]
            met.clear()
            return pa.RecordBatch.from_arrays(columns, names=["a", "b", "ca", "cb", "need", "parts"])

        for group in _groups(batches):
            comps = group.column("component").to_pylist()
            if len(set(comps)) < 2:
                continue
            nodes, sizes, held, bits = (group.column(c).to_pylist() for c in ("node", "n", "held", "bits"))
            sides, cross = group.column("side").to_pylist(), group.column("cross")[0].as_py()
            leaves = [S.leaf(i, n, int.from_bytes(x, "little"), S.width_of(n), c) for i, (n, x, c) in enumerate(zip(sizes, bits, comps))]
            mark, times = (group.column(c)[0].as_py() for c in ("mark", "times"))
            interval, loose = mark & _INTERVAL_BITS, mark & _LOOSE
            own = np.searchsorted(end, sizes).tolist()

            def visit(i, j):
                if min(own[i], own[j]) != interval:  # the pair meets in another, too
                    return
                need = max(held[i], held[j]) - (sizes[i] + sizes[j]) * (100 - percent) // (100 + percent)
                if loose and need > 0:  # alike, they share a whole part
                    return
                if nodes[i] > nodes[j]:
                    i, j = j, i
                met[nodes[i], nodes[j], comps[i], comps[j], need] += times

            apart = lambda p, q: p.classes is None or p.classes != q.classes
            if cross:
                halves = [[x for x in leaves if sides[x.item] == s] for s in sorted(set(sides))]
                if len(halves) == 2:
                    S.traverse(S.build(halves[0]), S.build(halves[1]), percent, visit, apart)
            else:
                root = S.build(leaves)
                S.traverse(root, root, percent, visit, apart)
            if len(met) > 200_000:
                yield flush()
        if met:
            yield flush()

    met = rows.repartition("deal").sortWithinPartitions("deal", "g").mapInArrow(run, "a long, b long, ca long, cb long, need long, parts long")
    return met.groupBy("a", "b", "ca", "cb", "need").agg(F.sum("parts").alias("parts")).where("parts >= need").drop("need")


def possible_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs a, b whose whole sets (node, n, shingles) may be alike by bitmaps of two to four places a shingle, a thirtieth of the sets."""

    def sketch(batches):
        for batch in batches:
            bits = []
            for x in batch.column("shingles"):
                x = np.frombuffer(x.as_buffer(), np.uint64)
                flags = np.zeros(1 << max(6, (2 * len(x) - 1).bit_length()), dtype=bool)
                flags[x & np.uint64(len(flags) - 1)] = True
                bits.append(np.packbits(flags, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("n"), pa.array(bits, pa.binary())], names=["node", "n", "bits"])

    def judge(batches):
        for batch in batches:
            may = []
            for n, m, x, y in zip(*(batch.column(c).to_pylist() for c in ("na", "nb", "bitsa", "bitsb"))):
                x, y = (np.unpackbits(np.frombuffer(z, np.uint8), bitorder="little") for z in (x, y))
                width = min(len(x), len(y))
                x, y = (z.reshape(-1, width).any(axis=0) for z in (x, y))
                most = int((x & y).sum()) + min(n - int(x.sum()), m - int(y.sum()))
                may.append((100 + percent) * most >= percent * (n + m))
            yield batch.select(["a", "b"]).filter(pa.array(may, pa.bool_()))

    sketches = sets.select("node", "n", "shingles").mapInArrow(sketch, "node long, n long, bits binary")
    one, two = (sketches.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("bits").alias(f"bits{c}")) for c in "ab")
    return pairs.join(one, "a").join(two, "b").select("a", "b", "na", "nb", "bitsa", "bitsb").mapInArrow(judge, "a long, b long")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs a, b whose sets (node, n, shingles) are alike."""
    one, two = (sets.select(F.col("node").alias(c), F.col("shingles").alias(f"s{c}")) for c in "ab")

    def compare(batches):
        for batch in batches:
            same = []
            for x, y in zip(batch.column("sa"), batch.column("sb")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                same.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(same, pa.bool_()))

    return pairs.join(one, "a").join(two, "b").select("a", "b", "sa", "sb").mapInArrow(compare, "a long, b long")


def membership(docs: DataFrame, *, key: str = "doc_id", text: str = "text", k: int = 4, percent: int = 85) -> tuple[DataFrame, DataFrame]:
    """Each row's key, n, s1, s2; and of each different set s1, s2, n, its smallest key, and component (a number)."""
    info = stored(describe(docs, key, text, k, percent), "documents")
    groups = info.where("n > 0").groupBy("s1", "s2", "n")
    nodes = groups.agg(F.min("key").alias("key"), *[F.first(c).alias(c) for c in ("bands", "held", "bits")])
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    # step 2: nodes that share a pair of minima
    bands = nodes.select("node", F.explode("bands").alias("m"))
    shared = bands.groupBy("m").agg(F.count("*").alias("size")).where("size > 1")
    met = bands.join(shared, "m").select("node", F.xxhash64("m", F.floor(F.pmod(F.xxhash64("node", "m"), F.ceil(F.col("size") / SET_NODES)))).alias("g"))
    some = nodes.join(met.groupBy("node").agg(F.collect_set("g").alias("groups")), "node").select("node", "key", "s1", "groups")
    sets = whole_sets(docs, key, text, k, stored(some, "some"))
    edges = stored(link_by_sets(sets.select(F.explode("groups").alias("g"), "node", "shingles"), percent), "edges")
    first = components(edges)

    # steps 3 and 4: parts that join components
    labelled = nodes.join(first, "node", "left").select("node", "s1", "n", F.coalesce("component", "node").alias("component"), "held")
    parts = stored(shared_parts(docs, text, k, percent).join(labelled, "s1").select("sig", "node", "n", "component", "held"), "parts")
    joining = parts.groupBy("sig").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    rows = parts.join(joining.select("sig"), "sig").dropDuplicates(["sig", "node"])
    rows = rows.withColumn("mark", F.col("sig").bitwiseAND(255).cast("int")).withColumn("interval", F.col("mark").bitwiseAND(_INTERVAL_BITS))
    end, _, _ = (F.get(F.array(*[F.lit(int(x)) for x in column]), F.col("interval")) for column in intervals(percent))
    widest = F.when(F.col("n") <= end, F.floor(F.col("n") * 100 / percent)).otherwise(end)  # of its partners in the interval
    rows = rows.withColumn("held", F.when(F.col("n") <= end, F.col("held")[0]).otherwise(F.col("held")[1]))
    rows = rows.withColumn("need", F.col("held") - F.floor((F.col("n") + widest) * (100 - percent) / (100 + percent)))
    rows = stored(rows.where((F.col("mark") < _LOOSE) | (F.col("need") < 1)).drop("interval"), "joining")
    enough = rows.groupBy("node", F.col("mark").bitwiseAND(_INTERVAL_BITS).alias("interval")).agg(F.count("*").alias("parts"), F.first("need").alias("need"))
    enough = enough.where("parts >= need").select("node", "interval")
    rows = stored(rows.withColumn("interval", F.col("mark").bitwiseAND(_INTERVAL_BITS)).join(enough, ["node", "interval"]).select("sig", "node", "n", "component", "held", "mark"), "enough")
    rows = rows.join(distinct_groups(rows), "sig")
    chunks = F.ceil(F.col("size") / GROUP_NODES)
    rows = rows.withColumn("side", F.pmod(F.xxhash64("node"), chunks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), chunks - 1)))
    cross = F.col("side") != F.col("other")
    group = F.xxhash64("sig", F.least("side", "other"), F.greatest("side", "other"))
    rows = rows.withColumn("g", group).withColumn("deal", F.when(chunks > 1, F.col("g")).otherwise(F.col("deal")))
    rows = rows.select("deal", "g", "node", "n", "component", "held", "mark", "times", "side", cross.alias("cross"))
    rows = rows.join(nodes.select("node", "bits"), "node")
    pairs = stored(candidates_by_bits(rows, percent), "pairs")

    def links(some_pairs: DataFrame) -> DataFrame:
        some = nodes.join(some_pairs.select(F.col("a").alias("node")).union(some_pairs.select("b")).distinct(), "node").select("node", "key", "s1")
        sets = stored(whole_sets(docs, key, text, k, stored(some, "some")).dropDuplicates(["node"]), "sets")
        return stored(verified(stored(possible_pairs(some_pairs, sets, percent), "possible"), sets, percent), "links")

    both = pairs.select(F.col("ca").alias("c"), "a", "b", "parts").union(pairs.select("cb", "a", "b", "parts"))
    likeliest = both.groupBy("c").agg(F.max(F.struct("parts", "a", "b")).alias("x")).select("x.a", "x.b").distinct()
    likeliest = stored(likeliest, "likeliest")
    if not likeliest.isEmpty():
        edges = edges.union(links(likeliest))
        first = components(edges)
        label = lambda c: first.select(F.col("node").alias(c), F.col("component").alias(f"now_{c}"))
        rest = pairs.join(likeliest, ["a", "b"], "left_anti").join(label("a"), "a", "left").join(label("b"), "b", "left")
        rest = stored(rest.where(~F.coalesce("now_a", "a").eqNullSafe(F.coalesce("now_b", "b"))).select("a", "b"), "rest")
        if not rest.isEmpty():
            edges = edges.union(links(rest))
            first = components(edges)

    # step 5
    named = nodes.join(first, "node", "left").select("s1", "s2", "n", "key", F.coalesce("component", "node").alias("component"))
    return info.select("key", "n", "s1", "s2"), named


def jaccard_components(docs: DataFrame, *, key: str = "doc_id", text: str = "text", k: int = 4, percent: int = 85) -> DataFrame:
    """key, n_shingles, component_id of every row of docs."""
    own, named = membership(docs, key=key, text=text, k=k, percent=percent)
    names = named.groupBy("component").agg(F.min("key").alias("component_id"))
    named = named.join(names, "component").select("s1", "s2", "n", "component_id")
    out = own.where("n > 0").join(named, ["s1", "s2", "n"]).select("key", "n", "component_id")
    out = out.unionByName(own.where("n = 0").select("key", "n", F.col("key").alias("component_id")))
    return out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), "component_id")


def one_per_group(docs: DataFrame, *, key: str = "doc_id", text: str = "text", k: int = 4, percent: int = 85) -> DataFrame:
    """docs without near copies: of each component one row stays, of the smallest key, then the smallest set hash.

    Rows are told apart by key and set, so another text under a key that goes
    stays; rows without a key come last in a component but follow the same
    rule; of rows of equal key and set that of the first text stays.  A text
    without words is a copy of nothing and stays.  Only rows whose key is that of
    a row that goes, or stands at several, are shuffled.
    """
    own, named = membership(docs, key=key, text=text, k=k, percent=percent)
    rank = F.struct(F.col("key").isNull().alias("none"), "key", "s1", "s2", "n")
    first = named.groupBy("component").agg(F.min(rank).alias("f")).select(F.col("f.key").alias("_key"), F.col("f.s1").alias("_s1"), F.col("f.s2").alias("_s2"), F.lit(True).alias("stays"))
    rows = own.where("n > 0").groupBy("key", "s1", "s2").agg(F.count("*").alias("rows"))
    same = F.col("key").eqNullSafe(F.col("_key")) & (F.col("s1") == F.col("_s1")) & (F.col("s2") == F.col("_s2"))
    rows = rows.join(first, same, "left").where("stays IS NULL OR rows > 1")
    contested = stored(rows.select(F.col("key").alias("_near_key"), F.col("s1").alias("_near_1"), F.col("s2").alias("_near_2"), F.coalesce("stays", F.lit(False)).alias("_near_stays")), "contested")
    maybe = key_filter(contested, F.xxhash64("_near_key"))
    names = docs.columns
    marked = docs.select("*", F.xxhash64(key).alias("_near_at"))

    def clear(batches):
        for batch in batches:
            yield batch.filter(pa.array(~maybe(batch.column("_near_at").to_numpy()))).select(names)

    def signed(batches):
        some = (b.filter(pa.array(maybe(b.column("_near_at").to_numpy()))) for b in batches)
        for part, h, _, at in _sets(some, text, k):
            hashes = (pa.array(_set_hash(h, at, i).view(np.int64)) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), *hashes], names=[*names, "_near_s1", "_near_s2"])

    wide = T.StructType([*docs.schema.fields, T.StructField("_near_s1", T.LongType()), T.StructField("_near_s2", T.LongType())])
    checked = marked.mapInArrow(signed, wide)
    met = F.col(key).eqNullSafe(F.col("_near_key")) & (F.col("_near_s1") == F.col("_near_1")) & (F.col("_near_s2") == F.col("_near_2"))
    checked = checked.join(contested, met, "left").where("_near_stays IS NULL OR _near_stays")
    single = marked.mapInArrow(clear, docs.schema).unionByName(checked.where("_near_stays IS NULL").select(names))
    if contested.where("_near_stays").isEmpty():  # no key stands at several rows of one set
        return single
    several = checked.where("_near_stays").groupBy(key, "_near_1", "_near_2").agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in names]), text).alias("_near_row"))
    return single.unionByName(several.select("_near_row.*"))


def op4_ngram_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
