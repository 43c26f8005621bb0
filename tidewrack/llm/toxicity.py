"""Toxicity by a weighted finite-state pattern grammar.

Words become symbols (insult, threat, target, negation, reported speech,
quotation mark, other).  Small transducers rewrite a clause's symbols: the first
runs from the clause's end to its start and marks an insult or threat that a
target follows; of the others, which are composed once into one machine that
runs forward, negation marks an insult or threat that a negation precedes
closely, reported speech one that is quoted or told, and target tells those aimed
at somebody in the same clause from the rest.  The machine emits marks such as
("insult", "directed").  A clause's
marks, times the strengths of their words, are what a text is scored by: log
sums per kind of mark go into a logistic function.

Learned from labelled texts: further insults (words, and word beginnings, that
labelled-toxic texts hold in several different contexts and clean ones hardly
do; contexts, since copies of one text repeat words but not contexts) and the
weights of the marks, which start from the grammar's own and are moved by the
data (a Gaussian prior).  At most about `SAMPLE` labels are used, chosen by a hash
of their id, so the lexicon and the weights that are sent to tasks are bounded.

Defined cases: a null or empty text has no clause and gets the base score;
of equal labels of an id one counts, and of different ones each; rows that share
an id share its labels; null labels are not learned from; a very long text is one
more text, whose clauses are run one by one;
without labels the grammar's own weights stand; an empty table gives an empty
result; other columns pass through, and `score` and `marks` replace columns of
the same name.
"""

from __future__ import annotations

import re
from collections import Counter, deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc_bucket

#: Labelled texts that lexicon and weights are fitted on, about.
SAMPLE = 16_000
#: A learned word or beginning needs so many toxic texts, contexts, and this share of its texts toxic.
LEAST_TEXTS, LEAST_CONTEXTS, LEAST_SHARE = 3, 3, 0.75
STEM_SIZES, LEAST_STEM_WORDS, LEAST_STEM_SHARE = (4, 5, 6), 6, 0.98

# The grammar's words.
LEXICON = {
    "insult": "idiot idiots moron morons stupid loser losers scum trash worthless pathetic disgusting clown clowns imbecile dumb filth vermin "
    "idioot dummkopf arschloch abschaum wertlos erbärmlich versager idiotin connard ordure minable imbécile pathétique idiote "
    "basura idiota imbécil estúpido estúpida patético escoria inútil",
    "threat": "kill killing hurt destroy smash beat strangle shoot stab burn umbringen töten vernichten tuer détruire frapper matar destruir golpear",
    "target": "you your yours yourself he him she her they them these those du dich dir ihr euch sie er tu toi vous ils elles lui tú usted ustedes ellos ellas él",
    "negation": "not no never neither nor without isn't aren't wasn't don't doesn't didn't won't can't nicht kein keine nie niemals pas jamais aucun nunca ningún jamás sin",
    "reported": "said says saying told called calls wrote writes claimed claims quoted allegedly sagte sagt schrieb nannte dit disait écrit appelé dijo dice escribió llamó",
}
# The weights the marks start from, and the base.
PRIOR = {
    ("insult", "directed"): 3.0, ("insult", "bare"): 2.5, ("insult", "negated"): 0.2, ("insult", "reported"): 0.8,
    ("threat", "directed"): 1.5, ("threat", "bare"): 0.3, ("threat", "negated"): 0.0, ("threat", "reported"): 0.2,
}
BASE, PRIOR_SPREAD, BASE_SPREAD = -2.0, 2.0, 1.0
MARKS = tuple(PRIOR)
_TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[.!?;:\n\"“”„«»]")
_CLAUSE_ENDS = frozenset(".!?;:\n")
_QUOTES = frozenset("\"“”„«»")


# Each transducer: a start state, and step(state, symbol) -> (state, symbols out).  "end" closes a clause.
def _negation(state: int, symbol):
    if symbol == "negation":
        return 4, (symbol,)
    if symbol == "end":
        return 0, (symbol,)
    out = f"negated {symbol}" if state and symbol.startswith(("insult", "threat")) else symbol
    return max(0, state - 1), (out,)


def _reported(state: int, symbol):
    if symbol in ("reported", "quote"):
        return 1, (symbol,)
    if symbol == "end":
        return 0, (symbol,)
    return state, (f"reported {symbol}" if state and symbol.startswith(("insult", "threat")) else symbol,)


def _ahead(state: int, symbol):
    """Runs from a clause's end to its start, and marks an insult or threat that a target follows."""
    if symbol == "target":
        return 1, (symbol,)
    if symbol == "end":
        return 0, (symbol,)
    return state, (f"{symbol} ahead" if state and symbol in ("insult", "threat") else symbol,)


def _target(state: int, symbol):
    """state: whether a target was seen."""
    if symbol == "target":
        return 1, ()
    if symbol == "end":
        return 0, ()
    words = symbol.split(" ")
    how = next((w for w in words if w in ("negated", "reported")), None)
    kind = next((w for w in words if w in ("insult", "threat")), None)
    if kind is None:
        return state, ()
    return state, ((kind, how or ("directed" if state or "ahead" in words else "bare")),)


def compose(*machines):
    """One table (state, symbol) -> (state, marks) of the machines in a row, over all states that can be reached."""
    steps, start = [m for m, _ in machines], tuple(s for _, s in machines)
    symbols = (*LEXICON, "insult ahead", "threat ahead", "quote", "other", "end")
    table, todo = {}, deque([start])
    while todo:
        state = todo.popleft()
        if (state, "end") in table:
            continue
        for symbol in symbols:
            now, stream = list(state), (symbol,)
            for i, step in enumerate(steps):
                passed = []
                for x in stream:
                    now[i], out = step(now[i], x)
                    passed += out
                stream = tuple(passed)
            table[state, symbol] = (tuple(now), stream)
            todo.append(tuple(now))
    return start, table


START, TABLE = compose((_negation, 0), (_reported, 0), (_target, 0))


class Grammar:
    """Symbols and strengths of words, with learned insults and beginnings."""

    def __init__(self, words: dict[str, float] | None = None, stems: dict[str, float] | None = None):
        self.symbol = {w: s for s, line in LEXICON.items() for w in line.split()}
        self.strength = {w: 1.0 for w in self.symbol}
        for w, s in (words or {}).items():
            self.symbol[w] = "insult"
            self.strength[w] = max(s, self.strength.get(w, 0.0))
        self.stems = stems or {}
        self.sizes = sorted({len(s) for s in self.stems})

    def of(self, word: str) -> tuple[str, float]:
        found = self.symbol.get(word)
        if found:
            return found, self.strength[word]
        for n in self.sizes:
            if word[:n] in self.stems:
                return "insult", self.stems[word[:n]]
        return "other", 0.0

    def marks(self, text: str) -> Counter:
        """Strengths by mark, over the clauses that hold an insult or a threat."""
        found: Counter = Counter()
        parts = _TOKEN.findall(text.lower())
        read = {w: s for w in set(parts) if (s := self.of(w))[0] != "other"}
        if not any(s[0] in ("insult", "threat") for s in read.values()):
            return found
        clause: list[str] = []
        for w in (*parts, "."):
            if w not in _CLAUSE_ENDS:
                clause.append(w)
                continue
            held = [read[x][1] for x in clause if x in read and read[x][0] in ("insult", "threat")]
            if held:
                state, strongest, after, symbols = START, max(held), 0, ["end"]
                for x in reversed(clause):
                    after, out = _ahead(after, "quote" if x in _QUOTES else read.get(x, ("other",))[0])
                    symbols += out
                for symbol in reversed(symbols):
                    state, out = TABLE[state, symbol]
                    for mark in out:
                        found[mark] += strongest
            clause = []
        return found

    def features(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros((len(texts), len(MARKS)))
        for i, t in enumerate(texts):
            if t and (found := self.marks(t)):
                out[i] = [found.get(m, 0.0) for m in MARKS]
        return np.log1p(out)


def _lexicon(train: DataFrame) -> Grammar:
    """A grammar with the insults that `train` (text, toxic) teaches."""

    def count(batches):
        for batch in batches:
            clean: Counter = Counter()
            rows: list[tuple] = []
            texts, toxic = batch.column("text").to_pylist(), batch.column("toxic").to_pylist()
            for text, bad in zip(texts, toxic):
                parts = [w for w in _TOKEN.findall(text.lower()) if w[0].isalpha()]
                if not bad:
                    clean.update(set(parts))
                    continue
                first: dict[str, int] = {}
                for i, w in enumerate(parts):
                    first.setdefault(w, i)
                rows += [(w, f"{parts[i - 1] if i else ''} {parts[i + 1] if i + 1 < len(parts) else ''}", 1, 0) for w, i in first.items()]
            rows += [(w, None, 0, n) for w, n in clean.items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(zip(*rows) if rows else ([],) * 4, (pa.string(), pa.string(), pa.int64(), pa.int64()))], names=["word", "context", "bad", "good"]
            )

    seen = train.mapInArrow(count, "word string, context string, bad long, good long")
    seen = seen.groupBy("word", "context").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    words = seen.groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"), F.count("context").alias("contexts"))
    strength = lambda bad, good: F.log((bad + 0.5) / (good + 0.5)) / 2
    share = lambda at_least: F.col("bad") >= at_least * (F.col("bad") + F.col("good"))
    learned = words.where((F.col("bad") >= LEAST_TEXTS) & (F.col("contexts") >= LEAST_CONTEXTS) & share(LEAST_SHARE) & (F.length("word") > 2))
    learned = learned.select("word", strength(F.col("bad"), F.col("good")).alias("strength"))
    stems = words.select("bad", "good", "contexts", "word", F.explode(F.array(*[F.when(F.length("word") > n, F.substring("word", 1, n)) for n in STEM_SIZES])).alias("stem"))
    stems = stems.where("stem IS NOT NULL").groupBy("stem").agg(
        F.sum("bad").alias("bad"), F.sum("good").alias("good"), F.count(F.when((F.col("contexts") >= 2) & (F.col("bad") > F.col("good")), 1)).alias("words")
    )
    stems = stems.where((F.col("words") >= LEAST_STEM_WORDS) & share(LEAST_STEM_SHARE)).select("stem", strength(F.col("bad"), F.col("good")).alias("strength"))
    # both are bounded: they come from at most SAMPLE texts, each entry from several of them
    found = learned.withColumn("stem", F.lit(False)).unionByName(stems.withColumnRenamed("stem", "word").withColumn("stem", F.lit(True))).collect()
    return Grammar({r.word: r.strength for r in found if not r.stem}, {r.word: r.strength for r in found if r.stem})


def _weights(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Most likely logistic weights under Gaussians about the grammar's own; the base comes last."""
    x = np.column_stack([x, np.ones(len(x))])
    start = np.array([*PRIOR.values(), BASE])
    tight = np.array([1 / PRIOR_SPREAD**2] * len(PRIOR) + [1 / BASE_SPREAD**2])
    w = start.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + tight * (w - start)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(tight), gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    w[: len(PRIOR)] = np.maximum(w[: len(PRIOR)], 0)
    return w


def fit(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "toxic") -> tuple[Grammar, np.ndarray]:
    """Grammar and weights from docs (key, text) and labels (key, label)."""
    labels = labels.where(F.col(label).isNotNull()).select(F.col(key).alias("key"), (F.col(label) == 1).alias("toxic"))
    n = labels.count()
    draw = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, SAMPLE / max(n, 1)))
    picked = labels.where(draw).distinct()  # about SAMPLE pairs of an id and a bit: small enough to send to all tasks
    train = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text"))
    train = train.join(F.broadcast(picked), "key").select("text", "toxic")
    grammar = _lexicon(train)

    def run(batches):
        for batch in batches:
            x = grammar.features(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())), batch.column("toxic")], names=["x", "toxic"])

    counted = train.mapInArrow(run, "x array<double>, toxic boolean").groupBy("x", "toxic").agg(F.count("*").alias("n")).collect()
    if not counted:
        return grammar, np.array([*PRIOR.values(), BASE])
    x = np.repeat(np.array([r.x for r in counted]), [r.n for r in counted], axis=0)
    y = np.repeat(np.array([r.toxic for r in counted], float), [r.n for r in counted])
    return grammar, _weights(x, y)


def score(docs: DataFrame, grammar: Grammar, weights: np.ndarray, *, text: str = "text") -> DataFrame:
    """docs with score (0 to 1) and marks (name and strength); one pass, no shuffle."""
    docs = docs.select([c for c in docs.columns if c not in ("score", "marks")])
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("marks", T.MapType(T.StringType(), T.DoubleType()))])
    shared = docs.sparkSession.sparkContext.broadcast((grammar, weights))

    def run(batches):
        grammar, weights = shared.value
        for batch in batches:
            x = grammar.features(batch.column(text).to_pylist())
            p = 1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30)))
            marks = [[(" ".join(m), float(v)) for m, v in zip(MARKS, row) if v] for row in x]
            extra = [pa.array(p), pa.array(marks, pa.map_(pa.string(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=schema.fieldNames())

    return docs.mapInArrow(run, schema)


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(crc_bucket(F.col("doc_id"), 3) != 1)
    grammar, weights = fit(docs, labels)
    out = score(docs, grammar, weights)
    return out.select("doc_id", (crc_bucket(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
