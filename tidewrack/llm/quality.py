"""Quality rules, line first: lines that break a rule go, then documents that lost too much go.

A line (split at \\n, with at least one word) fails if it is
* navigation: three or more of `SEPARATORS`, at least one for every three words;
* symbols: more than a tenth of its non-space characters are of ``#*$%&|<>``;
* shouting: at least five words, over seven tenths of its letters A-Z capital;
* boilerplate: at most 40 words, with a phrase of `BOILERPLATE`;
* unpunctuated: twelve words or more, with no end mark in it at all;
* repeated: equal to an earlier line of its text.
The text left is the lines that passed (lines without words stay).  `lost` is
the share of word characters removed; a document over `most_lost` is rejected,
as is one that fails the base rules: fewer than `least_words` words, or over half
of its words in three-word windows found twice.

Defined cases: a null text is empty and is rejected; null ids and repeated rows
are treated like any row; of equal lines the first counts as the original; a text
exactly at a limit stays; an empty table gives an empty result; a very long text
is measured whole, in memory for some twenty times its size; other columns pass
through, and the added columns replace any of the same name.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import tokens

# Phrases that mark boilerplate lines (ASCII only, since case is folded for A-Z alone).
BOILERPLATE = (
    # English
    "accept all cookies", "all rights reserved", "click here", "cookie policy", "enable javascript", "lorem ipsum", "privacy policy",
    "sign up for our newsletter", "skip to content", "terms of service", "terms of use", "this site uses cookies",
    # German
    "alle cookies akzeptieren", "alle rechte vorbehalten", "hier klicken", "newsletter abonnieren", "zum inhalt springen", "diese website verwendet cookies",
    # French
    "accepter tous les cookies", "aller au contenu", "cliquez ici", "politique de cookies", "conditions d'utilisation", "ce site utilise des cookies",
    # Spanish
    "aceptar todas las cookies", "todos los derechos reservados", "haga clic", "saltar al contenido", "aviso legal", "este sitio utiliza cookies",
)
# Separators of navigation lines.
SEPARATORS = "|\u00b7\u00bb\u2022\u203a"
_BOILERPLATE = re.compile("|".join(map(re.escape, BOILERPLATE)).encode(), re.IGNORECASE)
ADDED = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_failed_lines")]
    + [
        T.StructField("lost", T.DoubleType()),
        T.StructField("base_failed", T.BooleanType()),
        T.StructField("kept", T.BooleanType()),
        T.StructField("clean_text", T.StringType()),
    ]
)


def _flags(members: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(members)] = True
    return out


_SYMBOL, _UPPER, _LOWER = _flags(b"#*$%&|<>"), _flags(bytes(range(65, 91))), _flags(bytes(range(97, 123)))
_END_MARK = _flags(b".!?:;")
_INSIDE = ~tokens._SPACE


def _count(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Flags set in each range between successive positions."""
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[at])


def _separators(data: np.ndarray) -> np.ndarray:
    """Flags of the first bytes of SEPARATORS."""
    out = np.zeros(len(data), dtype=bool)
    for c in SEPARATORS:
        code = c.encode()
        found = data == code[0]
        for i in range(1, len(code)):
            found[:-i] &= data[i:] == code[i]
            found[-i:] = False
        out |= found
    return out


def _measure(data: np.ndarray, offsets: np.ndarray, most_lost: float, least_words: int, texts_too: bool) -> dict[str, list]:
    n = len(offsets) - 1
    word_start, word_end, word_doc = tokens.words(data, offsets)
    n_words = np.bincount(word_doc, minlength=n)
    inside = _INSIDE[data]
    points = inside & ((data & 0xC0) != 0x80)
    word_chars, n_symbols = _count(points, offsets), _count(_SYMBOL[data], offsets)

    # three-word windows seen twice or more in their text
    hashes = tokens.word_hashes(data, word_start, word_end, fold=False)
    covered = np.zeros(len(hashes) + 2, dtype=bool)
    if len(hashes) >= 3:
        h = tokens.mix((hashes[:-2] * tokens._BASE + hashes[1:-1]) * tokens._BASE + hashes[2:])
        owner = word_doc[:-2]
        whole = np.flatnonzero(owner == word_doc[2:])
        h, owner = h[whole], owner[whole]
        order = tokens.grouped_order(owner, h)
        same = (h[order][1:] == h[order][:-1]) & (owner[order][1:] == owner[order][:-1])
        twice = np.zeros(len(order), dtype=bool)
        twice[1:] |= same
        twice[:-1] |= same
        first = whole[order[twice]]
        for i in range(3):
            covered[first + i] = True
    n_repeat = np.bincount(word_doc[covered[: len(word_doc)]], minlength=n)

    # lines: ranges between newlines and document starts
    newline = np.flatnonzero(data == 10)
    bounds = np.unique(np.concatenate([offsets, newline + 1]))
    bounds = bounds[bounds <= len(data)]
    start, stop = bounds[:-1], bounds[1:]
    line_doc = np.searchsorted(offsets, start, side="right") - 1
    # (an empty document shares its offset with the next one, which then owns the line)
    end = stop - ((stop > 0) & (data[np.maximum(stop, 1) - 1] == 10)) if len(start) else stop
    per = lambda flags: _count(flags, bounds)
    line_words = np.diff(np.searchsorted(word_start, bounds))
    has = line_words > 0
    chars, symbols, pipes = per(points), per(_SYMBOL[data]), per(_separators(data))
    upper, lower, marks = per(_UPPER[data]), per(_LOWER[data]), per(_END_MARK[data])
    line_hash = tokens.word_hashes(data, start, end, fold=False)
    order = tokens.grouped_order(line_doc[has], line_hash[has]) if has.any() else np.zeros(0, np.int64)
    at = np.flatnonzero(has)[order]
    again = np.zeros(len(start), dtype=bool)
    if len(at) > 1:
        same = (line_hash[at][1:] == line_hash[at][:-1]) & (line_doc[at][1:] == line_doc[at][:-1])
        # of equal lines all but the first in the text
        group = np.concatenate([[0], np.cumsum(~same)])
        lead = np.full(group[-1] + 1, len(start))
        np.minimum.at(lead, group, at)
        again[at] = at != lead[group]
    n_dup = np.bincount(line_doc[again], minlength=n)

    failed = again.copy()
    failed |= (pipes >= 3) & (pipes * 3 >= line_words)
    failed |= symbols * 10 > chars
    failed |= (line_words >= 5) & (upper * 10 > (upper + lower) * 7)
    failed |= (line_words >= 12) & (marks == 0)
    view = data.tobytes()
    for hit in _BOILERPLATE.finditer(view):
        i = int(np.searchsorted(bounds, hit.start(), side="right")) - 1
        if line_words[i] <= 40 and hit.end() <= end[i]:
            failed[i] = True
    failed &= has

    gone = np.bincount(line_doc[failed], weights=chars[failed], minlength=n)
    lost = np.divide(gone, word_chars, out=np.zeros(n), where=word_chars > 0)
    base_failed = (n_words < least_words) | (100 * n_repeat > 50 * n_words)
    texts = []
    first_line, last_line = np.searchsorted(start, offsets[:-1]), np.searchsorted(start, offsets[1:])
    n_failed = np.bincount(line_doc[failed], minlength=n)
    for i in range(n if texts_too else 0):
        a, b = int(offsets[i]), int(offsets[i + 1])
        if n_failed[i]:
            keep = [j for j in range(first_line[i], last_line[i]) if not failed[j]]
            texts.append(b"\n".join(view[start[j] : end[j]] for j in keep).decode())
        else:
            texts.append(view[a:b].decode())
    kept = ~base_failed & (lost <= most_lost)
    return {
        "n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup, "n_repeat_words": n_repeat,
        "n_failed_lines": n_failed, "lost": lost, "base_failed": base_failed, "kept": kept, "clean_text": texts,
    }


def clean_lines(docs: DataFrame, most_lost: float = 0.3, text: str = "text", *, least_words: int = 50, texts_too: bool = True) -> DataFrame:
    """docs with the columns of ADDED (without clean_text unless `texts_too`); no shuffle, and memory for a few megabytes of text at a time."""
    names = set(ADDED.fieldNames())
    docs = docs.select([c for c in docs.columns if c not in names])
    added = T.StructType([f for f in ADDED.fields if texts_too or f.name != "clean_text"])
    schema = T.StructType([*docs.schema.fields, *added.fields])

    def run(batches):
        for batch in batches:
            data, offsets = tokens.bytes_of(batch.column(text))
            for a, b in tokens.chunks(offsets):
                found = _measure(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], most_lost, least_words, texts_too)
                kinds = {"clean_text": pa.string(), "lost": pa.float64(), "base_failed": pa.bool_(), "kept": pa.bool_()}
                extra = [pa.array(found[c], kinds.get(c, pa.int64())) for c in added.fieldNames()]
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, *extra], names=schema.fieldNames())
        tokens.release()

    return docs.mapInArrow(run, schema)


def op8_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return clean_lines(docs, texts_too=False).drop("text")


#: The base columns and the verdict, line by line, for DuckDB.
ORACLE_OP8 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, unnest(list_transform(range(1, len(ws) + 1), lambda i: {'i': i, 'g': CASE WHEN i + 2 <= len(ws) THEN ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] END})) AS x
      FROM (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d)),
rep AS (SELECT r, x.i AS i FROM (SELECT r, x, count(*) OVER (PARTITION BY r, x.g) AS c FROM w WHERE x.g IS NOT NULL) WHERE c >= 2),
cov AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY r),
l AS (SELECT r, doc_id, i, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS nw,
        len(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS nc,
        len(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) AS ns, len(regexp_replace(line, '[^@separators@]', '', 'g')) AS np,
        len(regexp_replace(line, '[^A-Z]', '', 'g')) AS nu, len(regexp_replace(line, '[^a-z]', '', 'g')) AS nl,
        regexp_matches(line, '[.!?:;]') AS marked,
        row_number() OVER (PARTITION BY r, line ORDER BY i) AS nth
      FROM (SELECT r, doc_id, unnest(range(1, len(ls) + 1)) AS i, unnest(ls) AS line FROM (SELECT r, doc_id, string_split(text, chr(10)) AS ls FROM d))),
f AS (SELECT *, nw > 0 AND (nth > 1 OR (np >= 3 AND np * 3 >= nw) OR ns * 10 > nc OR (nw >= 5 AND nu * 10 > (nu + nl) * 7)
        OR (nw >= 12 AND NOT marked)
        OR (nw <= 40 AND regexp_matches(line, '(?i)(@phrases@)'))) AS bad FROM l),
s AS (SELECT r, any_value(doc_id) AS doc_id, sum(nw)::BIGINT AS n_words, sum(nc)::BIGINT AS word_chars, sum(ns)::BIGINT AS n_symbols,
        count(*) FILTER (nw > 0 AND nth > 1) AS n_dup_lines, count(*) FILTER (bad) AS n_failed_lines,
        coalesce(sum(nc) FILTER (bad), 0)::BIGINT AS gone FROM f GROUP BY r),
o AS (SELECT s.*, coalesce(cov.n, 0)::BIGINT AS n_repeat_words, CASE WHEN word_chars > 0 THEN gone / word_chars ELSE 0.0 END::DOUBLE AS lost FROM s LEFT JOIN cov USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_failed_lines, lost,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND lost <= 0.3 AS kept
FROM o
""".replace("@phrases@", "|".join(BOILERPLATE).replace("'", "''")).replace("@separators@", SEPARATORS)
