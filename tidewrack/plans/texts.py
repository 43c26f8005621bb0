"""Text and HTML queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.html import links, title, visible_text
from .query import query

_SPACE = r"[\x20\x09-\x0D]+"


@query("SELECT doc_id FROM documents WHERE regexp_matches(text, '[0-9]{3}\\.[0-9]{1,3}\\.[0-9]{1,3}\\.[0-9]{1,3}')".replace("\\\\", "\\"))
def text_regex(t):
    return t.documents.where(F.col("text").rlike(r"[0-9]{3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}")).select("doc_id")


@query(r"SELECT w, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS w FROM documents) GROUP BY w HAVING count(*) >= 50")
def text_word_counts(t):
    words = t.documents.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("w"))
    return words.groupBy("w").agg(F.count("*").alias("n")).where("n >= 50")


_TERMS = ("the", "of", "und", "licensed")


@query(f"""
SELECT doc_id, matches, terms FROM (SELECT doc_id, count(*) AS matches, count(DISTINCT w) AS terms FROM
(SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS w FROM documents) WHERE w IN {_TERMS} GROUP BY doc_id) ORDER BY terms DESC, matches DESC, doc_id LIMIT 20""")
def text_term_search(t):
    """The twenty documents that hold most of the terms, then the most matches."""
    words = t.documents.select("doc_id", F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("w")).where(F.col("w").isin(*_TERMS))
    found = words.groupBy("doc_id").agg(F.count("*").alias("matches"), F.count_distinct("w").alias("terms"))
    return found.orderBy(F.desc("terms"), F.desc("matches"), "doc_id").limit(20)


@query("SELECT min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY sha256(text)")
def text_exact_copies(t):
    return t.documents.groupBy(F.sha2("text", 256).alias("h")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies")).drop("h")


@query(r"SELECT page_id, regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS title, len(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1)) AS links FROM pages".replace('\\"', '"'))
def html_titles_and_links(t):
    return t.pages.select("page_id", title(F.col("html")).alias("title"), F.size(links(F.col("html"))).cast("bigint").alias("links"))


@query(r"""
SELECT page_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>|<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'), '[\x20\x09-\x0D]+', ' ', 'g'))) AS digest FROM pages""")
def html_visible_text(t):
    return t.pages.select("page_id", F.md5(visible_text(F.col("html"))).alias("digest"))


@query("SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS host, count(*) AS pages FROM pages GROUP BY ALL")
def html_hosts(t):
    return t.pages.groupBy(F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host")).agg(F.count("*").alias("pages"))
