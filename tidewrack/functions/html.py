"""Plain text, titles and links of HTML by regular expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_HIDDEN = r"(?is)<(script|style)[^>]*>.*?</(script|style)>|<!--.*?-->"


def visible_text(html: Column) -> Column:
    text = F.regexp_replace(F.regexp_replace(html, _HIDDEN, " "), r"<[^>]*>", " ")
    return F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " "))


def title(html: Column) -> Column:
    return F.regexp_extract(html, r"(?is)<title>(.*?)</title>", 1)


def links(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(r'<a href="([^"]*)"'), F.lit(1))
