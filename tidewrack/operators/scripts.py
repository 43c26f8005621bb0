"""Several SQL statements in one text."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

_PIECE = re.compile(r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`|--[^\n]*|/\*.*?\*/|;|[^;'"`/-]+|.""", re.DOTALL)


@dataclass
class Result:
    """What one statement gave: a DataFrame, or the error that it raised."""

    statement: str
    rows: DataFrame | None = None
    error: PySparkException | None = None


def statements(script: str) -> list[str]:
    """The parts between semicolons that are outside of quotes and comments; comments go, and so do empty parts."""
    parts = [""]
    for piece in _PIECE.findall(script):
        if piece == ";":
            parts.append("")
        elif piece.startswith(("--", "/*")) and len(piece) > 1:
            parts[-1] += " "
        else:
            parts[-1] += piece
    return [p.strip() for p in parts if p.strip()]


def run_script(spark: SparkSession, script: str, *, go_on: bool = False) -> list[Result]:
    """Each statement's result, in order.  An error stops the script, unless `go_on`; either way it is in the last result or its own.

    Statements see the session's temporary views, and those of the statements
    before them.  Queries run when their DataFrame is used; other statements run at once.
    """
    out = []
    for statement in statements(script):
        try:
            out.append(Result(statement, spark.sql(statement)))
        except PySparkException as e:
            out.append(Result(statement, error=e))
            if not go_on:
                break
    return out
