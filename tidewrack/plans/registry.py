"""All queries of the core engine and their SQL."""

from __future__ import annotations

from . import aggregates, changes, joins, reshape, scalars, scripts, sets, sources, streams, texts, windows  # noqa: F401  (they register)
from .query import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
