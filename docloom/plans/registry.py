"""All queries of the library outside the text-preparation subpackage."""

from __future__ import annotations

from . import assertions, clauses, governance, graph, ledger, likeness, mapping, matching, records, reports, runs, search, structure, texts  # noqa: F401
from .base import ORACLE, QUERIES

FLAGSHIP = "facets_dedup"

__all__ = ["FLAGSHIP", "ORACLE", "QUERIES"]
