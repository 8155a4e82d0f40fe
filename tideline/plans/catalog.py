"""All queries of the library's own operators, and the SQL that each must agree with."""

from __future__ import annotations

from . import document_queries, duplicate_queries, history_queries, reconcile_queries, section_queries, segment_queries, source_queries

_PARTS = [duplicate_queries, history_queries, document_queries, segment_queries, section_queries, reconcile_queries, source_queries]

QUERIES = {name: query for part in _PARTS for name, query in part.QUERIES.items()}
ORACLES = {name: text for part in _PARTS for name, text in part.ORACLES.items()}
