"""All queries of the core library and their SQL."""

from __future__ import annotations

from archivolt.plans import document_queries, list_queries, problems, report_queries, score_queries, state_queries, stream_queries, text_queries, web_queries

_MODULES = [problems, text_queries, score_queries, report_queries, list_queries, web_queries, document_queries, state_queries, stream_queries]


def queries() -> dict:
    return {k: f for m in _MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {k: s for m in _MODULES for k, s in m.ORACLE.items()}
