"""All registered queries and their DuckDB oracles, keyed by name."""

from __future__ import annotations

from quarry.plans import catalog_queries, change_queries, column_queries, discovery_queries, entity_queries, ingest_queries, lineage_queries

_MODULES = [ingest_queries, catalog_queries, entity_queries, lineage_queries, discovery_queries, column_queries,
            change_queries]


def all_queries():
    out = {}
    for m in _MODULES:
        out.update(m.QUERIES)
    return out


def all_oracles():
    out = {}
    for m in _MODULES:
        out.update(m.ORACLE)
    return out
