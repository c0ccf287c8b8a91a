"""The registered queries and the SQL they are checked against."""

from __future__ import annotations

from tidemark.plans import align_queries, assembly_queries, event_table_queries, evidence_queries, label_queries, model_queries, more_queries, rolling_queries, table_queries, text_queries

MODULES = (rolling_queries, align_queries, label_queries, model_queries, more_queries, table_queries, assembly_queries, text_queries, evidence_queries, event_table_queries)
QUERIES = {name: query for m in MODULES for name, query in m.QUERIES.items()}
ORACLE = {name: sql for m in MODULES for name, sql in m.ORACLE.items()}
FLAGSHIP = "trend_axis"
