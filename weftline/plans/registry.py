"""All queries of the core, by name, with their SQL."""

from __future__ import annotations

from weftline.plans import assembly_queries, catalogue_queries, data_queries, growth_queries, market_queries, model_queries, report_queries, run_queries, supply_queries, text_queries, whole_queries

_MODULES = (assembly_queries, catalogue_queries, data_queries, growth_queries, market_queries, model_queries, report_queries, run_queries, supply_queries, text_queries, whole_queries)
QUERIES: dict = {k: v for m in _MODULES for k, v in m.QUERIES.items()}
SQL: dict = {k: v for m in _MODULES for k, v in m.SQL.items()}
FLAGSHIP = "growth_score"
