"""Everything that can be run by name."""

from __future__ import annotations

from trailmart.plans import bi_queries, legacy_queries, mart_queries, pipeline_queries, problems, relational_queries, report_queries

MODULES = (mart_queries, bi_queries, legacy_queries, pipeline_queries, report_queries, relational_queries, problems)


def queries() -> dict:
    return {name: f for module in MODULES for name, f in module.queries().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.oracle_sql().items()}
