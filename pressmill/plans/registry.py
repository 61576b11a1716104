"""The archive queries by name, and SQL for those that SQL can express."""

from __future__ import annotations

from pressmill.plans import lens_queries, model_queries, report_queries, state_queries, step_queries, view_queries

MODULES = (report_queries, lens_queries, state_queries, view_queries, model_queries, step_queries)


def queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.SQL.items()}
