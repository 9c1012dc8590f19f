"""The operators and jobs as named queries over the given tables."""

from __future__ import annotations


def _load():
    from opsledger.catalog import q_tables, q_scalars, q_relational, q_domain, registry  # noqa: F401
    return registry


def all_queries() -> dict:
    return dict(_load().QUERIES)


def all_sql() -> dict[str, str]:
    return dict(_load().SQL)
