"""Imports every query module so their ``@query`` registrations run."""

from __future__ import annotations

from . import catalog


def _load():
    from . import analysis_queries, billing_queries, entity_queries, load_queries, migration_queries, roster_queries, shipped_queries, source_queries  # noqa: F401


def all_queries():
    _load()
    return catalog.QUERIES


def all_oracle_sql():
    _load()
    return catalog.ORACLE_SQL
