"""Queries over the star-schema test tables, with the SQL that checks them."""

from __future__ import annotations

from . import inputs, tables, jobs, report_queries  # noqa: F401  importing registers the queries
from .base import ORACLE, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLE)
