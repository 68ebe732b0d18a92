"""First rows of a total order."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def largest(rows: DataFrame, n: int, measure: str, ties: list[str]) -> DataFrame:
    """The n rows of largest measure; equal ones in the order of ``ties``."""
    return rows.orderBy(F.desc(measure), *ties).limit(n)


def first_rows(rows: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    return rows.orderBy(*order_by).limit(n)
