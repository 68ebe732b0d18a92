"""Integrity rules, as violation frames (regla, clave) with one row per broken key, or counted together in one pass."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def _as_violations(df: DataFrame, rule: str, key: Column) -> DataFrame:
    return df.select(F.lit(rule).alias("regla"), key.cast("string").alias("clave"))


def not_null(df: DataFrame, rule: str, column: str, key: str) -> DataFrame:
    return _as_violations(df.filter(F.col(column).isNull()), rule, F.col(key))


def unique(df: DataFrame, rule: str, column: str) -> DataFrame:
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    return _as_violations(counts.filter(F.col("_n") > 1), rule, F.col(column))


def references(df: DataFrame, rule: str, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Distinct values of ``column`` that no parent row has.

    Both sides are reduced to distinct values first, so a value that fills a
    large part of either table is one row by the time they meet.
    """
    values = df.select(F.col(column).alias("_value")).filter(F.col("_value").isNotNull()).distinct()
    orphans = values.join(
        parent.select(F.col(parent_key).alias("_parent")).distinct(), F.col("_value") == F.col("_parent"), "left_anti"
    )
    return _as_violations(orphans, rule, F.col("_value"))


def check(df: DataFrame, rule: str, condition: Column, key: str) -> DataFrame:
    """Rows for which the condition is false; an unknown condition passes, as in SQL."""
    return _as_violations(df.filter(~condition), rule, F.col(key))


def valid_invoice(number: Column) -> Column:
    return number.rlike("^[0-9]{10}$") & (number != "0000000000")


def summarize(violations: list[DataFrame]) -> DataFrame:
    """Violations per rule; rules nobody breaks are left out."""
    every = reduce(DataFrame.unionByName, violations)
    return every.groupBy("regla").agg(F.count(F.lit(1)).alias("violaciones"))


@dataclass(frozen=True)
class Rule:
    """What a row of some table says about a rule: an entry with ``key`` where ``when`` holds.

    ROW entries are violations by themselves, the key of UNIQUE entries may occur once, and a CHILD key needs a
    PARENT entry of the same rule, from whatever table.
    """

    name: str
    kind: int
    key: Column
    when: Column


ROW, UNIQUE, CHILD, PARENT = 0, 1, 2, 3


def must_hold(name: str, condition: Column) -> Rule:
    """Rows for which the condition is false break the rule; an unknown condition passes, as in SQL."""
    return Rule(name, ROW, F.lit(None).cast("string"), ~condition)


def must_be_unique(name: str, column: Column) -> Rule:
    return Rule(name, UNIQUE, column, column.isNotNull())


def must_exist(name: str, column: Column) -> Rule:
    return Rule(name, CHILD, column, column.isNotNull())


def gives(name: str, column: Column, when: Column | None = None) -> Rule:
    """The parent side of a ``must_exist`` rule."""
    return Rule(name, PARENT, column, column.isNotNull() if when is None else column.isNotNull() & when)


def count_violations(checked: list[tuple[DataFrame, list[Rule]]]) -> DataFrame:
    """Violations per rule, with one scan of each frame and one aggregation for all rules; rules nobody breaks are left out.

    Every row becomes its entries (rule, key), and entries meet by rule and key after map-side combining, so that a
    key that fills a large part of a table is one row a task by then; violations by row have no key and are counted at once.
    """
    def entries(df: DataFrame, rules: list[Rule]) -> DataFrame:
        each = [
            F.when(r.when, F.struct(F.lit(r.name).alias("regla"), F.lit(r.kind).alias("_kind"), r.key.cast("string").alias("clave")))
            for r in rules
        ]
        return df.select(F.inline(F.array_compact(F.array(*each))))

    every = reduce(DataFrame.unionByName, [entries(df, rules) for df, rules in checked])
    by_key = every.groupBy("regla", "clave").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_kind").alias("_kind"), F.max(F.when(F.col("_kind") == PARENT, 1)).alias("_parent")
    )
    broken = (
        F.when(F.col("_kind") == ROW, F.col("_n"))
        .when(F.col("_kind") == UNIQUE, (F.col("_n") > 1).cast("bigint"))
        .when(F.col("_kind") == CHILD, F.col("_parent").isNull().cast("bigint"))
    )
    return by_key.groupBy("regla").agg(F.sum(broken).alias("violaciones")).filter("violaciones > 0")


def joined_count(sides: list[DataFrame], key: str) -> DataFrame:
    """(registros) rows that the inner join of the sides on ``key`` would have, from the counts of each key; nothing is joined by row."""
    counted = [s.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(f"_n{i}")) for i, s in enumerate(sides)]
    met = reduce(lambda a, b: a.join(b, key), counted)
    product = reduce(lambda a, b: a * b, [F.col(f"_n{i}") for i in range(len(sides))])
    return met.agg(F.coalesce(F.sum(product), F.lit(0)).alias("registros"))


def audit_counts(tables: dict[str, DataFrame], counted: dict[str, DataFrame] | None = None) -> DataFrame:
    """Row count per table; ``counted`` holds frames that are their own count (``registros``) already."""
    counts = {name: df.agg(F.count(F.lit(1)).alias("registros")) for name, df in tables.items()} | (counted or {})
    named = [df.select(F.lit(name).alias("tabla"), F.col("registros").cast("bigint").alias("registros")) for name, df in counts.items()]
    return reduce(DataFrame.unionByName, named)
