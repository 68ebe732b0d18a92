"""Table maintenance without MERGE: each operator returns the new content of the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import key_text
from .spread import spread_join


def upsert(current: DataFrame, incoming: DataFrame, name: str, values: list[str]) -> DataFrame:
    """Rows of both frames by ``name``; incoming values win unless they are null.

    Incoming rows without a name are skipped, and several incoming rows of one
    name count once (the row that sorts last), so a re-import adds nothing.
    """
    new = (
        incoming.filter(F.trim(name) != "")
        .groupBy(key_text(F.col(name)).alias("_key"))
        .agg(F.max(F.struct(F.trim(name).alias("name"), *values)).alias("_new"))
    )
    old = current.withColumn("_key", key_text(F.col(name)))
    others = [c for c in current.columns if c != name and c not in values]
    return old.join(new, "_key", "full_outer").select(
        *others,
        F.coalesce(F.col(name), F.col("_new.name")).alias(name),
        *[F.coalesce(F.col(f"_new.{v}"), F.col(v)).alias(v) for v in values],
    )


def fill_nulls_from(current: DataFrame, source: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Fill null ``values`` of the table from the matching source row; keep the others.

    The source is reduced to one row per key first, so no row is multiplied.
    """
    given = source.groupBy(*keys).agg(*[F.max(v).alias(f"_{v}") for v in values])
    filled = {v: F.coalesce(F.col(v), F.col(f"_{v}")) for v in values}
    return spread_join(current, given, keys, current.columns, "left").withColumns(filled).select(*current.columns)


def absent_rows(rows: DataFrame, existing: DataFrame, on: list[str] | Column) -> DataFrame:
    """Rows whose key the table does not hold yet."""
    return rows.join(existing, on, "left_anti")


def seed_if_absent(existing: DataFrame, seeds: DataFrame, key: str) -> DataFrame:
    """The table plus the seed rows it lacks."""
    missing = absent_rows(seeds, existing.select(key), [key])
    return existing.unionByName(missing, allowMissingColumns=True)


def discover_parents(children: DataFrame, parents: DataFrame, name: str, placeholder: str) -> DataFrame:
    """Parent rows for the distinct child names no parent has, with a placeholder address."""
    names = children.select(F.trim(name).alias(name)).filter(F.col(name) != "").distinct()
    known = parents.select(key_text(F.col(name)).alias("_known"))
    return names.join(known, key_text(F.col(name)) == F.col("_known"), "left_anti").withColumn(
        "direccion", F.lit(placeholder)
    )


def scalar_lookup(rows: DataFrame, names: DataFrame, name: str, key: str) -> DataFrame:
    """Add the parent's ``key`` by trimmed name, null when no parent has that name."""
    found = names.groupBy(key_text(F.col(name)).alias("_name")).agg(F.min(key).alias(key))
    named = rows.withColumn("_name", key_text(F.col(name)))
    return spread_join(named, found, ["_name"], rows.columns, "left").drop("_name")


def drop_all_duplicates(df: DataFrame, key: str) -> DataFrame:
    """Drop every row whose key occurs more than once; rows without a key all stay.

    One aggregation with map-side combine: copies of a hot key meet before the
    shuffle.  Rows without a key pass by without one.
    """
    lone = (
        df.groupBy(F.rtrim(key).alias("_key"))
        .agg(F.count(F.lit(1)).alias("_n"), F.any_value(F.struct(*df.columns)).alias("_row"))
        .filter("_n = 1 and _key is not null")
        .select("_row.*")
    )
    return lone.unionByName(df.filter(F.col(key).isNull()))


def drop_blank_rows(df: DataFrame) -> DataFrame:
    """Drop rows in which every column is null or blank."""
    filled = [F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) != "" for c in df.columns]
    any_filled = filled[0]
    for condition in filled[1:]:
        any_filled = any_filled | condition
    return df.filter(any_filled)


def require_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Drop rows with a null or blank key column."""
    for k in keys:
        df = df.filter(F.trim(F.col(k).cast("string")) != "")
    return df
