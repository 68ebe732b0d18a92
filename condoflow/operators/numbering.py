"""Consecutive numbers over a total order, without one task seeing all rows and without writing anything."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .spread import spread_join

SAMPLE = 4096  # rows of which the borders of the slices are quantiles
MOST_SLICES = 512


def _slices(df: DataFrame) -> int:
    """A power of two of about the number of shuffle partitions."""
    wanted = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return 1 << max(1, min(wanted, MOST_SLICES) - 1).bit_length()


def _borders(keyed: DataFrame, slices: int) -> Column:
    """Quantiles of ``_key`` over a sample of bounded size: the rows with the least hashes, of which every task gives its own."""
    sample = keyed.select("_key").orderBy(F.xxhash64(F.lit(11), "_key")).limit(SAMPLE)
    ordered = sample.agg(F.array_sort(F.collect_list("_key")).alias("_s"))
    cuts = F.sequence(F.lit(1), F.lit(slices - 1))
    return ordered.select(F.transform(cuts, lambda i: F.get("_s", F.floor(i * F.size("_s") / slices).cast("int")))).scalar()


def _with_slice(keyed: DataFrame, slices: int) -> DataFrame:
    """Add ``_slice``, the number of borders below the row's key, by halving."""
    rows, step = keyed.withColumns({"_borders": _borders(keyed, slices), "_slice": F.lit(0)}), slices // 2
    while step:
        above = F.col("_key") > F.get("_borders", F.col("_slice") + (step - 1))
        rows = rows.withColumn("_slice", F.col("_slice") + F.when(above, step).otherwise(0))
        step //= 2
    return rows.drop("_borders")


def dense_numbers(
    df: DataFrame,
    order_by: list[str],
    partition_by: list[str] | None = None,
    name: str = "numero",
) -> DataFrame:
    """Add ``name`` = 1, 2, 3, ... in the order of ``order_by`` within ``partition_by``.

    ``row_number`` would pull a whole group (or the whole table) into one task.
    Here rows fall into slices of the order of group and key, so a hot group is spread over many;
    a row's number is its place in its slice plus the rows of the group in earlier ones, of which
    there is one count per (group, slice).  Rows equal in all of ``order_by`` are ordered by a
    hash of the row, so many of them spread too.

    Borders, places and counts depend on values only, never on where a row lies: a task that runs again numbers
    its rows alike, so nothing has to be stored, and all of it is one lazy plan.
    """
    groups, slices = list(partition_by or []), _slices(df)
    keyed = df.withColumn("_tie", F.xxhash64(*df.columns)).withColumn("_key", F.struct(*groups, *order_by, "_tie"))
    # Groups as one struct: equality of structs takes nulls as equal, and joins on it keep the partitioning of the window.
    rows = _with_slice(keyed, slices).withColumn("_group", F.struct(F.lit(0).alias("_all"), *groups))
    by = ["_group", "_slice"]
    placed = rows.withColumn("_place", F.row_number().over(Window.partitionBy(*by).orderBy("_key")))
    counts = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_count"))
    earlier = Window.partitionBy("_group").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*by, F.coalesce(F.sum("_count").over(earlier), F.lit(0)).alias("_start"))
    return placed.join(starts, by).select(*df.columns, (F.col("_place") + F.col("_start")).alias(name))


def continue_ids(df: DataFrame, existing: DataFrame, id_column: str, order_by: list[str]) -> DataFrame:
    """Number new rows from the largest id in ``existing`` on."""
    numbered = dense_numbers(df, order_by, name="_number")
    last = existing.select(F.coalesce(F.max(id_column), F.lit(0)).cast("bigint")).scalar()
    return numbered.withColumn(id_column, F.col("_number") + last).drop("_number")


def number_after(
    df: DataFrame, taken: DataFrame, group: str, number: str, order_by: list[str]
) -> DataFrame:
    """Number rows within ``group``, starting after the largest number already taken there."""
    last = taken.groupBy(group).agg(F.max(number).alias("_last"))
    numbered = dense_numbers(df, order_by, [group], name=number)
    return (
        spread_join(numbered, last, [group], [number], "left")
        .withColumn(number, F.col(number) + F.coalesce("_last", F.lit(0)))
        .drop("_last")
    )


def join_by_position(left: DataFrame, right: DataFrame, left_order: list[str], right_order: list[str]) -> DataFrame:
    """Pair the k-th row of one frame with the k-th row of the other."""
    return dense_numbers(left, left_order, name="posicion").join(
        dense_numbers(right, right_order, name="posicion"), "posicion"
    )
