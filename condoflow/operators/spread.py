"""Joins with one aggregated row per key, when a key may own a large part of the other side."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

COPIES = 4


def spread_join(
    big: DataFrame, per_key: DataFrame, keys: list[str], spread_by: list[str], how: str = "inner"
) -> DataFrame:
    """Join ``big`` with ``per_key``, the result of an aggregation by ``keys``, salted.

    Joined plainly, the aggregate keeps its partitioning and gets no shuffle of
    its own, and AQE splits skewed partitions only between two shuffles: all
    rows of a hot key would meet in one task.  With a few copies of each
    aggregated row the join key has a salt, which spreads the key and gives both
    sides a shuffle, so that AQE can split what is still too large.
    The salt is a hash of the columns ``spread_by``, which tell rows of a key
    apart.  ``how`` is inner or left.
    """
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(COPIES)).cast("int"))
    copies = per_key.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
    return salted.join(copies, [*keys, "_salt"], how).drop("_salt")
