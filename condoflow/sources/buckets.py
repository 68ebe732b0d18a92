"""Tables stored in buckets by a join key, so that joins on it move no row of theirs.

A join of two such tables with the same number of buckets, or of one with a side that is dealt to fit, needs no shuffle of the
stored rows.  That suits facts whose keys are even: a bucket cannot be split at run time, so a table in which one key owns a
large part of the rows is better left to the shuffle, where adaptive execution splits it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_buckets(df: DataFrame, table: str, key: str, buckets: int) -> DataFrame:
    """Store a frame as a catalog table in sorted buckets of ``key``; returns the table.

    Rows are dealt by the key first, so that each bucket is one file instead of one a task.
    """
    df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return df.sparkSession.table(table)


def add_to_buckets(df: DataFrame, table: str, key: str, buckets: int) -> DataFrame:
    """Add rows to such a table; a bucket then has one file more."""
    df.repartition(buckets, key).write.mode("append").bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return df.sparkSession.table(table)
