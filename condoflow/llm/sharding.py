"""Shards of near equal size from ordered atomic groups: minimax contiguous partition.

Rows of equal text form a group that stays whole.  Groups are ordered by the hash of their text.  The smallest capacity with which
a greedy pass over the order needs no more than the wanted number of shards is found by search; each step tries several
capacities at once, and one greedy step is one aggregate over a narrow, pruned range of the groups' running sums.  The
groups at which the greedy pass cuts are then limits on the hash, so a row finds its shard without a join.

Everything is DataFrame expressions; the driver sees sums and at most one limit per shard.

Defined results: null text has no bytes and belongs to the group of the empty text; repeated rows take a slot each; an empty table
gives no rows; a group larger than an even share fills a shard of its own, and later shards may then stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from condoflow.llm.common import staged

OVERHEAD = 8  # bytes each row takes besides its text
TRIES = 48  # capacities tried at once
CELL_ROWS = 50_000  # rows numbered in one window


def group_ends(rows: DataFrame) -> DataFrame:
    """Groups with the running sum of sizes up to their end, in the order of their key."""
    groups = rows.groupBy("key").agg(F.sum("size").alias("size"), F.count("*").alias("n")).withColumn("range", F.substring("key", 1, 3))
    groups = staged(groups)
    ranges = groups.groupBy("range").agg(F.sum("size").alias("range_size"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("before", F.coalesce(F.sum("range_size").over(before), F.lit(0)))  # at most 4096 rows
    own = Window.partitionBy("range").orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = groups.withColumn("within", F.sum("size").over(own)).join(ranges, "range").select(
        "key", "size", "n", (F.col("before") + F.col("within")).alias("end"))
    return staged(ends.repartitionByRange("end").sortWithinPartitions("end"))


def greedy(ends: DataFrame, capacities: list[int], shards: int, largest: int, total: int) -> dict[int, list[int]]:
    """Ends of the shards a greedy pass makes with each capacity, at most ``shards`` of them."""
    cuts: dict[int, list[int]] = {c: [] for c in capacities}
    for _ in range(shards):
        open_ = [c for c in capacities if (cuts[c] or [0])[-1] < total]
        if not open_:
            break
        reach = {c: (cuts[c] or [0])[-1] + c for c in open_}
        # a group ends within ``largest`` bytes below any reach
        near = ends.where(F.col("end").between(min(reach.values()) - largest, max(reach.values())))
        best = near.agg(*(F.max(F.when(F.col("end") <= r, F.col("end"))).alias(f"c{c}") for c, r in reach.items())).first()
        for c in open_:
            cuts[c].append(best[f"c{c}"])
    return cuts


def smallest_capacity(ends: DataFrame, shards: int) -> tuple[int, list[int]]:
    """Least capacity that needs no more than ``shards`` shards, and the ends of these shards."""
    total, largest = ends.agg(F.max("end"), F.max("size")).first()
    if total is None:
        return 0, []
    low = max(-(-total // shards), largest)
    high = -(-total // shards) + largest  # always enough: no shard but the last is filled less than to an even share
    cuts: list[int] = []
    while True:
        step = max(1, (high - low) // TRIES)
        tries = sorted({*range(low, high, step), high})
        made = greedy(ends, tries, shards, largest, total)
        fits = [c for c in tries if made[c][-1] == total]
        high, cuts = fits[0], made[fits[0]]
        if step == 1 or high == low:
            return high, cuts
        low = max([c for c in tries if c < high], default=high - 1) + 1


def shard_documents(documents: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc`` (its id), ``size`` (bytes), ``crc`` (of the text), ``shard`` and ``slot`` (gapless from 0 in its shard)."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")
    rows = documents.select(
        F.col(f"`{id_col}`").alias("doc"), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text).alias("crc"), F.md5(text).alias("key"))
    ends = group_ends(rows.select("key", "size"))
    _, cuts = smallest_capacity(ends, shards)
    limits = [r[0] for r in ends.where(F.col("end").isin(cuts)).orderBy("end").select("key").collect()]  # at most one per shard
    n_rows = ends.agg(F.sum("n")).first()[0] or 0
    cells = max(1, n_rows // (shards * CELL_ROWS))
    limits = F.array(*(F.lit(k) for k in limits[:-1])) if len(limits) > 1 else F.expr("cast(array() as array<string>)")
    dealt = rows.withColumn("shard", F.size(F.filter(limits, lambda k: k < F.col("key")))).withColumn(
        "cell", F.pmod(F.xxhash64("doc", "key"), F.lit(cells)).cast("int"))
    held = dealt.groupBy("shard", "cell").agg(F.count("*").alias("held"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    held = held.withColumn("before", F.coalesce(F.sum("held").over(before), F.lit(0)))
    own = Window.partitionBy("shard", "cell").orderBy("doc", "key")
    return dealt.withColumn("nth", F.row_number().over(own)).join(held, ["shard", "cell"]).select(
        "doc", "size", "crc", "key", "shard", (F.col("before") + F.col("nth") - 1).alias("slot"))


def op9_sharding(documents: DataFrame) -> DataFrame:
    """Shard and slot of each document by the law of near equal bytes; equal texts share a shard."""
    return shard_documents(documents, 24).select(
        F.col("doc").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
