"""Mixing sources to target weights by weighted fair queueing.

The documents of a source queue in the order of a hash.  A document's virtual finish time is the number of its source's tokens up
to its end, divided by the source's target; a second pass over a source continues where the first ended.  The mix takes documents
in the order of their finish times until the total budget is spent, so at any moment the sources stand in their target proportions.

Running sums come from two levels, sums of hash ranges and a window inside each, so no task sees a whole source.

Defined results: null text has no tokens; a null source is a source of its own, after all others; empty documents are never taken; an
empty table gives no rows; rows equal in id and text are taken in turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from condoflow.llm.common import staged

WEIGHTS = (3, 1, 2)  # repeat over the sources in order
SHARE = 1.5  # of all tokens that the mix holds
PASSES = 2  # times a document may be taken
SLICES = 10_000  # of the finish times that are summed before the cut is sought in one of them


def targets(sizes: DataFrame) -> DataFrame:
    """Target of each source: shares by weight, capped at PASSES times its size, the excess shared again by weight.

    ``sizes`` has one row per source (``no_source``, ``source``, ``source_size``), so its windows span the sources only.
    """
    order = Window.orderBy("no_source", "source")
    weights = F.array(*(F.lit(float(w)) for w in WEIGHTS))
    ranked = sizes.select(
        "*", F.get(weights, (F.row_number().over(order) - 1) % len(WEIGHTS)).alias("weight"),
        (F.col("source_size") * float(PASSES)).alias("cap"), (F.sum("source_size").over(Window.partitionBy()) * SHARE).alias("budget"))
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "no_source", "source")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    # the level that spends the budget if this source is the first one not capped
    level = (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    tried = ranked.withColumn("level", level)
    right = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "no_source", "source", "level"))).over(Window.partitionBy())
    return tried.withColumn("at", right["level"]).select(
        "no_source", "source", "source_size", "budget",
        F.least("cap", F.coalesce(F.col("at") * F.col("weight"), "cap")).alias("target"))


def queue_key(id_col: str) -> Column:
    return F.md5(F.concat(F.lit("queue "), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))).cast("binary"))


def mix_sources(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: ``doc`` (its id), ``th`` (hash of its text), ``size``, ``source_size``, ``target`` and ``passes`` (times it is taken)."""
    text = F.col(f"`{text_col}`")
    rows = staged(documents.select(
        F.col(f"`{id_col}`").alias("doc"), F.xxhash64(text).alias("th"), F.col(f"`{source_col}`").isNull().alias("no_source"),
        F.coalesce(F.col(f"`{source_col}`").cast("string"), F.lit("")).alias("source"), queue_key(id_col).alias("turn"),
        F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"),
    ).withColumn("slice", F.substring("turn", 1, 3)))
    sums = staged(rows.groupBy("no_source", "source", "slice").agg(F.sum("size").alias("slice_size")))
    aim = staged(targets(sums.groupBy("no_source", "source").agg(F.sum("slice_size").alias("source_size"))))
    earlier = Window.partitionBy("no_source", "source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    start = sums.withColumn("before", F.coalesce(F.sum("slice_size").over(earlier), F.lit(0))).join(aim, ["no_source", "source"])
    own = Window.partitionBy("no_source", "source", "slice").orderBy("turn", "th").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    queued = (
        rows.withColumn("within", F.sum("size").over(own)).join(start, ["no_source", "source", "slice"])
        .withColumn("end", F.col("before") + F.col("within"))
        .select("doc", "th", "no_source", "source", "turn", "size", "source_size", "target", "budget", "end",
                *((F.try_divide(F.col("end") + p * F.col("source_size"), "target")).alias(f"finish{p}") for p in range(PASSES)))
    )
    queued = staged(queued)
    takes = queued.where("size > 0").select(
        "no_source", "source", "turn", "end", "size", "budget", F.explode(F.array(*(f"finish{p}" for p in range(PASSES)))).alias("finish")
    ).withColumn("part", F.least(F.floor(F.col("finish") * (SLICES // 2)), F.lit(SLICES)))
    parts = takes.groupBy("part").agg(F.sum("size").alias("part_size"), F.max("budget").alias("budget"))
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    last = (
        parts.withColumn("spent", F.coalesce(F.sum("part_size").over(upto), F.lit(0))).where("spent <= budget")
        .orderBy(F.desc("part")).select("part", "spent").first()
    )
    empty = F.lit(0)
    if last is None:
        return queued.select("doc", "th", "size", "source_size", F.coalesce("target", F.lit(0.0)).alias("target"), empty.alias("passes"))
    place = F.struct("finish", "no_source", "source", "end", "turn")
    running = Window.orderBy("finish", "no_source", "source", "end", "turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = (
        takes.where(F.col("part") == last["part"]).withColumn("spent", F.sum("size").over(running) + last["spent"])
        .where("spent <= budget").agg(F.max(place).alias("cut")).first()["cut"]
    )
    within = empty
    for p in range(PASSES):
        part = F.least(F.floor(F.col(f"finish{p}") * (SLICES // 2)), F.lit(SLICES))
        taken = part < last["part"]
        if cut is not None:
            mine = F.struct(F.col(f"finish{p}").alias("finish"), "no_source", "source", "end", "turn")
            limit = F.struct(*(F.lit(v).cast(t).alias(n) for v, t, n in zip(
                cut, ("double", "boolean", "string", "long", "string"), ("finish", "no_source", "source", "end", "turn"))))
            taken = taken | ((part == last["part"]) & (mine <= limit))
        within = within + F.when(taken & (F.col("size") > 0), 1).otherwise(0)
    return queued.select("doc", "th", "size", "source_size", F.coalesce("target", F.lit(0.0)).alias("target"), within.alias("passes"))


def op7_mixing(documents: DataFrame) -> DataFrame:
    """Words that the mix takes from each document."""
    return mix_sources(documents).select(
        F.col("doc").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("passes")).cast("long").alias("taken"))


OP7_SQL = r"""
WITH sized AS (SELECT doc_id, source IS NULL AS no_source, coalesce(source, '') AS source,
  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
  md5('queue ' || coalesce(doc_id::VARCHAR, '')) AS turn FROM documents),
sizes AS (SELECT no_source, source, sum(size)::BIGINT AS source_size FROM sized GROUP BY ALL),
ranked AS (SELECT *, [3.0::DOUBLE, 1.0, 2.0][1 + (row_number() OVER (ORDER BY no_source, source) - 1) % 3] AS weight,
  source_size * 2.0::DOUBLE AS cap, sum(source_size) OVER () * 1.5::DOUBLE AS budget FROM sizes),
tried AS (SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY cap / weight, no_source, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(weight) OVER (ORDER BY cap / weight, no_source, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM ranked),
chosen AS (SELECT arg_min(level, cap / weight) AS level FROM tried WHERE level * weight <= cap),
aims AS (SELECT no_source, source, source_size, budget, least(cap, coalesce((SELECT level FROM chosen) * weight, cap)) AS target FROM tried),
queued AS (SELECT sized.*, source_size, budget, target,
  sum(size) OVER (PARTITION BY no_source, source ORDER BY turn ROWS UNBOUNDED PRECEDING)::BIGINT AS until FROM sized JOIN aims USING (no_source, source)),
takes AS (SELECT doc_id, size, budget, no_source, source, until, turn, (until + p * source_size) / target AS finish
  FROM queued, (SELECT unnest([0, 1]) AS p) WHERE size > 0),
spent AS (SELECT doc_id, size, budget, sum(size) OVER (ORDER BY finish, no_source, source, until, turn ROWS UNBOUNDED PRECEDING) AS total FROM takes),
taken AS (SELECT doc_id, sum(size)::BIGINT AS n FROM spent WHERE total <= budget GROUP BY doc_id)
SELECT doc_id, size, source_size, target, coalesce(n, 0)::BIGINT AS taken FROM queued LEFT JOIN taken USING (doc_id)"""
