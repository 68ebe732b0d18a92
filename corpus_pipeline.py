"""From raw documents to shards: toxicity, near-duplicates, benchmark passages, source mix, shards.

Each stage gets all rows that the one before it kept, and all but the last return the columns they got.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from condoflow.llm.common import id_key, staged, table
from condoflow.llm.decontaminate import find_benchmark
from condoflow.llm.minhash import near_duplicates
from condoflow.llm.mixing import mix_sources
from condoflow.llm.sharding import shard_documents
from condoflow.llm.toxicity import crc_of_id, fit, score_toxicity

ORACLE_SQL = None  # the models and the hashing of the first two stages have no SQL form; tests compare with plain versions


def whole_rows(docs: DataFrame) -> DataFrame:
    """Each row as one value beside its text, so that no column name can clash inside an operator."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("text").alias("text"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5; the models learn from the labelled ones outside the held-out fold."""
    model = fit(docs, table(spark, sf_dir, "labels"), F.pmod(crc_of_id("doc_id"), F.lit(5)) != 0)
    return score_toxicity(whole_rows(docs), model, id_col="row").where("score < 0.5").select("doc.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near-duplicates; texts without words belong to no group and stay."""
    has_words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    first = near_duplicates(docs).where("leads and n_shingles > 0").select(F.col("d").alias("_d"), F.col("th").alias("_th")).distinct()
    rows = docs.where(has_words).select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), id_key("doc_id").alias("_d"), F.xxhash64("text").alias("_th"))
    kept = rows.join(first, ["_d", "_th"], "left_semi").dropDuplicates(["_d", "_th"]).select("row.*")
    return kept.unionByName(docs.where(~has_words))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    found = find_benchmark(whole_rows(docs), table(spark, sf_dir, "benchmark"), id_col="row")
    return found.where(F.size("spans") == 0).select("doc.*")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not, once or twice."""
    nth = F.row_number().over(Window.partitionBy("_d", "_th").orderBy("_d"))
    taken = mix_sources(docs).where("passes > 0").select(
        id_key("doc").alias("_d"), F.coalesce("th", F.lit(0)).alias("_th"), "passes").withColumn("_n", nth)
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), id_key("doc_id").alias("_d"),
        F.coalesce(F.xxhash64("text"), F.lit(0)).alias("_th")).withColumn("_n", nth)
    times = F.explode(F.sequence(F.lit(1), "passes"))
    return rows.join(taken, ["_d", "_th", "_n"]).select("row", times.alias("time")).select("row.*")


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard of 24 and their place in it."""
    placed = shard_documents(whole_rows(docs), 24, id_col="row")
    return placed.select("doc.*", "shard", F.col("slot").cast("long").alias("slot"))


STAGES = [
    ("toxicity", toxicity), ("near duplicates", near_dedup), ("benchmark decontamination", decontamination),
    ("mixing", mixing), ("sharding", sharding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
