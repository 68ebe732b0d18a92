"""The text operators as queries over the given tables, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from condoflow.llm.common import table
from condoflow.llm.decontaminate import op10_decontaminate
from condoflow.llm.language_id import op8_language_id
from condoflow.llm.minhash import op5_minhash_dedup
from condoflow.llm.mixing import OP7_SQL, op7_mixing
from condoflow.llm.nearest import op11_nearest_neighbours
from condoflow.llm.quality_rules import op6_quality_rules, op6_sql
from condoflow.llm.ranked_search import OP13_SQL, op13_ranked_search
from condoflow.llm.recompression import op4_substring_dedup
from condoflow.llm.sharding import op9_sharding
from condoflow.llm.suffix_dedup import op1_suffix_dedup
from condoflow.llm.toxicity import op2_toxicity
from condoflow.llm.whitening import op12_embedding_whitening
from condoflow.llm.wrappers import op3_html_extraction


def on_documents(operator: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: operator(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_suffix_dedup": on_documents(op1_suffix_dedup),
        "op2_toxicity": lambda spark, sf_dir: op2_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
        "op3_html_extraction": lambda spark, sf_dir: op3_html_extraction(table(spark, sf_dir, "pages")),
        "op4_substring_dedup": on_documents(op4_substring_dedup),
        "op5_minhash_dedup": on_documents(op5_minhash_dedup),
        "op6_quality_rules": on_documents(op6_quality_rules),
        "op7_mixing": on_documents(op7_mixing),
        "op8_language_id": on_documents(op8_language_id),
        "op9_sharding": on_documents(op9_sharding),
        "op10_decontaminate": lambda spark, sf_dir: op10_decontaminate(
            table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")),
        "op11_nearest_neighbours": lambda spark, sf_dir: op11_nearest_neighbours(table(spark, sf_dir, "embeddings")),
        "op12_embedding_whitening": lambda spark, sf_dir: op12_embedding_whitening(table(spark, sf_dir, "embeddings")),
        "op13_ranked_search": lambda spark, sf_dir: op13_ranked_search(
            table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")),
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {"op6_quality_rules": op6_sql(), "op7_mixing": OP7_SQL, "op13_ranked_search": OP13_SQL}
