"""Registered queries of the operators, with the public vocabularies as parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    op1_topk,
    op2_linededup,
    op3_minhash,
    op4_packing,
    op5_license,
    op6_quality,
    op7_bpe,
    op8_toxicity,
    op9_binary,
    op10_sharding,
    op11_decontaminate,
    op12_merkle,
    op13_align,
)


def _vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_topk_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1_topk.top_k(_table(spark, sf_dir, "embeddings"))


def op2_linededup_patience(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_linededup.report(_table(spark, sf_dir, "documents"))


def op3_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_minhash.near_duplicates(_table(spark, sf_dir, "documents"), k=3, percent=85)


def op4_packing_nnls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_packing.digest(_table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_license.scan(_table(spark, sf_dir, "documents"))


def op6_quality_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_quality.judge(_table(spark, sf_dir, "documents"))


def op7_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return op7_bpe.digest(_table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_multi_50k.tiktoken"),
                          public_tokenizers.PATTERN)


def op8_toxicity_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_toxicity.score_documents(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")).drop("passages")


def op10_sharding_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_sharding.assign(_table(spark, sf_dir, "documents"))


def op9_binary_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_binary.digest(_table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"))


def op11_decontaminate_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_decontaminate.digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_merkle_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_merkle.digest(_table(spark, sf_dir, "documents"))


def op13_align_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_align.align(_table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"),
                            _vocabulary("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_topk_pivots": op1_topk_pivots,
    "op2_linededup_patience": op2_linededup_patience,
    "op3_minhash_neardup": op3_minhash_neardup,
    "op4_packing_nnls": op4_packing_nnls,
    "op5_license_scan": op5_license_scan,
    "op6_quality_perplexity": op6_quality_perplexity,
    "op7_bpe_tree": op7_bpe_tree,
    "op8_toxicity_segments": op8_toxicity_segments,
    "op9_binary_output": op9_binary_output,
    "op10_sharding_splitters": op10_sharding_splitters,
    "op11_decontaminate_automaton": op11_decontaminate_automaton,
    "op12_merkle_versions": op12_merkle_versions,
    "op13_align_identity": op13_align_identity,
}
#: The operators that have a plain SQL form that is quick on whole tables.
ORACLE: dict[str, str] = {
    "op11_decontaminate_automaton": op11_decontaminate.ORACLE_SQL,
    "op12_merkle_versions": op12_merkle.ORACLE_SQL,
    "op1_topk_pivots": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
        ), r AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10""",
}
