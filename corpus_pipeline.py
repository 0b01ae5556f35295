"""Corpus pipeline: toxicity, quality rules, line dedup, near-dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet under the shared checkpoint folder and rereads as the next
stage's documents, so a lost executor never repeats a finished stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (
    op2_linededup,
    op3_minhash,
    op4_packing,
    op6_quality,
    op8_toxicity,
)
from ledgerline.llm.common import drop_written, prepare, written

#: Words of a shingle and similarity (percent) of near duplicates.
SHINGLE, PERCENT = 5, 80


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents with a key column of a free name: a hash of all that a verdict depends on.

    Rows of equal key share their verdict.
    """
    key = "__row"
    while key in docs.columns:
        key += "_"
    return docs.withColumn(key, F.xxhash64(*[c for c in ("doc_id", "lang", "text") if c in docs.columns])), key


def _passing(keyed: DataFrame, key: str, rejected: DataFrame) -> DataFrame:
    """The rows whose own key is not rejected (a table of one column), whether their doc_id is null or repeated."""
    gone = rejected.toDF("__rejected").distinct()
    return keyed.join(gone, keyed[key] == gone["__rejected"], "left_anti").drop(key)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    prepare(spark)
    keyed, key = _keyed(docs)
    weight, law = op8_toxicity.train(docs, labels)
    rows = keyed.select(F.col(key).alias("doc_id"), "text")
    return _passing(keyed, key, op8_toxicity.score_rows(rows, weight, law).where("predicted = 1").select("doc_id"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the counting rules and the perplexity band."""
    keyed, key = _keyed(docs)
    judged = op6_quality.judge(keyed.withColumn("doc_id", F.col(key)))
    return _passing(keyed, key, judged.where("not kept").select("doc_id"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that an earlier document holds; n_chars follows the text."""
    trimmed, _ = op2_linededup.dedup_lines(docs)
    if "n_chars" not in docs.columns:
        return trimmed
    length = F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType)
    return trimmed.withColumn("n_chars", length)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, that of the least doc_id; rows without words all stay.

    Verdicts go by a key of the row, so a null doc_id takes part and a namesake
    with another text is judged by its own text.  Rows equal in doc_id, lang and
    text are one row here: the first of them stays.
    """
    keyed, key = _keyed(docs)
    judged = op3_minhash.near_duplicates(keyed, SHINGLE, PERCENT, row=key)
    held = judged.where("kept and n_shingles > 0").groupBy(key).count().where("count > 1").select(F.col(key).alias("__twice"))
    held, _ = written(held, "pipeline-twice")
    kept = _passing(keyed.withColumn("__kept", F.col(key)), key, judged.where("not kept").select(key))
    again = kept["__kept"] == held["__twice"]
    once = kept.join(held, again, "left_anti")
    return once.unionByName(kept.join(held, again, "left_semi").dropDuplicates(["__kept"])).drop("__kept")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of one window."""
    import public_tokenizers
    return op4_packing.digest(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("toxicity", toxicity), ("quality", quality), ("line_dedup", line_dedup),
          ("near_dedup", near_dedup), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents table."""
    prepare(spark)
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs, path = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before:
            drop_written(spark, before)
        before = path
    return docs


#: Trained scores and approximate quantiles have no SQL form.
ORACLE_SQL = None
