"""A corpus from raw documents to token ids: quality, near copies, repeated passages, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next one's
``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.llm import bpe, curriculum, probminhash, quality, queries, spans
from tallyward.operators.staging import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    judged = quality.quality_rules(docs, queries.table(spark, sf_dir, "labels"))
    return judged.where("kept").select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, that of the least key. Rows without a key stay."""
    spare = probminhash.near_duplicates(docs).where(~F.col("is_first")).select("doc_id").distinct()
    return docs.join(spare, "doc_id", "left_anti")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated sentences; one that has nothing else goes."""
    left = spans.span_dedup(docs).withColumn("n_chars", F.length("text").cast("long"))
    return left.where("n_removed = 0 or text rlike '[^ \\t-\\r]'").select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time that the mix takes a document, in training order."""
    return curriculum.training_order(curriculum.curriculum(docs)).select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and digests of them and of the decoded text."""
    coded = bpe.encode(docs.select("doc_id", "source", "text"), queries.vocabulary(), decoded="decoded")
    return bpe.with_digests(coded, "doc_id", "source", "ids")


STAGES = [("quality rules", quality_rules), ("near dedup", near_dedup), ("substring dedup", substring_dedup),
          ("mix sources", mix_sources), ("tokens", tokens)]

#: SQL can express neither the signatures nor the merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
