"""The corpus pipeline: five stages over documents, each written as Parquet and read by the next.

Toxic documents go, then those whose language cannot be told, then all but one document of each group of near
copies, then documents that hold a benchmark passage; the rest is packed into training sequences.  Every stage
works on all that the one before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dealscope.llm import common, decontamination, language_id, ngram_join, packing, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below one half."""
    return toxicity.keep_clean(docs, common.read_documents(spark, sf_dir, "labels"))


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    return language_id.keep_identified(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near copies; a repeated row stays once."""
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("__key")  # a null doc_id is one as well
    linked = ngram_join.link(docs)
    first = linked.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(key).distinct()
    row = F.row_number().over(Window.partitionBy("__key", "text").orderBy(F.lit(0)))
    return docs.withColumn("__key", key).join(first, "__key", "left_semi").withColumn("__row", row) \
        .where("__row = 1").drop("__key", "__row")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.decontaminate(docs, common.read_documents(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boundary records of the packed sequences."""
    return packing.pack(docs, with_ids=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unknown_language),
    ("ngram_jaccard", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: The stages' models and token ids cannot be stated in SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read_documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = common.materialise(stage(spark, docs, sf_dir), name)
    return docs
