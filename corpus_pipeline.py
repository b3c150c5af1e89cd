"""The corpus pipeline: rules, line dedup, near-dedup, decontamination and packing over all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.llm import decontaminate, line_dedup, near_dedup, queries, rules
from tabulon.llm.words import free_name
from tabulon.plans.shared import broadcast_if_small, materialise

# Ids of dropped documents sent to every executor at most; beyond that the texts are shuffled instead.
IDS_BROADCAST = 1_000_000


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The documents whose doc_id is not in ``gone``; rows without a doc_id stay, rows that share one go together."""
    own = free_name("gone_id", docs.columns)
    ids = materialise(gone.select(F.col("doc_id").alias(own)).distinct(), "gone_ids")
    return docs.join(broadcast_if_small(ids, IDS_BROADCAST), docs.doc_id == F.col(own), "left_anti")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the learned decision list reject go."""
    return _without(docs, rules.judge(docs, _read(spark, sf_dir, "labels")).filter("not kept"))


def line_similarity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier line matches are cut; a document of which no word is left goes."""
    cut = line_dedup.drop_later_lines(docs)
    left = cut.filter("n_removed = 0 or text rlike '[^\\\\x20\\\\x09-\\\\x0D]'")
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return left.select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: five-word shingles, Jaccard 0.8."""
    return _without(docs, near_dedup.near_duplicates(docs).filter("not kept"))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark windows in a twentieth of their words go."""
    return _without(docs, decontaminate.contamination(docs, _read(spark, sf_dir, "benchmark")).filter("contaminated"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what is left, in windows of up to 2048 tokens."""
    # executors still hold what earlier stages left, so the workers get less memory than packing alone
    return queries.packed(docs, remembered=1 << 18, together=2 << 20)


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_similarity), ("minhash_near_dedup", one_of_each_group),
          ("benchmark_decontamination", without_benchmark), ("packing", packing)]
# a learned list, and tokens: SQL cannot express the stages
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each is stored, and read by the next."""
    docs = _read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
