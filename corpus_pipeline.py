"""From raw documents to training windows: each stage works on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from predia.llm import exact_dedup, jaccard_join, packing, quality_rules, toxicity
from predia.llm.common import settle, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the factorization machine, fitted on the labels, scores toxic."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the base rules or the risk-controlled cutoffs reject."""
    return quality_rules.only_good(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without exact copies."""
    return exact_dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard_join.one_per_group(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training windows, written to the shared folder, and of them the pieces with the window of each."""
    return packing.listed(windows(docs))


def windows(docs: DataFrame) -> DataFrame:
    """The documents as training windows: ids with padding, and what lies in them."""
    return settle(packing.sequences(docs), "training-windows")


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_poor),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("packing", pack),
]

# Fitted weights, sketches and windows cannot be said in SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table documents after all stages but packing, each one's rows written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


def training_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a training run reads: the windows of the documents that all stages kept."""
    return windows(kept(spark, sf_dir))


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the table documents."""
    return STAGES[-1][1](spark, kept(spark, sf_dir), sf_dir)
