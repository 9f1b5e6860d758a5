"""Documents to training sequences, stage by stage; each stage is written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import exact_dedup, mixing, packing, quality, weighted_minhash
from millrace.llm.frames import written
from millrace.llm.registry import table


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays, that of the largest doc_id."""
    return exact_dedup.keep_one(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-equal texts stays, that of the smallest doc_id."""
    return weighted_minhash.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources to their target weights: a document is there as often as it is taken."""
    return mixing.mix(docs, table(spark, sf_dir, "labels"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their place in a sequence."""
    return packing.pack(docs)


STAGES = [("quality", good), ("exact dedup", exact), ("near dedup", near), ("mix sources", mixed), ("pack", packed)]

#: The model of the first stage and the links of the third have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
