"""From raw documents to packed training sequences.

``run`` applies the stages in order; what a stage returns is written as Parquet to the
shared folder and read again as the documents of the next one.  All stages but the last
return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fundtide.llm import decontamination, near_dedup, packing, quality_rules, suffix_dedup
from fundtide.llm.queries import prepare
from fundtide.sources.workspace import materialized


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs, quality_rules.fit_field(docs, _table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the least doc_id."""
    prepare(spark)
    return near_dedup.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes and more that occur twice are cut out of the texts."""
    prepare(spark)
    return suffix_dedup.remove_repeats(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    index = decontamination.Index.build(docs, _table(spark, sf_dir, "benchmark"))
    return decontamination.without_items(docs, index)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of tokenised documents with their place in sequences of 2048 tokens."""
    prepare(spark)
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


STAGES = [
    ("quality_rules", drop_poor),
    ("near_dedup", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: Fitted models, components and packing have no SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialized(stage(spark, docs, sf_dir), name)
    return docs


QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
