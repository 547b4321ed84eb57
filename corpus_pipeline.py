"""From raw documents to training sequences: each stage calls one operator of ledgerlens.llm on all that the stage before has kept.

All stages but the last return the columns of `documents`; the last returns the pieces with their sequences. Every stage is written and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import exact_dedup, minhash, mixing, packing, quality
from ledgerlens.llm.common import written


def reject_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Junk and toxic documents go."""
    return quality.select_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts that of the smallest doc_id stays."""
    return exact_dedup.drop_copies(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by a similarity of 0.8 or more on shingles of five words, the smallest doc_id stays."""
    return minhash.drop_near_copies(docs, words=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them."""
    return mixing.mixed_rows(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", reject_poor),
    ("exact dedup", drop_exact),
    ("MinHash near-dedup", drop_near),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: Training a classifier, drawing minima and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
