"""A pipeline over documents: quality, exact and near copies, mixing, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyguard.llm.common import written
from tallyguard.llm.exact_dedup import drop_copies
from tallyguard.llm.minhash import one_of_each
from tallyguard.llm.mixing import take_mix
from tallyguard.llm.piece_encoding import encode_and_decode
from tallyguard.llm.quality import keep_good


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return keep_good(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: documents as often as it takes them."""
    return take_mix(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row a copy: doc_id, ids, n_ids, exact (whether the ids decode to the text)."""
    coded = encode_and_decode(docs)
    return coded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_ids"), "exact")


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("encoding", encoding),
]

#: Mixing draws at random and encoding needs the model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written to the shared scratch folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
