"""From raw documents to packed training bins, a stage at a time.

Each stage takes all rows that its predecessor wrote. ``run`` writes each stage's rows as
Parquet to the shared scratch folder and reads them again.
"""

from pyspark.sql import DataFrame, SparkSession

from equifacts.llm import jaccard_join, mixing, packing, pii, quality_rules
from equifacts.llm.common import read
from equifacts.session import configure, stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    configure(spark)
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    configure(spark)
    return jaccard_join.keep_first(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their personal data masked."""
    configure(spark)
    return pii.mask(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and as much of them, as the sources' targets ask for."""
    configure(spark)
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes."""
    configure(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality), ("near duplicates", near_duplicates),
    ("personal data", personal_data), ("mixing", mix_sources), ("packing", pack)]

# Signatures, shuffled blocks and measured rule order have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
