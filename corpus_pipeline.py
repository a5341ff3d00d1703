"""From documents to mixed, sharded training data in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept.
``run`` writes every stage's result to the shared folder and reads it back, so a
lost executor costs at most one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from uurwerk.llm import decontam, mixing, sharding, simhash, toxicity
from uurwerk.llm.common import table
from uurwerk.session import materialize


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go."""
    return toxicity.reject_toxic(docs, table(spark, sf_dir, "labels"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.deduplicate(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark passages cover a twentieth or more go."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, written in the order of the mix."""
    return mixing.mixed_documents(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard and their slot in it; slots follow the mix, which
    is the same for the same rows, however they are read back."""
    return sharding.shard_documents(docs, levels=4, order=mixing.mix_order(docs))


STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash_dedup", dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

# Learned scores, connected components and sorted medians: no SQL for the rows as a whole.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
