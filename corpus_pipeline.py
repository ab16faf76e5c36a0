"""Documents to training shards: quality, near duplicates, benchmark items, mixture, shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm.decontaminate import decontaminate
from folioforge.llm.jaccard import jaccard_components
from folioforge.llm.mixing import mixed
from folioforge.llm.quality import THRESHOLD, fit_quality, quality_score
from folioforge.llm.shards import shard_documents
from folioforge.session import stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier doesn't reject; empty texts are scored like all others."""
    score = quality_score(fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return docs.where(score("text") >= THRESHOLD)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id.

    Rows without an id are never taken for copies; rows that repeat an id stay or go together.
    """
    gone = stage(jaccard_components(docs).where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct(), "copies")
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens follow the target shares of sources, languages and topics."""
    return mixed(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's shard and slot among 16."""
    return shard_documents(docs, 16)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

# A boosted classifier, edit distances and raking have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each reads what the one before has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES = {}
