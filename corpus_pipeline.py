"""Corpus preparation as stages over ``documents``.

Each stage is (name, function(spark, docs, sf_dir) -> DataFrame); ``run``
writes every stage's rows as Parquet into the shared folder and reads them
back as the next one's input, so lineage is cut and a lost executor repeats at
most one stage.  All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from churnlake.llm.common import load
from churnlake.llm.decontamination import decontaminate
from churnlake.llm.mixing import mix_documents
from churnlake.llm.sharding import assign_shards
from churnlake.llm.simhash import deduplicate
from churnlake.llm.toxicity import drop_toxic
from churnlake.session import shared_path

N_SHARDS = 40


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier chain rejects; trained on the labels of its own input."""
    return drop_toxic(docs, load(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a window of a benchmark item."""
    return decontaminate(docs, load(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of whole documents at the sources' target weights, in curriculum order."""
    return mix_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every remaining document."""
    return assign_shards(docs, N_SHARDS)


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

# the toxicity stage scores with a trained model, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; the last stage's rows."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs
