"""The corpus pipeline: documents are judged, deduplicated, decontaminated, mixed and dealt into shards.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; all but the last return the
columns of documents. Null and empty texts, repeated rows and empty tables pass each stage as its operator states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrapack.llm import decontamination, jaccard, mixing, quality, sharding
from terrapack.llm.common import stored, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts as good."""
    return quality.classify(docs, table(spark, sf_dir, "labels")).filter(F.col("predicted") == 1).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of five-word shingles and a similarity of 0.8 or more hold together."""
    return jaccard.keep_one(docs, words=5, num=80, den=100)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    found = decontamination.contaminated(docs, table(spark, sf_dir, "benchmark"))
    return found.filter(F.size("items") == 0).select(*docs.columns)


def target_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of each document."""
    return sharding.shard_documents(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", target_mix),
    ("sharding", shards),
]

#: SQL expresses neither the fitted classifier nor tiling nor the heap; tests/llm holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
