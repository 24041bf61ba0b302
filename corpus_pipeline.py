"""A training corpus from raw documents: toxic ones go, exact copies go, one of each group of near copies stays, sources
are mixed to their target weights, and what is left is encoded.

Every stage reads all that its predecessor kept, stored as Parquet; all but the last return the columns of documents.
Stages that send texts to Python do so in modest batches, a setting that the session keeps.
``run`` stores them in a new folder under spark.checkpoint.dir.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from latewatch.llm import bag_minhash, bpe, exact_dedup, mixing, toxicity
from latewatch.llm.inputs import table
from latewatch.session import ensure_checkpoint_dir, modest_batches


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on the labels of the folder, does not reject."""
    modest_batches(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    modest_batches(spark)
    return bag_minhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, ids``, their number, and digests of the ids and of what they decode to."""
    modest_batches(spark)
    return bpe.digests(bpe.round_trip(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

# Classifiers, near duplicates and subword encoding are beyond SQL; the tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4()}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
