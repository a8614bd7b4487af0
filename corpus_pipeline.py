"""A corpus made ready for training: each stage works on what its predecessor kept.

Quality and toxicity are learned from the labels of the documents that a stage
is given; null, empty and repeated rows are treated as the operators say.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import jaccard, quality, queries, toxicity
from tillroll.llm.storage import checkpoint_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of good quality."""
    return quality.keep_good(docs, queries.table(spark, sf_dir, "labels"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't toxic."""
    return toxicity.drop_toxic(docs, queries.table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one of the smallest doc_id."""
    return jaccard.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents that are left, with their places in sequences."""
    return queries.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_good),
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("best-fit packing", pack),
]

#: SQL can't learn the classifiers or encode texts; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's rows written as Parquet and read by the next."""
    base = f"{checkpoint_folder(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    docs = queries.table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{base}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
