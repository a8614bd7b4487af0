"""Intermediate results that outlive lost executors."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir or, where none is set, one in the warehouse: every executor reaches either."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/tillroll-checkpoints"


def saved(frame: DataFrame) -> DataFrame:
    """The frame's rows, computed once and written as a table to the shared checkpoint folder.

    A checkpoint of the frame would compute its last stage twice and write rows
    uncompressed. Tables stay until the folder is cleared.
    """
    spark = frame.sparkSession
    path = f"{checkpoint_folder(spark).rstrip('/')}/tillroll-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
