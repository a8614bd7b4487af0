"""Training rows: bounded samples by hash, and labelled documents that aren't held out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: One in so many documents is held out.
FOLDS = 5


def held_out(key: str) -> Column:
    """Whether crc32 of the key as text is divisible by FOLDS; a null key counts as an empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % FOLDS == 0


def smallest_hashes(frame: DataFrame, key: str, rows: int) -> DataFrame:
    """The rows of the `rows` smallest hashes of a key that is unique; a sample that is the same every time.

    Rows are counted first, so that only about twice as many as wanted are
    brought together to be ordered.
    """
    hashed = frame.withColumn("_hash", F.pmod(F.xxhash64(key), F.lit(1 << 31)))
    share = min(1.0, (2 * rows + 100) / max(1, frame.count()))
    near = hashed.where(F.col("_hash") < int(share * (1 << 31)))
    return near.orderBy("_hash", key).limit(rows).drop("_hash")


def training_texts(docs: DataFrame, labels: DataFrame, label: str, rows: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """text and label (0 or 1) of at most `rows` labelled documents, those of the smallest hashes of their keys.

    Left out are held-out documents, labels other than 0 and 1, and keys whose
    labels disagree. Of rows that repeat a key the least text is taken.
    """
    own = labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("label"))
    own = own.where(F.col("_key").isNotNull() & F.col("label").isin(0, 1)).where(~held_out("_key"))
    agreed = own.groupBy("_key").agg(F.min("label").alias("label"), F.max("label").alias("_most")).where("label = _most")
    chosen = smallest_hashes(agreed.select("_key", "label"), "_key", rows)
    # At most `rows` keys with their labels.
    texts = docs.select(F.col(key).alias("_key"), F.col(text).alias("text"))
    found = texts.join(F.broadcast(chosen), "_key").groupBy("_key", "label").agg(F.min("text").alias("text"))
    return found.select("text", "label")
