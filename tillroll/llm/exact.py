"""Documents of equal text, found by combining in three steps of which none sees a whole group.

1. Local: each task of the scan combines its own copies of a text.
2. Salted: what is left meets by digest and a salt, the number of the task it
   comes from modulo SALTS, so that a text which stands in every task is
   combined in SALTS places.
3. Global: at most SALTS rows for each text are combined into the winner.

Every step groups by digest and full text; a digest alone decides nothing.
Winners are then found again by digest, and by text as well in the case of a
digest that several texts share.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tillroll.llm.storage import saved

#: Places where copies of one text are combined before the last step.
SALTS = 64
#: A text with more than one in so many rows is frequent: fewer than that many texts are.
FREQUENT = 1_000


def sha256(text: Column) -> Column:
    """The digest of a text in UTF-8, 64 lower-case hex digits."""
    return F.sha2(text.cast("binary"), 256)


def _texts(rows: DataFrame, salts: int) -> DataFrame:
    """digest, text, keep_id and group_size, one row for each text."""
    salted = rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    combined = salted.groupBy("salt", "digest", "text").agg(F.max("key").alias("key"), F.count(F.lit(1)).alias("size"))
    return combined.groupBy("digest", "text").agg(F.max("key").alias("keep_id"), F.sum("size").alias("group_size"))


def _met(rows: DataFrame, winners: DataFrame, same: list[str], frequent: int) -> DataFrame:
    """Every row with the winner that has the same digest, or digest and text.

    Rows of frequent texts by broadcast, all others by a join in which no text
    has more than one in `frequent` rows.
    """
    most = (winners.agg(F.sum("group_size")).first()[0] or 0) // frequent
    # Fewer than `frequent` texts, each with more than one in `frequent` rows.
    common = F.broadcast(winners.where(F.col("group_size") > most))
    rare = winners.where(F.col("group_size") <= most)
    rest = rows.join(common.select(*same), same, "left_anti")
    return rows.join(common, same).unionByName(rest.join(rare, same))


def exact_groups(
    frame: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    digest: Callable[[Column], Column] = sha256,
    salts: int = SALTS,
    frequent: int = FREQUENT,
) -> DataFrame:
    """key, keep_id, group_size, kept and text_sha256 for every row, dropped ones too.

    Texts are equal if identical; a null text counts as empty. Of equal texts
    the row with the largest key stays, one with a null key only where no other
    has any. Rows that repeat both text and key of the row that stays are that
    document again and marked as kept, see keep_one. Columns besides key and
    text are left out, so their names may clash. An empty frame gives no rows.

    Full texts move twice, each text of a task once; after that only digests,
    keys and counts do. Where several texts share a digest, which the saved
    winners tell, their rows are told apart by text.
    """
    rows = frame.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("digest", digest(F.col("text")))
    winners = saved(_texts(rows, salts).drop("text"))
    shared = winners.groupBy("digest").count().where("count > 1")
    same = ["digest"] if shared.isEmpty() else ["digest", "text"]
    if len(same) > 1:
        winners = saved(_texts(rows, salts))
    sha = "digest" if digest is sha256 else "sha256"
    own = rows.withColumn(sha, sha256(F.col("text"))).select(*dict.fromkeys(["key", *same, sha]))
    return _met(own, winners, same, frequent).select(
        F.col("key").alias(key),
        "keep_id",
        "group_size",
        F.col("key").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col(sha).alias("text_sha256"),
    )


def keep_one(frame: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, group_size and text_sha256, one row for each text: what of exact_groups stays, repeated rows once."""
    return exact_groups(frame, key, text).where("kept").select(key, "group_size", "text_sha256").distinct()
