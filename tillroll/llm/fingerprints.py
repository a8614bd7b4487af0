"""Document fingerprints: of each text's shingle hashes those below a fixed part of their range.

A shingle is kept in every text that has it or in none, so sketches of parts can
be merged, and the share of common hashes estimates how alike, or how far
contained in each other, two texts are, however unequal their lengths.

Of a set of n shingles the sketch is empty with probability (1 - 1 / SCALE)**n:
0.32 for 4, 0.10 for 8, 0.01 for 16. Below some 16 shingles (20 words) a likeness
other than that of equal sets means nothing; a text's number of shingles is
in its fingerprint.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from tillroll.llm.shingles import shingle_sets, sliced

#: One in so many shingles is kept.
SCALE = 4
_DIGEST = 16


def sketch(hashes: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The sorted hashes below 2**64 / scale."""
    return hashes[: np.searchsorted(hashes, np.uint64((1 << 64) // scale - 1), side="right")]


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of two texts' shingles together."""
    return np.union1d(a, b)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity; 0 where neither sketch holds a hash."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    union = len(a) + len(b) - shared
    return shared / union if union else 0.0


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of a's shingles that b has too; 0 where a's sketch is empty."""
    return len(np.intersect1d(a, b, assume_unique=True)) / len(a) if len(a) else 0.0


class Fingerprint:
    """A sketch with the number of all shingles and a digest of the whole set.

    As text: digest, number, and the sketch's hashes in order, in hex. The
    digest tells equal sets from others where a short text's sketch is empty.
    """

    def __init__(self, hashes: np.ndarray, scale: int = SCALE):
        self.sketch = sketch(hashes, scale)
        self.digest = hashlib.blake2b(hashes.tobytes(), digest_size=_DIGEST // 2).hexdigest()
        self.text = f"{self.digest}:{len(hashes)}:{self.sketch.byteswap().tobytes().hex()}"

    def likeness(self, other: Fingerprint) -> float:
        """1 for equal sets, else the sketches' estimate."""
        return 1.0 if self.digest == other.digest else likeness(self.sketch, other.sketch)


def fingerprints(frame: DataFrame, text: str = "text", scale: int = SCALE) -> DataFrame:
    """All columns and fingerprint, a string; texts with equal shingles have equal ones.

    A null text counts as empty; an empty text has no shingles and the
    fingerprint of the empty set. A column named fingerprint is refused.
    """
    if "fingerprint" in {c.lower() for c in frame.columns}:
        raise ValueError("The frame already has a column fingerprint.")
    schema = T.StructType([*frame.schema.fields, T.StructField("fingerprint", T.StringType(), False)])

    def add(batches):
        for batch in sliced(batches, text):
            own = [Fingerprint(x, scale).text for x in shingle_sets(batch.column(text))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.string())], names=schema.names)

    return frame.mapInArrow(add, schema)


def _with_next(frame: DataFrame, key: str, text: str) -> DataFrame:
    """key, text and two flags, dealt out by descending key, each partition holding one more row behind its last.

    Keys are cut into ranges of about equally many rows. The first row of a
    range is sent to the range before it as well, marked as copied.
    """
    spark = frame.sparkSession
    own = frame.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = F.struct(F.col("key").isNull().alias("null"), (-F.col("key").cast("decimal(20,0)")).alias("down"))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    row = own.agg(F.percentile_approx("key", [i / parts for i in range(1, parts)] or [0.5], 10_000)).first()
    cuts = sorted(set(row[0] or []), reverse=True)
    # Range 0 has the keys above the largest cut; null keys are in the last.
    bounds = F.array(*(F.lit(c).cast("long") for c in cuts)) if cuts else F.array().cast("array<long>")
    place = F.when(F.col("key").isNull(), len(cuts)).otherwise(F.size(F.filter(bounds, lambda c: F.col("key") <= c)))
    placed = own.withColumn("range", place)
    heads = placed.groupBy("range").agg(F.min(F.struct(order.alias("order"), F.xxhash64("text").alias("hash"), "key")).alias("head"))
    # One row for each range: at most as many as there are shuffle partitions.
    found = sorted((r["range"], r["head"]["hash"], r["head"]["key"]) for r in heads.collect())
    if not found:
        return own.select("key", "text", F.lit(False).alias("copied"), F.lit(0).alias("range"))
    before = {here[0]: found[i - 1][0] for i, here in enumerate(found)}
    wanted = spark.createDataFrame(
        [(here, key_of, hash_of, before[here]) for here, hash_of, key_of in found],
        "range int, head_key long, head_hash long, to int",
    )
    # A row for each range, as above.
    joined = placed.join(F.broadcast(wanted), "range")
    first = F.col("key").eqNullSafe(F.col("head_key")) & (F.xxhash64("text") == F.col("head_hash"))
    goes = F.when(first, F.array(F.struct("range", F.lit(False).alias("copied")), F.struct(F.col("to").alias("range"), F.lit(True).alias("copied"))))
    goes = F.inline(F.coalesce(goes, F.array(F.struct("range", F.lit(False).alias("copied")))))
    return joined.select("key", "text", goes).repartitionById(len(cuts) + 1, F.col("range")).sortWithinPartitions(
        "range", "copied", F.col("key").desc_nulls_last(), F.xxhash64("text"), "text"
    )


def edited_fingerprints(frame: DataFrame, key: str = "doc_id", text: str = "text", scale: int = SCALE) -> DataFrame:
    """Fingerprints of each text, of its edited text, and how like they are.

    The documents are taken by descending key, null keys last, equal keys by
    text; after the last comes the first. The edited text is the text with its
    last floor(n_chars / 2) code points replaced by the first as many, or all,
    of the next document. near_edited is the likeness to the edited text's
    fingerprint, near_next to the next document's. Texts are shuffled once, into
    ranges of keys. Null texts count as empty, a single document is next to
    itself, repeated rows stay, other columns are left out. Keys are integers.
    """
    kind = frame.schema[key].dataType
    schema = T.StructType(
        [
            T.StructField(key, T.LongType()),
            T.StructField("n_chars", T.LongType(), False),
            T.StructField("edited_sha256", T.StringType(), False),
            T.StructField("fingerprint", T.StringType(), False),
            T.StructField("edited_fingerprint", T.StringType(), False),
            T.StructField("near_edited", T.DoubleType(), False),
            T.StructField("near_next", T.DoubleType(), False),
        ]
    )

    def compare(batches):
        held = None
        for rows in _documents(batches, scale):
            pairs = []
            for now in rows:
                if held is not None and held[0] == now[0]:
                    pairs.append((held, now))
                held = None if now[1] else now
            if pairs:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*_compared(pairs, scale), strict=True), arrow.types, strict=True)],
                    schema=arrow,
                )

    arrow = pa.schema(
        [
            (key, pa.int64()),
            ("n_chars", pa.int64()),
            ("edited_sha256", pa.string()),
            ("fingerprint", pa.string()),
            ("edited_fingerprint", pa.string()),
            ("near_edited", pa.float64()),
            ("near_next", pa.float64()),
        ]
    )
    dealt = _with_next(frame, key, text).select("range", "copied", "key", "text")
    return dealt.mapInArrow(compare, schema).withColumn(key, F.col(key).cast(kind))


def _documents(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[list[tuple]]:
    """Batches of (range, copied, key, text, fingerprint)."""
    for batch in sliced(batches, "text"):
        prints = [Fingerprint(x, scale) for x in shingle_sets(batch.column("text"))]
        columns = [batch.column(c).to_pylist() for c in ("range", "copied", "key", "text")]
        yield list(zip(*columns, prints, strict=True))


def _compared(pairs: list[tuple[tuple, tuple]], scale: int) -> Iterator[tuple]:
    edited = []
    for here, after in pairs:
        half = len(here[3]) // 2
        edited.append(here[3][: len(here[3]) - half] + after[3][:half])
    changes = [Fingerprint(x, scale) for x in shingle_sets(pa.array(edited, pa.large_string()))]
    for (here, after), text, changed in zip(pairs, edited, changes, strict=True):
        own = here[4]
        digest = hashlib.sha256(text.encode()).hexdigest()
        yield here[2], len(here[3]), digest, own.text, changed.text, own.likeness(changed), own.likeness(after[4])
