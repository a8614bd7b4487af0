"""Similarity join of documents on word shingles, by rare-first prefix filtering.

Texts with equal sets are one class. Of each class the shingles are ordered
rarest first; two sets that are similar enough share a shingle among the first
few of each (the prefix). Classes meet on prefix shingles; pairs are then cut by
length, by the place of the shared shingle, and by a bound on what the rest can
share, counted in parts of the shingle space (the suffix filter). What is left is
verified once on the whole sets.

How rare a shingle is comes from a table of counts of fixed size, to which every
class adds all its shingles. A shingle counts as frequent by what its bucket has
above the usual bucket, which fills as the input grows. Any order gives the
right result; this one sets the frequent apart.

A first round compares each class only with the one in which the shared shingle
comes first: the least altered of a group of near copies. What it links is one
component, and the second round meets on prefix shingles only across components,
so that a group of n near copies costs about n comparisons and not n * n. No
link between components is missed.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillroll.llm.graph import components
from tillroll.llm.shingles import shingle_sets, sliced
from tillroll.llm.storage import saved

#: Counts in the table of frequencies, one byte each when sent to workers, and in each block it is added up in.
BUCKET_BITS = 20
BLOCK_BITS = 14
#: Parts of the shingle space in which the suffix filter counts, in powers of two: one or two shingles each, within these bounds.
LEAST_PART_BITS = 4
MOST_PART_BITS = 12
#: Shingles counted 2**HOT times or more above the usual are dealt out by class as well.
HOT = 11
#: Two classes don't meet again on a shingle if they share one of so many before it.
BEFORE = 4
#: Bits of the set of classes to be verified, as sent to workers.
WANTED_BITS = 23


def _set_id(hashes: np.ndarray) -> int:
    """A digest of a set: two of N sets share one by chance with probability N * N / 2**65."""
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


def _packed(counts: np.ndarray) -> bytes:
    """Counts in numbers of the least width, most often a byte."""
    return zlib.compress(counts.astype(np.min_scalar_type(int(counts.max()))).tobytes(), 1)


def _unpacked(packed: bytes) -> np.ndarray:
    counts = zlib.decompress(packed)
    return np.frombuffer(counts, f"u{len(counts) >> BLOCK_BITS}").astype(np.int64)


def _summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each block of counts, however many came."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, packed in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            sums[block] = sums.get(block, 0) + _unpacked(packed.as_py())
    if sums:
        columns = [pa.array(list(sums), pa.int32()), pa.array([_packed(x) for x in sums.values()], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["block", "counts"])


def _described(frame: DataFrame, key: str, text: str) -> DataFrame:
    """A row for each document (key, set_id, n, parts), and rows (block, counts): how many classes hold a bucket's shingles."""
    own = frame.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = own.schema["doc_id"].dataType.simpleString()

    def describe(batches):
        met: set[int] = set()
        seen = np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in sliced(batches, "text"):
            ids, sizes, parts, new = [], [], [], []
            for hashes in shingle_sets(batch.column("text")):
                sizes.append(len(hashes))
                if not len(hashes):
                    ids.append(None)
                    parts.append(None)
                    continue
                ids.append(_set_id(hashes))
                bits = min(max(len(hashes).bit_length() - 1, LEAST_PART_BITS), MOST_PART_BITS)
                counts = np.bincount(hashes >> np.uint64(64 - bits), minlength=1 << bits)
                # No bound for a set too large for small counts: the suffix filter lets it pass.
                parts.append(counts.astype(np.uint8).tobytes() if counts.max() < 1 << 8 else None)
                if ids[-1] not in met:
                    met.add(ids[-1])
                    new.append(hashes)
            if new:
                buckets = np.concatenate(new) & np.uint64((1 << BUCKET_BITS) - 1)
                seen += np.bincount(buckets.view(np.int64), minlength=len(seen))
            columns = [
                batch.column("doc_id"),
                pa.array(ids, pa.int64()),
                pa.array(sizes, pa.int64()),
                pa.array(parts, pa.binary()),
                pa.nulls(len(ids), pa.int32()),
                pa.nulls(len(ids), pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)
        blocks = seen.reshape(-1, 1 << BLOCK_BITS)
        held = np.flatnonzero(blocks.any(axis=1))
        if len(held):
            columns = [pa.nulls(len(held), t) for t in (arrow_type, pa.int64(), pa.int64(), pa.binary())]
            counts = pa.array([_packed(blocks[k]) for k in held], pa.binary())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(held.astype(np.int32)), counts], names=names)

    names = ["doc_id", "set_id", "n", "parts", "block", "counts"]
    arrow_type = pa.string() if kind == "string" else pa.int32() if kind == "int" else pa.int64()
    if kind not in ("string", "int", "bigint"):
        raise ValueError(f"Keys must be string, int or bigint, not {kind}.")
    return own.mapInArrow(describe, f"doc_id {kind}, set_id long, n long, parts binary, block int, counts binary")


def _frequencies(described: DataFrame) -> bytes:
    """For each bucket the binary logarithm of what it has above the usual bucket; 2**BUCKET_BITS bytes."""
    blocks = described.where("block is not null").select("block", "counts")
    # Each task adds up its own blocks, then one task all of a block: 2**(BUCKET_BITS - BLOCK_BITS) rows.
    near = blocks.mapInArrow(_summed, blocks.schema)
    rows = near.repartition("block").mapInArrow(_summed, blocks.schema).toArrow()
    seen = np.zeros(1 << BUCKET_BITS, np.int64)
    for block, packed in zip(rows["block"].to_pylist(), rows["counts"].to_pylist(), strict=True):
        seen[block << BLOCK_BITS : (block + 1) << BLOCK_BITS] = _unpacked(packed)
    # Shingles that share a bucket by chance fill it to the middle, give or take a few of its roots.
    usual = np.median(seen)
    above = np.maximum(seen - usual - 4 * np.sqrt(usual), 1)
    return np.floor(np.log2(above)).astype(np.uint8).tobytes()


def _prefixes(frame: DataFrame, text: str, frequencies: bytes, percent: int) -> DataFrame:
    """Rows (part, set_id, place) of each set's first shingles, rarest first; the sets of a partition once.

    part is the shingle, for a frequent one with some bits of the set in its last
    bits; its first six bits say how frequent. place is at * 2**32 + n.
    """

    def ordered(batches):
        level_of = np.frombuffer(frequencies, np.uint8)
        met: set[int] = set()
        for batch in sliced(batches, 0):
            keys, ids, sizes, places = [], [], [], []
            for hashes in shingle_sets(batch.column(0)):
                n = len(hashes)
                if not n or (own := _set_id(hashes)) in met:
                    continue
                met.add(own)
                level = level_of[hashes & np.uint64((1 << BUCKET_BITS) - 1)].astype(np.uint64)
                key = np.sort(level << np.uint64(58) | hashes >> np.uint64(6))[: n - -(-percent * n // 100) + 1]
                keys.append(key)
                ids.append(own)
                sizes.append(n)
                places.append(len(key))
            if not ids:
                continue
            shingle = np.concatenate(keys)
            set_id = np.repeat(np.array(ids, np.int64), places)
            level = (shingle >> np.uint64(58)).astype(np.int64)
            part = shingle.view(np.int64) ^ (set_id & ((np.int64(1) << np.maximum(level - HOT, 0)) - 1))
            at = np.concatenate([np.arange(p, dtype=np.int64) for p in places])
            place = at << 32 | np.repeat(np.array(sizes, np.int64), places)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (part, set_id, place)], names=["part", "set_id", "place"])

    return frame.select(text).mapInArrow(ordered, "part long, set_id long, place long")


def _level(part: Column) -> Column:
    return F.shiftrightunsigned(part, 58).cast("int")


def _shingle(part: Column, set_id: Column) -> Column:
    """The shingle of a part: without the bits of the set."""
    bits = F.call_function("shiftleft", F.lit(1).cast("long"), F.greatest(_level(part) - HOT, F.lit(0))) - 1
    return part.bitwiseXOR(set_id.bitwiseAND(bits))


def _may_match(x: Column, y: Column, percent: int) -> Column:
    """Length filter, and the place filter for a shingle at which two sets meet first; x and y are their places."""
    n, m = x.bitwiseAND(0xFFFFFFFF), y.bitwiseAND(0xFFFFFFFF)
    shared = F.least(n - F.shiftright(x, 32), m - F.shiftright(y, 32))
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (shared * (100 + percent) >= (n + m) * percent)


def _not_bounded_away(pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, n_a, n_b) of which parts_a and parts_b don't say that they share too little."""

    def bounded(batches):
        for batch in batches:
            needed = (batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()) * percent
            keep = np.ones(len(needed), bool)
            for row, sides in enumerate(zip(batch.column("parts_a").to_pylist(), batch.column("parts_b").to_pylist(), strict=True)):
                if None not in sides:
                    fewer = min(map(len, sides))
                    x, y = (np.frombuffer(side, np.uint8).reshape(fewer, -1).sum(axis=1, dtype=np.int64) for side in sides)
                    keep[row] = np.minimum(x, y).sum() * (100 + percent) >= needed[row]
            yield batch.select(names).filter(pa.array(keep))

    names = ["a", "b", "n_a", "n_b"]
    return pairs.select(*names, "parts_a", "parts_b").mapInArrow(bounded, "a long, b long, n_a long, n_b long")


def _verified(pairs: DataFrame, sets: DataFrame, frame: DataFrame, text: str, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that are similar enough, by suffix filter and then by their whole sets."""
    described = pairs
    for side in ("a", "b"):
        own = sets.select(F.col("set_id").alias(side), F.col("n").alias(f"n_{side}"), F.col("parts").alias(f"parts_{side}"))
        described = described.join(own, side)
    left = saved(_not_bounded_away(described, percent))
    # A bit for each class to be read again; others with that bit are read as well and not joined.
    bits = (1 << WANTED_BITS) - 1
    wanted = left.select(F.explode(F.array("a", "b")).alias("id")).select(F.col("id").bitwiseAND(bits).alias("bit")).distinct()
    # At most 2**WANTED_BITS numbers.
    marked = np.zeros(1 << WANTED_BITS, np.uint8)
    marked[wanted.toArrow()["bit"].to_numpy()] = 1
    packed = np.packbits(marked).tobytes()

    def whole(batches):
        marks = np.unpackbits(np.frombuffer(packed, np.uint8))
        met: set[int] = set()
        for batch in sliced(batches, 0):
            ids, found = [], []
            for hashes in shingle_sets(batch.column(0)):
                if not len(hashes) or not marks[(own := _set_id(hashes)) & bits] or own in met:
                    continue
                met.add(own)
                ids.append(own)
                found.append(hashes.view(np.int64))
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.list_(pa.int64()))], names=["id", "hashes"])

    # The exchange by id serves both sides of the pairs.
    read = frame.select(text).mapInArrow(whole, "id long, hashes array<long>").repartition("id").dropDuplicates(["id"])
    both = left
    for side in ("a", "b"):
        both = both.join(read.select(F.col("id").alias(side), F.col("hashes").alias(f"hashes_{side}")), side)
    shared = F.size(F.array_intersect("hashes_a", "hashes_b")).cast("long")
    linked = both.select("a", "b", shared.alias("shared"), (F.col("n_a") + F.col("n_b")).alias("sum"))
    return linked.where(F.col("shared") * (100 + percent) >= F.col("sum") * percent).select("a", "b")


def similar_documents(frame: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 75) -> DataFrame:
    """Per document: key as doc_id, n_shingles, component_id (smallest key reachable over links, itself included).

    Two documents are linked when percent of the union of their sets lies in the
    intersection. A null or empty text has no shingles, is linked with nothing
    and keeps its own key; a null key gets the smallest key of its component, if
    there is one. Repeated rows each give a row. Keys are int, bigint or string.
    Other columns are left out; an empty table gives an empty one.
    """
    described = saved(_described(frame, key, text))
    docs = described.where("block is null").select("doc_id", "set_id", "n", "parts")
    sets = saved(
        docs.where("n > 0").groupBy("set_id").agg(F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("parts").alias("parts"))
    )
    rows = _prefixes(frame, text, _frequencies(described), percent)
    linked = _links(rows, sets, frame, text, percent)
    smallest = linked.join(sets.select(F.col("set_id").alias("node"), "least"), "node").groupBy("component").agg(
        F.min("least").alias("component_id")
    )
    of_set = linked.join(smallest, "component").select(F.col("node").alias("set_id"), "component_id")
    found = sets.join(of_set, "set_id", "left").select(
        "set_id", F.coalesce("component_id", "least").alias("component_id")
    )
    with_set = docs.where("n > 0").join(found, "set_id", "left").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    without = docs.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return with_set.unionByName(without)


def keep_one(frame: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 75) -> DataFrame:
    """Of each group of similar documents the one of the smallest key, with the columns it came with.

    Documents without shingles all stay, as do rows with a null key in a group
    of their own. Of rows that repeat the key of a kept document and its text,
    one stays.
    """
    kept = similar_documents(frame, key, text, percent).where("doc_id = component_id").select(F.col("doc_id").alias("_kept")).distinct()
    own = frame.withColumn("_text_hash", F.xxhash64(text))
    same = own.join(kept, F.col(key) == F.col("_kept"), "left_semi").dropDuplicates([key, "_text_hash"])
    return same.unionByName(own.where(F.col(key).isNull())).select(*frame.columns)


def _links(rows: DataFrame, sets: DataFrame, frame: DataFrame, text: str, percent: int) -> DataFrame:
    """node, component of all classes that are linked with another one."""
    dealt = rows.repartition("part")
    of_part = dealt.groupBy("part").agg(
        F.min(F.struct("place", "set_id")).alias("first"), F.min("set_id").alias("low"), F.max("set_id").alias("high")
    )
    # A class alone in one part of a frequent shingle may share it with classes in the other parts.
    dealt_out = _level(F.col("part")) > HOT
    shared = of_part.where((F.col("low") != F.col("high")) | dealt_out).select("part", "first")
    met = saved(dealt.join(shared, "part").dropDuplicates(["part", "set_id"]))

    own = met.where(dealt_out).select(_shingle(F.col("part"), F.col("set_id")).alias("shingle"), "first")
    of_shingle = own.groupBy("shingle").agg(F.min("first").alias("top"))
    across = own.distinct().join(of_shingle, "shingle").select(F.col("first.*"), F.col("top").alias("first"))
    near = met.select("place", "set_id", "first").unionByName(across)
    near = near.where(F.col("set_id") != F.col("first.set_id")).where(_may_match(F.col("place"), F.col("first.place"), percent))
    # A set's rows are no more than its prefix: one exchange for both counts.
    tried = near.select("set_id", F.col("first.set_id").alias("other")).repartition("set_id").groupBy("set_id", "other")
    best = tried.agg(F.count(F.lit(1)).alias("times")).groupBy("set_id").agg(F.max(F.struct("times", "other")).alias("best"))
    a, b = F.least("set_id", "best.other").alias("a"), F.greatest("set_id", "best.other").alias("b")
    first_pairs = saved(best.select(a, b).distinct())
    first_links = saved(_verified(first_pairs, sets, frame, text, percent))
    first_found = saved(components(first_links))

    component = first_found.select(F.col("node").alias("set_id"), "component")
    placed = met.select("part", "set_id", "place").join(component, "set_id", "left").select(
        _shingle(F.col("part"), F.col("set_id")).alias("shingle"), "set_id", "place", F.coalesce("component", "set_id").alias("component")
    )
    # One exchange for the components of a shingle and for the rows of those of several.
    placed = placed.repartition("shingle")
    mixed = placed.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    placed = saved(placed.join(mixed.select("shingle"), "shingle", "left_semi"))
    # The first shingle that two classes share has none before it that they share, so that no pair is lost.
    earlier = Window.partitionBy("set_id").orderBy("place").rowsBetween(-BEFORE, -1)
    placed = placed.withColumn("before", F.collect_list("shingle").over(earlier))
    x, y = placed.alias("x"), placed.alias("y")
    crossing = (
        (F.col("x.shingle") == F.col("y.shingle"))
        & (F.col("x.component") < F.col("y.component"))
        & _may_match(F.col("x.place"), F.col("y.place"), percent)
        & ~F.arrays_overlap("x.before", "y.before")
    )
    a, b = F.least("x.set_id", "y.set_id").alias("a"), F.greatest("x.set_id", "y.set_id").alias("b")
    pairs = x.join(y, crossing).select(a, b).distinct()
    # What the first round has looked at and not linked needs no second look.
    more = _verified(pairs.join(first_pairs, ["a", "b"], "left_anti"), sets, frame, text, percent)
    hung = first_found.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return components(hung.unionByName(more))
