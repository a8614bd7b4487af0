"""Packing of documents into token sequences, planned on a histogram of lengths.

1. Every document becomes token pieces; only one longer than a sequence is cut,
   its first piece taking what is left over full ones.
2. Best fit, longest first, is run on counts: all pieces of a length are placed
   together into the sequences with the least sufficient room. The plan is a
   list of runs and depends on the number of lengths, not of documents.
3. Each piece takes the slot of its rank among pieces of its length. Ranks are
   counted per length and chunk, and chunks are summed up, so that a length that
   a third of all pieces share is spread over as many tasks as any other.
"""

from __future__ import annotations

import json
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tillroll.llm.bpe import byte_bpe, read_ranks
from tillroll.llm.chunks import uneven
from tillroll.llm.shingles import sliced
from tillroll.llm.storage import saved

#: Parts of texts that a worker remembers, none of them longer than LONGEST_REMEMBERED: some 400 bytes each at most.
MOST_REMEMBERED = 250_000
LONGEST_REMEMBERED = 40
#: Longer parts are met once and go to the encoder that needs no recursion.
LONG_PART = 1_000


class _Uneven(Exception):
    """A space of the text doesn't stand alone."""


class _Parts(dict):
    """Ids of the parts of texts that follow a space of their own, found when first asked for."""

    def __init__(self, path: str, pattern: str, special: tuple[tuple[str, int], ...]):
        self._special = {string: np.array([number], "<u4").tobytes() for string, number in special}
        # Of several that begin at one place the longest counts.
        longest = sorted(map(re.escape, self._special), key=len, reverse=True)
        self._split = re.compile("(" + "|".join(longest) + ")").split if longest else None
        self._fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})
        self._file = path, pattern

    def _exactly(self, text: str) -> bytes:
        """By the encoder for any text, which is built when first needed."""
        return byte_bpe(*self._file).encode_all([text])[0]

    def encode(self, part: str) -> bytes:
        if len(part) > LONG_PART:
            return self._exactly(part)
        return np.array(self._fast.encode_ordinary(part), "<u4").tobytes()

    def __missing__(self, part: str) -> bytes:
        if uneven(part):
            raise _Uneven
        ids = self.encode(" " + part)
        if len(self) < MOST_REMEMBERED and len(part) <= LONGEST_REMEMBERED:
            self[part] = ids
        return ids

    def ids_of(self, text: str) -> bytes:
        """Ids of a text in which special strings have their own and part what is before from what is behind."""
        if self._split is None:
            return self.plain(text)
        return b"".join(self._special.get(x) or self.plain(x) for x in self._split(text) if x)

    def plain(self, text: str) -> bytes:
        first, *rest = text.split(" ")
        try:
            if rest and uneven(first):
                raise _Uneven
            return self.encode(first) + b"".join(map(self.__getitem__, rest))
        except _Uneven:
            return self._exactly(text)


@lru_cache(maxsize=2)
def _parts(path: str, pattern: str, special: tuple[tuple[str, int], ...]) -> _Parts:
    return _Parts(path, pattern, special)


def special_strings(vocabulary_path: str) -> dict[str, int]:
    """The added tokens of a vocabulary in JSON, with their ids; those that take spaces with them or are found in normalized text are refused."""
    with open(vocabulary_path, encoding="utf-8") as file:
        added = json.load(file)["added_tokens"]
    for token in added:
        if token["lstrip"] or token["rstrip"] or token["single_word"]:
            raise ValueError(f"{token['content']} isn't a plain string.")
    return {token["content"]: token["id"] for token in added}


def token_pieces(
    frame: DataFrame,
    ranks_path: str,
    pattern: str,
    capacity: int = 2048,
    key: str = "doc_id",
    text: str = "text",
    last_id: int = 0,
    keep_ids: bool = False,
    special: dict[str, int] | None = None,
) -> DataFrame:
    """Per piece: key, piece (from 0), start, length, ids_crc32, and ids if they are to be kept.

    A document is the ids of its text, then last_id; strings in `special` have
    the ids given there wherever they stand in a text. A null text counts as empty, so every row has one piece at least.
    ids_crc32 is of the ids as little-endian unsigned 32-bit integers. Repeated
    rows each give their pieces; other columns are left out.
    """
    own = frame.select(key, text)
    fields = [
        own.schema[key],
        T.StructField("piece", T.IntegerType(), False),
        T.StructField("start", T.LongType(), False),
        T.StructField("length", T.LongType(), False),
        T.StructField("ids_crc32", T.LongType(), False),
    ]
    if keep_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType(), False), False))
    schema = T.StructType(fields)
    strings = tuple(sorted((special or {}).items()))

    def encode(batches):
        parts, end = _parts(ranks_path, pattern, strings), np.array([last_id], "<u4").tobytes()
        for batch in sliced(batches, text):
            rows, pieces, starts, lengths, sums, kept = [], [], [], [], [], []
            for row, value in enumerate(batch.column(text)):
                ids = parts.ids_of(value.as_py() or "") + end
                n = len(ids) // 4
                at, piece = 0, 0
                length = n if n <= capacity else n % capacity or capacity
                while at < n:
                    part = ids[4 * at : 4 * (at + length)]
                    rows.append(row)
                    pieces.append(piece)
                    starts.append(at)
                    lengths.append(length)
                    sums.append(zlib.crc32(part))
                    if keep_ids:
                        kept.append(np.frombuffer(part, "<u4").astype(np.int32))
                    at, piece, length = at + length, piece + 1, capacity
            columns = [
                batch.column(key).take(pa.array(rows, pa.int64())),
                pa.array(pieces, pa.int32()),
                pa.array(starts, pa.int64()),
                pa.array(lengths, pa.int64()),
                pa.array(sums, pa.int64()),
            ]
            if keep_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return own.mapInArrow(encode, schema)


def plan_runs(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit, longest first, over how many pieces each length has.

    A run (length, first_rank, pieces, first_sequence, per_sequence, base) puts
    pieces of consecutive rank into consecutive sequences, per_sequence in each,
    from the place base on.
    """
    room: dict[int, list[tuple[int, int]]] = {}
    runs, sequences = [], 0

    def place(length: int, rank: int, left: int, space: int, first: int, many: int) -> int:
        """Fills up to `many` sequences with that space; gives how many pieces found place."""
        fit = space // length
        full = min(many, left // fit)
        placed = full * fit
        if full:
            runs.append((length, rank, placed, first, fit, capacity - space))
            if space > fit * length:
                room.setdefault(space - fit * length, []).append((first, full))
        some = min(left - placed, fit) if full < many else 0
        if some:
            runs.append((length, rank + placed, some, first + full, some, capacity - space))
            if space > some * length:
                room.setdefault(space - some * length, []).append((first + full, 1))
        used = full + bool(some)
        if used < many:
            room.setdefault(space, []).append((first + used, many - used))
        return placed + some

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        for space in sorted(s for s in room if s >= length):
            groups = room.pop(space)
            while groups and left:
                done = place(length, rank, left, space, *groups.pop())
                rank, left = rank + done, left - done
            if groups:
                room.setdefault(space, []).extend(groups)
            if not left:
                break
        if left:
            new = -(-left // (capacity // length))
            place(length, rank, left, capacity, sequences, new)
            sequences += new
    return runs


def pack_pieces(pieces: DataFrame, capacity: int = 2048, key: str = "doc_id") -> DataFrame:
    """All columns of pieces with sequence_id and offset: gapless sequences of at most capacity tokens.

    Expects the columns key, piece, length and ids_crc32 with lengths from 1 to
    capacity. Equal pieces may change places with each other. An empty table
    gives an empty one.
    """
    spark = pieces.sparkSession
    clash = {"sequence_id", "offset"} & {c.lower() for c in pieces.columns}
    if clash:
        raise ValueError(f"The frame already has the columns {sorted(clash)}.")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    by_length: dict[int, list] = {}
    for length, *run in plan_runs(counts, capacity):
        by_length.setdefault(length, []).append(tuple(run))
    runs_type = "array<struct<first:long,pieces:long,sequence:long,per:long,base:long>>"
    plan = spark.createDataFrame([(n, sorted(runs)) for n, runs in by_length.items()], f"_length long, _runs {runs_type}")

    chunks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = pieces.withColumn("_chunk", F.pmod(F.xxhash64(key, "piece"), F.lit(chunks)))
    per_chunk = dealt.groupBy(F.col("length").alias("_length"), F.col("_chunk").alias("_of")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_length").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    firsts = per_chunk.withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    within = Window.partitionBy("length", "_chunk").orderBy(key, "piece", "ids_crc32")
    ranked = (
        dealt.withColumn("_rank", F.row_number().over(within))
        .join(firsts, (F.col("length") == F.col("_length")) & (F.col("_chunk") == F.col("_of")))
        .withColumn("_rank", F.col("_rank") - 1 + F.col("_first"))
        .drop("_length", "_of", "_first", "_chunk")
    )
    # The plan has one row for each length; its size doesn't depend on the number of pieces.
    slotted = ranked.join(F.broadcast(plan), F.col("length") == F.col("_length"))
    run = F.element_at(F.filter("_runs", lambda r: r["first"] <= F.col("_rank")), -1)
    slotted = slotted.withColumn("_run", run).withColumn("_rank", F.col("_rank") - F.col("_run.first"))
    return slotted.select(
        *pieces.columns,
        (F.col("_run.sequence") + F.floor(F.col("_rank") / F.col("_run.per"))).cast("long").alias("sequence_id"),
        (F.col("_run.base") + F.pmod(F.col("_rank"), F.col("_run.per")) * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(
    frame: DataFrame,
    ranks_path: str,
    pattern: str,
    capacity: int = 2048,
    key: str = "doc_id",
    text: str = "text",
    keep_ids: bool = False,
    special: dict[str, int] | None = None,
) -> DataFrame:
    """The pieces of all documents with their places; see token_pieces and pack_pieces.

    Texts are encoded once: the pieces are written to the checkpoint folder and
    read for the histogram and again for the places.
    """
    pieces = saved(token_pieces(frame, ranks_path, pattern, capacity, key, text, keep_ids=keep_ids, special=special))
    return pack_pieces(pieces, capacity, key)
