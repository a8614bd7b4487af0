"""Conversations mended into turns of user and assistant by the cheapest edits, and the least of these.

Rows of a conversation are edited, in order, until the first letters of their
roles read (s?(ua)+)?: perhaps one system turn, then user and assistant by turns;
or nothing. Edits and their prices:

    Keep    0   the row as it is
    Rerole  1   the row's role becomes user or assistant
    Delete  2   the only edit of blank rows and of duplicates
    Insert  5   an empty user or assistant turn, anywhere
            5   more for every truncated row that isn't deleted

Of the cheapest edits those are taken whose initials in order, the audit, come
first in ASCII. A letter leads from a place in a conversation, and from what was
said last, to one place only, so that the audit tells the edits.

Prices to the end come from dynamic programming over rows and four states. Arcs
on which a cheapest way goes on are nodes of a graph, each with the one that
follows. By doubling they are ranked by the first 1, 2, 4, ... letters of what
begins with them: a rank and the rank of the arc half as far on give the
next rank. Ranks choose the arc to begin with, doubled pointers give its path.

A conversation may be of any length: its rows are ordered by ranges and cut into
blocks of at most BLOCK, and every block is solved from each of the four states. Only
sixteen prices of a block, and where its four paths end, are then gone
through in order, for conversations of several blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillroll.llm.storage import saved

#: Rows that are solved together; a power of two.
BLOCK = 1_024
#: Rows of blocks that are in memory at once, some hundreds of bytes each.
SLICE_ROWS = 1 << 16

_SPACES = " \t\n\x0b\x0c\r"
# What was said last: nothing, system, user, assistant. What may follow by Insert and Rerole.
_NEXT = np.array([2, 2, 3, 2])
_FAR = 1 << 40
#: Prices of what is still to be inserted behind the last row.
_AT_END = np.array([0, 10, 5, 0])
_DELETE, _INSERT, _KEEP, _REROLE = range(4)
_LETTERS = np.array(["D", "I", "K", "R"])
_LEGAL = ((1, 2), (2, 3), (3, 2))
_PATH = "array<struct<edit:string,role:string,row:int>>"


def _after_row(kind: np.ndarray, fault: np.ndarray, later: np.ndarray) -> np.ndarray:
    """Prices in front of rows by state, Insert left out, from those behind them."""
    kept = np.where(fault == 1, 5, np.where(fault > 1, _FAR, 0))
    user, assistant = later[:, 2] + kept + (kind != 2), later[:, 3] + kept + (kind != 3)
    system = np.where(kind == 1, later[:, 1] + kept, _FAR)
    best = later + 2
    best[:, 0] = np.minimum(best[:, 0], np.minimum(system, user))
    best[:, 1] = np.minimum(best[:, 1], user)
    best[:, 2] = np.minimum(best[:, 2], assistant)
    best[:, 3] = np.minimum(best[:, 3], user)
    return best


def _with_inserts(best: np.ndarray) -> np.ndarray:
    out = best.copy()
    out[:, 2] = np.minimum(best[:, 2], best[:, 3] + 5)
    out[:, 3] = np.minimum(best[:, 3], best[:, 2] + 5)
    out[:, 0] = np.minimum(best[:, 0], out[:, 2] + 5)
    out[:, 1] = np.minimum(best[:, 1], out[:, 2] + 5)
    return out


class Blocks:
    """Blocks of rows, each with the prices behind it, side by side.

    codes: 4 * kind + fault of every row; kind: 1 system, 2 user, 3 assistant, 0
    others; fault: 1 truncated, 2 blank, 3 duplicate. Place p of a block stands
    before its row p, the last place behind its last row.
    """

    def __init__(self, codes: np.ndarray, lengths: np.ndarray, after: np.ndarray, last: np.ndarray):
        self.lengths, self.last = lengths, last
        self.base = np.concatenate([[0], np.cumsum(lengths + 1)])
        places = int(self.base[-1])
        self.ends = self.base[1:] - 1
        self._row = np.ones(places, bool)
        self._row[self.ends] = False
        self._kind, self._fault = np.zeros(places, np.int64), np.zeros(places, np.int64)
        self._kind[self._row], self._fault[self._row] = codes >> 2, codes & 3
        self.prices = np.zeros((places, 4), np.int64)
        self.prices[self.ends] = after
        order = np.argsort(-lengths, kind="stable")
        ends, sizes = self.ends[order], lengths[order]
        for back in range(1, int(lengths.max(initial=0)) + 1):
            at = ends[: np.searchsorted(-sizes, -back, side="right")] - back
            best = _after_row(self._kind[at], self._fault[at], self.prices[at + 1])
            self.prices[at] = _with_inserts(best)

    def _arcs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Source, letter and target of each arc that a cheapest way takes; place * 4 + state are sources and targets."""
        places = np.arange(len(self.prices))
        insertable = self._row.copy()
        insertable[self.ends[self.last]] = True
        must = self._fault > 1
        dear = np.where(self._fault == 1, 5, 0)
        found = []
        for state in range(4):
            kept = np.full(len(places), -1)
            kept[self._kind == _NEXT[state]] = _NEXT[state]
            if state == 0:
                kept[self._kind == 1] = 1
            turned = int(_NEXT[state])
            for letter, allowed, step, to, price in (
                (_DELETE, self._row, 1, np.full(len(places), state), 2),
                (_INSERT, insertable, 0, np.full(len(places), turned), 5),
                (_KEEP, self._row & ~must & (kept >= 0), 1, kept, dear),
                (_REROLE, self._row & ~must & (self._kind != turned), 1, np.full(len(places), turned), dear + 1),
            ):
                at = places[allowed]
                price = np.broadcast_to(price, len(places))[allowed]
                best = self.prices[at + step, to[allowed]] + price == self.prices[at, state]
                at, to = at[best], to[allowed][best]
                found.append((at * 4 + state, np.full(len(at), letter), (at + step) * 4 + to))
        source, letter, target = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((letter, source))
        return source[order], letter[order], target[order]

    def least(self, states: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For each state 0 to states - 1 that a block is entered in, the least of its cheapest ways.

        Lengths by block, and for all blocks one after the other the letters, the
        roles 2 or 3 that Insert and Rerole give (else 0) and the rows; last, the
        states in which blocks are left.
        """
        source, letter, target = self._arcs()
        # The arc behind all others stands for an end: its rank is least and it follows itself.
        end = len(source)
        ranks = np.append(letter + 1, 0)
        first = np.searchsorted(source, np.arange(4 * len(self.prices) + 1))
        # Arcs are in the order of their letters: the least that leaves a target follows.
        follows = np.append(np.where(first[target + 1] > first[target], first[target], end), end)
        pointers, count = [], np.append(np.ones(end, np.int64), 0)
        while True:
            pointers.append(follows)
            if (follows == end).all():
                break
            count = count + count[follows]
            pairs = ranks * (end + 2) + ranks[follows]
            ranks = np.unique(pairs, return_inverse=True)[1]
            follows = follows[follows]
        for state in range(states):
            node = self.base[:-1] * 4 + state
            begin, stop = first[node], first[node + 1]
            root = begin.copy()
            for k in range(1, 4):
                other = begin + k
                lower = (other < stop) & (ranks[np.minimum(other, end)] < ranks[np.minimum(root, end)])
                root[lower] = other[lower]
            root = np.where(stop > begin, root, end)
            lengths = count[root]
            starts = np.concatenate([[0], np.cumsum(lengths)])
            arcs = np.empty(int(starts[-1]), np.int64)
            bits = np.frexp(np.maximum(lengths - 1, 0))[1]
            for width in np.unique(bits).tolist():
                own = np.flatnonzero((bits == width) & (lengths > 0))
                paths = root[own][:, None]
                for pointer in pointers[:width]:
                    paths = np.concatenate([paths, pointer[paths]], axis=1)
                inside = np.arange(paths.shape[1]) < lengths[own][:, None]
                arcs[(starts[own][:, None] + np.arange(paths.shape[1]))[inside]] = paths[inside]
            final = node.copy()
            some = lengths > 0
            final[some] = target[arcs[starts[1:][some] - 1]]
            given = np.where((letter[arcs] == _INSERT) | (letter[arcs] == _REROLE), target[arcs] % 4, 0)
            rows = np.where(letter[arcs] == _INSERT, -1, source[arcs] // 4 - np.repeat(self.base[:-1], lengths))
            yield lengths, letter[arcs], given, rows, final % 4


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lengths = batch.column("codes").value_lengths().to_numpy(zero_copy_only=False)
        group = np.cumsum(lengths, dtype=np.int64) // SLICE_ROWS
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        for start, stop in zip(starts.tolist(), [*starts[1:].tolist(), len(group)], strict=True):
            yield batch.slice(start, stop - start)


def _codes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    column = batch.column("codes")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)


def _prices_through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each block the least prices from every state in front of it to every state behind it, 16 numbers."""
    for batch in _slices(batches):
        codes, lengths = _codes(batch)
        none = np.zeros(len(lengths), bool)
        through = np.empty((len(lengths), 4, 4), np.int64)
        for state in range(4):
            after = np.full((len(lengths), 4), _FAR)
            after[:, state] = 0
            blocks = Blocks(codes, lengths, after, none)
            through[:, :, state] = blocks.prices[blocks.base[:-1]]
        prices = pa.FixedSizeListArray.from_arrays(pa.array(through.reshape(-1)), 16).cast(pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv", "id")), prices], names=["conv", "id", "through"])


def _prices_behind(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prices behind each block, conversation by conversation from its last block to its first."""
    held, after = object(), _AT_END
    for batch in batches:
        out = []
        for conv, through in zip(batch.column("conv").to_pylist(), batch.column("through").to_pylist(), strict=True):
            if conv != held:
                held, after = conv, _AT_END
            out.append(after.tolist())
            after = (np.array(through).reshape(4, 4) + after).min(axis=1)
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.list_(pa.int64()))], names=["id", "after"])


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each block, for every state it may be entered in: its price to the end, the least path and the state behind it."""
    kinds = pa.array([None, "user", "assistant"], pa.string())
    for batch in _slices(batches):
        codes, lengths = _codes(batch)
        entire = batch.column("entire").to_numpy(zero_copy_only=False)
        for only in (True, False):
            own = np.flatnonzero(entire == only)
            if not len(own):
                continue
            mine = np.repeat(entire == only, lengths)
            part = batch.take(pa.array(own))
            after = np.array(part.column("after").to_pylist(), np.int64)
            last = part.column("last").to_numpy(zero_copy_only=False)
            blocks = Blocks(codes[mine], lengths[own], after, last)
            # The first block of a conversation is entered with nothing said.
            states = 1 if only else 4
            for state, (sizes, letters, given, rows, final) in enumerate(blocks.least(states)):
                edits = pa.StructArray.from_arrays(
                    [pa.array(_LETTERS[letters], pa.string()), kinds.take(pa.array(np.maximum(given - 1, 0))), pa.array(rows, pa.int32())],
                    names=["edit", "role", "row"],
                )
                offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pa.array(np.full(len(own), state), pa.int32()),
                        pa.array(blocks.prices[blocks.base[:-1], state]),
                        pa.ListArray.from_arrays(offsets, edits),
                        pa.array(final, pa.int32()),
                    ],
                    names=["id", "entered", "cost", "path", "left"],
                )


def _entered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state in which each block is entered, conversation by conversation from its first block on."""
    held, state = object(), 0
    for batch in batches:
        out = []
        for conv, left in zip(batch.column("conv").to_pylist(), batch.column("left").to_pylist(), strict=True):
            if conv != held:
                held, state = conv, 0
            out.append(state)
            state = left[state]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.int32())], names=["id", "entered"])


def _kind(role: Column) -> Column:
    initial = F.substring(role, 1, 1)
    return F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(0)


def _ordered(frame: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """at, conv, turn, role, text: rows numbered by conversation, turn (null first), role and text.

    Dealt out by ranges of all of these and a random number, so that neither a
    long conversation nor a row that is repeated often stays in one task.
    """
    own = frame.select(
        F.col(conv).alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
        F.rand(17).alias("spread"),
    )
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "text", "spread"]
    sorted_rows = own.repartitionByRange(*order).sortWithinPartitions(*order)
    return saved(sorted_rows.select(F.monotonically_increasing_id().alias("at"), "conv", "turn", "role", "text"))


def _blocks(rows: DataFrame, block: int) -> DataFrame:
    """Rows of a conversation in blocks: id (the first row's number), ats, codes, counts of faults and illegal neighbours."""
    said = F.rtrim("text", F.lit(_SPACES))
    blank, cut = said == "", ~F.substring(said, -1, 1).isin(".", "!", "?")
    described = rows.select("at", "conv", _kind(F.col("role")).alias("kind"), blank.alias("blank"), cut.alias("cut"))
    # The first row of each role and text; a number is there once, so that no key is hot.
    firsts = rows.where(~blank).groupBy("conv", "role", "text").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    joined = described.join(firsts, "at", "left")
    fault = F.when(F.col("blank"), 2).when(F.col("first").isNull(), 3).when(F.col("cut"), 1).otherwise(0)
    coded = joined.select("at", "conv", (F.col("kind") * 4 + fault).cast("byte").alias("code"))
    part = F.call_function("div", F.col("at"), F.lit(block))
    grouped = coded.groupBy("conv", part.alias("part")).agg(F.sort_array(F.collect_list(F.struct("at", "code"))).alias("rows"))
    # One row for each block.
    order = Window.partitionBy("conv").orderBy("part")
    codes = F.col("codes")
    placed = grouped.select("conv", "part", F.col("rows.at").alias("ats"), F.col("rows.code").alias("codes")).withColumns(
        {"next": F.lead(F.element_at("codes", 1)).over(order), "begins": F.lag("part").over(order).isNull()}
    )
    kinds = F.transform(F.when(F.col("next").isNull(), codes).otherwise(F.array_append(codes, F.col("next"))), lambda x: F.shiftright(x.cast("int"), 2))
    pairs = F.zip_with(F.slice(kinds, 1, F.size(kinds) - 1), F.slice(kinds, 2, F.size(kinds)), lambda a, b: a * 4 + b)
    legal = [a * 4 + b for a, b in _LEGAL]

    def faulty(fault: int) -> Column:
        return F.size(F.filter(codes, lambda x: x % 4 == fault)).cast("long")

    last = F.col("next").isNull()
    return saved(
        placed.select(
            F.element_at("ats", 1).alias("id"),
            "conv",
            "ats",
            "codes",
            "begins",
            last.alias("last"),
            (F.col("begins") & last).alias("alone"),
            faulty(2).alias("blank"),
            faulty(3).alias("duplicate"),
            faulty(1).alias("truncated"),
            F.size(F.filter(pairs, lambda x: ~x.isin(legal))).cast("long").alias("illegal"),
        )
    )


def _solved(blocks: DataFrame, kind: str) -> DataFrame:
    """id, cost and path of every block: its part of the least of the conversation's cheapest edits, and the price from there on."""
    at_end = F.array(*(F.lit(int(x)).cast("long") for x in _AT_END))
    single, several = blocks.where("alone"), blocks.where("not alone")
    through = several.select("conv", "id", "codes").mapInArrow(_prices_through, f"conv {kind}, id long, through array<long>")
    backward = through.repartition("conv").sortWithinPartitions("conv", F.desc("id"))
    behind = backward.mapInArrow(_prices_behind, "id long, after array<long>")
    fields = ("id", "codes", "after", "last", F.col("begins").alias("entire"))
    ready = several.join(behind, "id").select(*fields).unionByName(single.withColumn("after", at_end).select(*fields))
    paths = saved(ready.mapInArrow(_paths, f"id long, entered int, cost long, path {_PATH}, left int"))
    ends = paths.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("entered", "left"))).alias("ends"))
    chain = several.select("conv", "id").join(ends, "id").select("conv", "id", F.col("ends.left").alias("left"))
    forward = chain.repartition("conv").sortWithinPartitions("conv", "id")
    entered = forward.mapInArrow(_entered, "id long, entered int").unionByName(single.select("id", F.lit(0).alias("entered")))
    return saved(paths.join(entered, ["id", "entered"]).select("id", "cost", "path"))


def repairs(
    frame: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    every: DataFrame | None = None,
    block: int = BLOCK,
) -> tuple[DataFrame, DataFrame]:
    """The edits of all conversations, one row each, and a summary of each conversation.

    Edits: conv, id and step, by which they are in order; edit (K, R, D or I); role
    and text after the edit, null where a row is deleted.

    Summary: conv; gaps, the turn numbers missing between the least and the
    largest; blank, duplicate and truncated, rows by their first fault; illegal,
    neighbours that are not system-user, user-assistant or assistant-user by first
    letters; cost and audit of the edits. Conversations of the frame `every`
    that have no row are listed with zeros and an empty audit.

    A row is blank without a character other than 0x20 and 0x09 to 0x0D, a
    duplicate if its role and text were in the conversation before, truncated if
    its last such character is none of . ! ?. Null roles and texts read as one
    space, null turns go first, equal turns by role and text; a null conversation
    is one conversation. Other columns are left out; an empty frame has no edits.

    Texts move twice, to be ordered and to find duplicates; a conversation's audit
    is one string.
    """
    if block & (block - 1) or not 0 < block <= 1 << 33:
        raise ValueError("block must be a power of two.")
    rows = _ordered(frame, conv, turn, role, text)
    blocks = _blocks(rows, block)
    solved = _solved(blocks, rows.schema["conv"].dataType.simpleString())
    known = blocks.join(solved, "id")
    steps = known.select("conv", "id", "ats", F.posexplode("path").alias("step", "done")).select(
        "conv", "id", "step", "done.edit", F.col("done.role").alias("given"), F.get("ats", F.col("done.row")).alias("at")
    )
    gone, new = F.col("edit") == "D", F.col("edit") == "I"
    edits = steps.join(rows.select("at", "role", "text"), "at", "left").select(
        F.col("conv").alias(conv),
        "id",
        "step",
        "edit",
        F.when(~gone, F.coalesce("given", "role")).alias("role"),
        F.when(new, "").when(~gone, F.col("text")).alias("text"),
    )

    none, zero = F.lit(None).cast("long"), F.lit(0).cast("long")
    sums, turns = ["blank", "duplicate", "truncated", "illegal", "cost"], ["low", "high", "turns"]
    piece = F.struct("id", F.array_join(F.transform("path", lambda x: x["edit"]), "").alias("letters")).alias("piece")
    empty = F.lit(None).cast("struct<id:long,letters:string>").alias("piece")
    # The price from the first block on is that of all.
    counted = known.withColumn("cost", F.when(F.col("begins"), F.col("cost")).otherwise(0)).select("conv", *sums, *[none.alias(x) for x in turns], piece)
    span = rows.groupBy("conv", "turn").agg(F.lit(1)).groupBy("conv").agg(F.min("turn").alias("low"), F.max("turn").alias("high"), F.count("turn").alias("turns"))
    parts = counted.unionByName(span.select("conv", *[zero.alias(x) for x in sums], *turns, empty))
    if every is not None:
        listed = every.select(F.col(conv).alias("conv")).distinct()
        parts = parts.unionByName(listed.select("conv", *[zero.alias(x) for x in sums], *[none.alias(x) for x in turns], empty))
    gaps = F.max("high") - F.min("low") + 1 - F.max("turns")
    summary = parts.groupBy("conv").agg(
        F.coalesce(gaps, zero).alias("gaps"),
        *[F.sum(x).alias(x) for x in sums],
        F.array_join(F.transform(F.sort_array(F.collect_list("piece")), lambda x: x["letters"]), "").alias("audit"),
    )
    return edits, summary.withColumnRenamed("conv", conv)
