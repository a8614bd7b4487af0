"""Periodic runs of words, caught while words are appended, and texts with their repeats taken out.

A run is a longest stretch of words with smallest period q that holds at least
two periods and at least `least` words. It is found through its squares:

A catcher stands over every completed block of m words, m a power of two and the
block's start divisible by m. It waits for the block's words to come again at the
distances, or periods, that belong to m: those whose runs are long enough to
hold such a block in their first part, from 2 m - 1 to 4 m - 2 where a run has two
periods. So two or three catchers of a size wait at any time. When the block comes
again, the words before both places are compared backwards, and from then on each
appended word advances the comparison with the word one period before it. While
the two agree over a period, a square ends with every appended word; squares
side by side are one run, which ends where the comparison does.

Words are appended in slices of any length, word by word as well, with the same
outcome; the steps of a slice are taken together. Words are compared by sums of
random numbers first; every run that is reported was compared word for word.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tillroll.llm.shingles import sliced

#: Words that a run has at least.
LEAST = 12
#: Bytes of text taken together; some hundred bytes of memory for each word.
SLICE_BYTES = 1 << 20

_BASE = 0x9E6C63D0876A9A47
RUNS = "array<struct<start:long,length:long,period:long>>"


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, as many as were ever asked for."""

    def __init__(self):
        self._own, self._inverse = np.empty(0, np.uint64), np.empty(0, np.uint64)

    def upto(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._own) < count:
            size = 1 << count.bit_length()
            for name, base in (("_own", _BASE), ("_inverse", pow(_BASE, -1, 2**64))):
                powers = np.full(size, base, np.uint64)
                powers[0] = 1
                setattr(self, name, np.multiply.accumulate(powers))
        return self._own, self._inverse


_POWERS = _Powers()


def _mixed(words: np.ndarray) -> np.ndarray:
    h = words.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _sizes(least: int, longest: int) -> Iterator[tuple[int, int, int]]:
    """m, and the first and last period whose runs are caught by blocks of m words."""
    spans: dict[int, tuple[int, int]] = {}
    for q in range(1, least):
        # The part of a run that comes again one period later holds an aligned block of m words if it has 2 m - 1.
        m = 1 << ((max(least - q, q) + 1) // 2).bit_length() - 1
        spans[m] = (min(q, spans.get(m, (q, 0))[0]), q)
    m = 1
    while 2 * m - 1 <= longest // 2:
        if 4 * m - 2 >= least:
            spans[m] = (spans.get(m, (2 * m - 1, 0))[0], 4 * m - 2)
        m *= 2
    for m, (low, high) in spans.items():
        if low <= longest // 2:
            yield m, low, min(high, longest // 2)


class RunCatcher:
    """The runs of a sequence of integers that grows at its end.

    longest: the length that no run exceeds, where it is known.
    """

    def __init__(self, least: int = LEAST, longest: int | None = None):
        self._least, self._longest, self._n = least, longest, 0
        self._words, self._sums = np.empty(0, np.int64), np.zeros(1, np.uint64)
        # Comparisons that still agree: period, start, end of what agrees so far.
        self._open = np.empty((3, 0), np.int64)
        self._ended: list[np.ndarray] = []

    def _push(self, words: np.ndarray) -> None:
        end = self._n + len(words)
        if end > len(self._words):
            room = np.empty(max(end, 2 * len(self._words)) - self._n, np.int64)
            self._words = np.concatenate([self._words[: self._n], room])
            self._sums = np.concatenate([self._sums[: self._n + 1], room.view(np.uint64)])
        power, _ = _POWERS.upto(end + 1)
        self._words[self._n : end] = words
        parts = self._sums[self._n + 1 : end + 1]
        np.cumsum(_mixed(words) * power[self._n : end], out=parts)
        parts += self._sums[self._n]
        self._n = end

    def _agreeing(self, at: np.ndarray, period: np.ndarray, most: np.ndarray, forward: bool) -> np.ndarray:
        """How many words from `at` on, or before it, agree with those one period before them; `most` at most."""
        sums, power = self._sums, _POWERS.upto(self._n + 1)[0][period]
        length = np.zeros(len(at), np.int64)
        step = 1 << int(most.max(initial=0)).bit_length()
        while step := step >> 1:
            longer = np.where(length + step <= most, length + step, 0)
            start, stop = (at, at + longer) if forward else (at - longer, at)
            same = (sums[stop - period] - sums[start - period]) * power == sums[stop] - sums[start]
            length = np.where(same & (longer > 0), longer, length)
        return length

    def _caught(self, m: int, low: int, high: int, before: int) -> tuple[np.ndarray, np.ndarray]:
        """Periods and starts of the blocks of m words that come again with a word after `before`."""
        bits, first, last = m.bit_length() - 1, max(low, before - m + 1), self._n - m
        oldest, newest = max(0, first - high + m - 1 >> bits), last - low >> bits
        if first > last or oldest > newest:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        sums, (_, inverse) = self._sums, _POWERS.upto(self._n + 1)
        at = np.arange(first, last + 1)
        seen = (sums[first + m : last + m + 1] - sums[first : last + 1]) * inverse[first : last + 1]
        starts = slice(oldest * m, newest * m + 1, m)
        blocks = (sums[m:][starts] - sums[starts]) * inverse[starts]
        block = (at - high + m - 1 >> bits) - oldest
        periods, found = [], []
        for _ in range((high - low) // m + 1):
            hit = np.flatnonzero(blocks[np.clip(block, 0, len(blocks) - 1)] == seen)
            start, period = (block[hit] + oldest) * m, at[hit] - (block[hit] + oldest) * m
            fits = (block[hit] >= 0) & (period >= low) & (period <= high)
            periods.append(period[fits])
            found.append(start[fits])
            block += 1
        return np.concatenate(periods), np.concatenate(found)

    def append(self, words: np.ndarray) -> np.ndarray:
        """Take more words. Rows period, start, end of the stretches whose squares, two periods long, the new words end or carry on."""
        before = self._n
        self._push(np.asarray(words, np.int64))
        period, start, end = self._open
        known = np.stack([period, start, end + self._agreeing(end, period, self._n - end, True)])
        known = known[:, np.lexsort(known[1::-1])]
        fresh = [known]
        # A block may come again long before the second period is full.
        longest = 2 * self._n if self._longest is None else min(2 * self._n, self._longest)
        for m, low, high in _sizes(self._least, longest):
            period, start = self._caught(m, low, high, before)
            order = np.lexsort((start, period))
            period, start = period[order], start[order]
            # Blocks side by side that come again at one distance are one comparison, as is what an older one covers.
            alone = np.append(True, (np.diff(period) != 0) | (np.diff(start) != m))[: len(period)]
            period, start = period[alone], start[alone]
            if known.shape[1]:
                key = known[0] * (self._n + 1) + known[1]
                at = np.searchsorted(key, period * (self._n + 1) + start, side="right") - 1
                covered = (at >= 0) & (known[0][at] == period) & (known[2][at] >= start + period + m)
                period, start = period[~covered], start[~covered]
            if len(period):
                second = start + period
                back = self._agreeing(second, period, start, False)
                on = self._agreeing(second + m, period, self._n - second - m, True)
                fresh.append(np.unique(np.stack([period, start - back, second + m + on]), axis=1))
        every = np.concatenate(fresh, axis=1)
        running = every[2] == self._n
        self._open = every[:, running]
        long = every[2] - every[1] >= np.maximum(self._least, 2 * every[0])
        self._ended.append(every[:, long & ~running])
        return every[:, long & (every[2] > before)]

    def runs(self) -> np.ndarray:
        """Start, length and period of each run of all words so far, by start and period: three rows."""
        long = self._open[2] - self._open[1] >= np.maximum(self._least, 2 * self._open[0])
        period, start, end = np.concatenate([*self._ended, self._open[:, long]], axis=1)
        order = np.lexsort((period, end, start))
        found, settled = [], None
        for q, s, e in zip(*(x[order].tolist() for x in (period, start, end)), strict=True):
            # Multiples of a run's period agree over just the same words: the smallest is the run's.
            if (s, e) != settled:
                parts = self._compared(q, s, e)
                found += parts
                settled = (s, e) if parts == [(s, e - s, q)] else None
        found.sort(key=lambda run: (run[0], run[1], run[2]))
        smallest = [run for k, run in enumerate(found) if not k or run[:2] != found[k - 1][:2]]
        return np.array(sorted(smallest, key=lambda run: (run[0], run[2])), np.int64).reshape(-1, 3).T

    def _compared(self, period: int, start: int, end: int) -> list[tuple[int, int, int]]:
        """start, length and period of what agrees word for word: the whole stretch, or its parts should sums have misled."""
        same = self._words[start + period : end] == self._words[start : end - period]
        if same.all():
            return [(start, end - start, period)]
        edges = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]])))
        parts = [(start + a, b - a + period, period) for a, b in edges.reshape(-1, 2).tolist()]
        return [x for x in parts if x[1] >= max(self._least, 2 * period)]


def _runs_of(texts: list[bytes], least: int) -> Iterator[tuple[list[dict], bytes]]:
    """For each text its runs and the words that are left, joined by single spaces.

    The texts' words are one sequence, with a word of its own after each text.
    """
    ids: defaultdict[bytes, int] = defaultdict()
    ids.default_factory = ids.__len__
    words = [text.split() for text in texts]  # at 0x09 to 0x0D and 0x20
    lengths = np.array([len(x) for x in words], np.int64)
    offsets = np.concatenate([[0], np.cumsum(lengths + 1)])
    sequence = np.empty(int(offsets[-1]), np.int64)
    for k, own in enumerate(words):
        sequence[offsets[k] : offsets[k + 1] - 1] = np.fromiter(map(ids.__getitem__, own), np.int64, len(own))
        sequence[offsets[k + 1] - 1] = -1 - k
    catcher = RunCatcher(least, int(lengths.max(initial=0)))
    catcher.append(sequence)
    start, length, period = catcher.runs()
    edges = np.zeros(len(sequence) + 1, np.int64)
    np.add.at(edges, start + period, 1)
    np.add.at(edges, start + length, -1)
    kept = np.cumsum(edges) == 0
    bounds = np.searchsorted(start, offsets)
    for k, own in enumerate(words):
        a, b = bounds[k], bounds[k + 1]
        if a == b:
            yield [], b" ".join(own)
            continue
        rows = zip((start[a:b] - offsets[k]).tolist(), length[a:b].tolist(), period[a:b].tolist(), strict=True)
        left = np.flatnonzero(kept[offsets[k] : offsets[k + 1] - 1]).tolist()
        yield [{"start": s, "length": n, "period": q} for s, n, q in rows], b" ".join([own[i] for i in left])


def find_runs(frame: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """key, runs and collapsed for every row.

    Words are runs of bytes other than 0x20 and 0x09 to 0x0D, numbered from 0.
    runs: start, length and period of each run of at least `least` words, by
    start, then period. collapsed: the words outside all runs and those in no
    run after its first period, joined by single spaces.

    Texts are read whole, however long, and cost some hundred bytes of memory for
    each word; time grows by n log n. A null text has no words: no runs, an
    empty text. Repeated rows and null keys stay rows of their own, other columns
    are left out. Nothing is shuffled.
    """
    own = frame.select(key, text)
    schema = T.StructType(
        [own.schema[key], T.StructField("runs", T._parse_datatype_string(RUNS), False), T.StructField("collapsed", T.StringType(), False)]
    )
    kind = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))

    def catch(batches):
        for batch in sliced(batches, 1, SLICE_BYTES):
            texts = [x or b"" for x in batch.column(1).cast(pa.large_binary()).to_pylist()]
            runs, left = zip(*_runs_of(texts, least), strict=True)
            collapsed = pa.array(left, pa.large_binary()).cast(pa.large_string()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(runs, kind), collapsed], names=schema.names)

    return own.mapInArrow(catch, schema)
