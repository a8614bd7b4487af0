"""Hashes of word shingles, computed on whole Arrow batches with numpy.

Words are runs of bytes other than space and 0x09 to 0x0D, A-Z lower-cased. A
document's set has its distinct shingles of five words; with fewer words the
whole sequence as one; without words it is empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORDS = 5
#: Bytes of text hashed at once; some fifty bytes of memory for each.
SLICE_BYTES = 1 << 19

_RANDOM = np.random.Generator(np.random.PCG64(20240607))
_OF_BYTE = _RANDOM.integers(1, 2**64, 256, np.uint64)
_OF_BYTE[65:91] = _OF_BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_OF_BYTE[_SPACE] = 0
_BASE = int(_RANDOM.integers(0, 2**63)) | 1
_PLACES = _RANDOM.integers(1, 2**64, WORDS, np.uint64) | np.uint64(1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


@lru_cache(maxsize=1)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, 2**bits each."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 2**64)):
        powers = np.full(1 << bits, base, np.uint64)
        powers[0] = 1
        out.append(np.multiply.accumulate(powers))
    return out[0], out[1]


def _word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of data, and where each begins; starts: where documents begin, besides 0."""
    power, inverse = _powers(max(SLICE_BYTES, len(data)).bit_length())
    space = _SPACE[data]
    gap = np.empty(len(data), bool)
    gap[0] = True
    gap[1:] = space[:-1]
    gap[starts[starts < len(data)]] = True
    first = np.flatnonzero(gap & ~space)
    if not len(first):
        return np.empty(0, np.uint64), first
    # A word ends before the next space or document.
    stops = np.union1d(np.flatnonzero(space), starts)
    at = np.searchsorted(stops, first, side="right")
    last = np.append(stops, len(data))[at]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_OF_BYTE[data] * power[: len(data)], out=sums[1:])
    return _mixed((sums[last] - sums[first]) * inverse[first] + (last - first).astype(np.uint64)), first


def _cuts(data: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of about SLICE_BYTES that end with a document or at a space."""
    at, stop = int(ends[0]), int(ends[-1])
    while at < stop:
        end = int(ends[np.searchsorted(ends, at + SLICE_BYTES, side="right") - 1])
        if end <= at:
            own = int(ends[np.searchsorted(ends, at, side="right")])
            end = min(at + SLICE_BYTES, own)
            while end < own:
                space = np.flatnonzero(_SPACE[data[end : end + SLICE_BYTES]])
                if len(space):
                    end += int(space[0])
                    break
                end = min(end + SLICE_BYTES, own)
        yield at, end
        at = end


def sliced(batches: Iterator[pa.RecordBatch], column: int | str, size: int = 8 * SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in smaller batches: about `size` bytes of text, or one row."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(lengths, dtype=np.int64) // size
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(group)], strict=True):
            yield batch.slice(start, end - start)


def _text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the places between them; a null text is empty."""
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    _, places, data = texts.buffers()
    ends = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8), ends


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes (64 bits) of its shingles."""
    if not len(texts):
        return
    data, ends = _text_bytes(texts)
    hashes, places = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for start, end in _cuts(data, ends):
        inner = ends[(ends > start) & (ends < end)] - start
        found, first = _word_hashes(data[start:end], inner)
        hashes.append(found)
        places.append(first + start)
    words, first = np.concatenate(hashes), np.concatenate(places)
    bounds = np.searchsorted(first, ends)
    rolled = np.zeros(max(0, len(words) - WORDS + 1), np.uint64)
    for k in range(WORDS):
        rolled += words[k : k + len(rolled)] * _PLACES[k]
    rolled = _mixed(rolled)
    for begin, stop in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        count = stop - begin
        if count >= WORDS:
            yield np.unique(rolled[begin : stop - WORDS + 1])
        elif count:
            yield _mixed(np.array([(words[begin:stop] * _PLACES[:count]).sum() + np.uint64(count)], np.uint64))
        else:
            yield np.empty(0, np.uint64)
