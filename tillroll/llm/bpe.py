"""Byte-level BPE: text to token ids and back, by the ranks of a public vocabulary.

Within a match of the split pattern, neighbouring tokens are joined as long as
their bytes together are a token; the pair of lowest rank goes first, of equals
the leftmost. A segment tree over byte positions holds, for each live position,
the rank of the pair that begins there, and at its root the leftmost minimum.
A merge changes three leaves (the pair before, the merged one, the one that
died), each in as many steps as the tree is high.

Short matches of equal tree size are merged side by side, one row of a numpy
array each; long ones one at a time. Both follow the same steps.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tillroll.llm.chunks import RememberedEncoder, slices
from tillroll.llm.shingles import sliced

_NONE = np.int64(2**62)
#: Matches of at most so many bytes are merged side by side.
SHORT = 64
#: Rows that are merged together, so that their trees stay in a core's cache.
ROWS = 8192


@lru_cache(maxsize=4)
def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks by token bytes, from lines of a base64 token and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class ByteBpe:
    """Ids of texts by ranks, each match of the pattern on its own, and the bytes of ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self._ranks = ranks
        self._pattern = regex.compile(pattern)
        self._whole = {token: array("I", [rank]).tobytes() for token, rank in ranks.items()}
        self._bytes_of = {rank: token for token, rank in ranks.items()}
        self._of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for at in range(1, len(token)):
                left, right = ranks.get(token[:at]), ranks.get(token[at:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        keys = np.array(sorted(pairs), np.int64)
        self._pair_keys = np.append(keys, _NONE)
        self._pair_ranks = np.append(np.array([pairs[k] for k in keys.tolist()], np.int64), _NONE)
        self._pairs = pairs
        self._encoder = RememberedEncoder(self._encode_parts)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        return self._encoder.encode_all(texts)

    def decode(self, ids: bytes) -> bytes:
        """The bytes that ids stand for."""
        return b"".join(map(self._bytes_of.__getitem__, memoryview(ids).cast("I").tolist()))

    def _encode_parts(self, parts: list[str]) -> list[bytes]:
        matches = [[p.encode()] if p[1:].isalpha() and p[0] == " " else self._matches(p) for p in parts]
        new = {m for of_part in matches for m in of_part}
        known = {m: self._whole[m] for m in new.intersection(self._whole)}
        known.update(self._merge_all(new.difference(known)))
        return [known[m[0]] if len(m) == 1 else b"".join([known[x] for x in m]) for m in matches]

    def _matches(self, part: str) -> list[bytes]:
        return [m.encode() for m in self._pattern.findall(part)]

    def _merge_all(self, matches: Iterable[bytes]) -> dict[bytes, bytes]:
        by_size: dict[int, list[bytes]] = {}
        merged = {}
        for m in matches:
            if len(m) > SHORT:
                merged[m] = self._merge_long(m)
            else:
                by_size.setdefault(1 << max(1, (len(m) - 1).bit_length()), []).append(m)
        for size, group in by_size.items():
            for at in range(0, len(group), ROWS):
                rows = group[at : at + ROWS]
                merged.update(zip(rows, self._merge_rows(rows, size), strict=True))
        return merged

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; _NONE where a side is missing (-1) or the pair is no token."""
        keys = left << 32 | right
        at = np.searchsorted(self._pair_keys, keys)
        at[at == len(self._pair_keys)] = len(self._pair_keys) - 1
        found = (self._pair_keys[at] == keys) & (left >= 0) & (right >= 0)
        return np.where(found, self._pair_ranks[at], _NONE)

    def _merge_rows(self, matches: list[bytes], size: int) -> list[bytes]:
        """Merges matches of up to size bytes; size is a power of two."""
        rows = len(matches)
        lengths = np.array([len(m) for m in matches])
        raw = np.frombuffer(b"".join(m.ljust(size, b"\0") for m in matches), np.uint8).reshape(rows, size)
        place = np.arange(size)
        live = place < lengths[:, None]
        # Position size stands for "no neighbour"; its token is -1.
        token = np.full((rows, size + 1), -1, np.int64)
        token[:, :size] = np.where(live, self._of_byte[raw], -1)
        after = np.full((rows, size + 1), size, np.int64)
        after[:, :size] = np.where(place + 1 < lengths[:, None], place + 1, size)
        before = np.full((rows, size + 1), size, np.int64)
        before[:, 1:size] = place[:-1]
        tree = np.full((rows, 2 * size), _NONE, np.int64)
        rank = self._ranks_of(token[:, :-1].ravel(), token[:, 1:].ravel()).reshape(rows, size)
        tree[:, size:] = np.where(rank < _NONE, rank * size + place, _NONE)
        half = size
        while half > 1:
            level = tree[:, half : 2 * half]
            half //= 2
            tree[:, half : 2 * half] = np.minimum(level[:, ::2], level[:, 1::2])

        flat_token, flat_after, flat_before, flat_tree = token.ravel(), after.ravel(), before.ravel(), tree.ravel()
        row = np.flatnonzero(tree[:, 1] < _NONE)
        while len(row):
            base, root = row * (size + 1), row * 2 * size
            best = flat_tree[root + 1]
            at, new = best % size, best // size
            dead = flat_after[base + at]
            right = flat_after[base + dead]
            left = flat_before[base + at]
            flat_token[base + at] = new
            flat_token[base + dead] = -1
            flat_after[base + at] = right
            flat_before[base + right] = at
            rank = self._ranks_of(new, flat_token[base + right])
            self._put(flat_tree, root, at + size, np.where(rank < _NONE, rank * size + at, _NONE))
            self._put(flat_tree, root, dead + size, np.full(len(row), _NONE))
            has_left = np.flatnonzero(left < size)
            if len(has_left):
                rank = self._ranks_of(flat_token[base[has_left] + left[has_left]], new[has_left])
                keys = np.where(rank < _NONE, rank * size + left[has_left], _NONE)
                self._put(flat_tree, root[has_left], left[has_left] + size, keys)
            row = row[flat_tree[root + 1] < _NONE]
        kept = token[:, :size]
        alive = kept >= 0
        ids = kept[alive].astype("<u4").tobytes()
        ends = np.cumsum(alive.sum(axis=1)) * 4
        return [ids[start:end] for start, end in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    @staticmethod
    def _put(tree: np.ndarray, root: np.ndarray, node: np.ndarray, key: np.ndarray) -> None:
        """Point update: a leaf of each row, then its ancestors."""
        tree[root + node] = key
        up = int(node[0]).bit_length() - 1
        for _ in range(up):
            other = tree[root + (node ^ 1)]
            key = np.minimum(key, other)
            node = node >> 1
            tree[root + node] = key

    def _merge_long(self, match: bytes) -> bytes:
        """Merges one match of any length, each merge in logarithmic time."""
        n = len(match)
        size = 1 << (n - 1).bit_length()
        token = self._of_byte[np.frombuffer(match, np.uint8)].tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs, none = self._pairs, int(_NONE)
        tree = [none] * (2 * size)

        def key(at: int) -> int:
            right = after[at]
            rank = pairs.get(token[at] << 32 | token[right]) if right < n else None
            return none if rank is None else rank * size + at

        for at in range(n):
            tree[size + at] = key(at)
        for node in range(size - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(at: int, value: int) -> None:
            node = size + at
            tree[node] = value
            while node > 1:
                node >>= 1
                value = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == value:
                    return
                tree[node] = value

        while (best := tree[1]) < none:
            rank, at = divmod(best, size)
            dead = after[at]
            right = after[dead]
            token[at] = rank
            token[dead] = -1
            after[at] = right
            if right < n:
                before[right] = at
            put(at, key(at))
            put(dead, none)
            if (left := before[at]) >= 0:
                put(left, key(left))
        return np.array([t for t in token if t >= 0], "<u4").tobytes()


@lru_cache(maxsize=4)
def byte_bpe(path: str, pattern: str) -> ByteBpe:
    """The encoder of a vocabulary file; a Python worker builds it once."""
    return ByteBpe(read_ranks(path), pattern)


def _added(frame: DataFrame, *fields: T.StructField) -> T.StructType:
    clash = {f.name.lower() for f in fields} & {c.lower() for c in frame.columns}
    if clash:
        raise ValueError(f"The frame already has the columns {sorted(clash)}.")
    return T.StructType([*frame.schema.fields, *fields])


def bpe_encode(frame: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """All columns and ids, the token ids of the text as an array of int.

    A null or empty text has an empty array. Rows are independent of each
    other: repeated rows stay, an empty table gives an empty one. ranks_path
    must be readable on every executor. A column named ids is refused.
    """
    schema = _added(frame, T.StructField("ids", T.ArrayType(T.IntegerType(), False), False))

    def encode(batches):
        bpe = byte_bpe(ranks_path, pattern)
        for batch in sliced(batches, text):
            texts = [t or "" for t in batch.column(text).to_pylist()]
            ids = bpe.encode_all(texts)
            ends = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
            values = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
            column = pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=schema.names)

    return frame.mapInArrow(encode, schema)


def bpe_decode(frame: DataFrame, ranks_path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """All columns and decoded, the bytes that the ids stand for; null ids give no bytes.

    An id that the vocabulary lacks fails the job. A column named decoded is refused.
    """
    schema = _added(frame, T.StructField("decoded", T.BinaryType(), False))

    def decode(batches):
        bpe = byte_bpe(ranks_path, pattern)
        for batch in batches:
            rows = batch.column(ids).to_pylist()
            out = [bpe.decode(np.array(row or [], "<u4").tobytes()) for row in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=schema.names)

    return frame.mapInArrow(decode, schema)


def bpe_round_trip(frame: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, n_tokens, and digests of each text's ids and of the bytes decoded from these ids.

    Encoding and decoding as in bpe_encode and bpe_decode, without sending the
    ids out of the worker: ids_sha256 is of the ids as little-endian unsigned
    32-bit integers, decoded_sha256 of the bytes. A null text counts as empty,
    a null key stays null.
    """
    own = frame.select(key, text)
    schema = T.StructType(
        [
            own.schema[key],
            T.StructField("n_tokens", T.LongType(), False),
            T.StructField("ids_sha256", T.StringType(), False),
            T.StructField("decoded_sha256", T.StringType(), False),
        ]
    )

    def digest(batches):
        bpe = byte_bpe(ranks_path, pattern)
        for batch in sliced(batches, text):
            counts, of_ids, of_bytes = [], [], []
            for part in slices([t or "" for t in batch.column(text).to_pylist()]):
                for ids in bpe.encode_all(part):
                    counts.append(len(ids) // 4)
                    of_ids.append(hashlib.sha256(ids).hexdigest())
                    of_bytes.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            columns = [batch.column(key), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return own.mapInArrow(digest, schema)
