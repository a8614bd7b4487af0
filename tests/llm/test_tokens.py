"""Byte-level BPE and packing against the public libraries and brute force."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from pyspark.sql import functions as F

from tillroll.llm import bpe, chunks, packing, queries

ODD = [
    None, "", " ", "  a  b ", "a\n\n b\t\tc", "aaa" * 3000, "x" * 100, "　 é\x85 b's 'll", "日本語テキスト 🙂🙂 12 345",
    "\x1c a\x1cb", "'s 's", "ab " * 10 + "\n", "<|endoftext|> a<|endoftext|>", "word " * 3000, "a  b", " lead", "tail ",
]


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, length string")


def tiktoken_of(path):
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})


def test_ids_are_those_of_the_library(spark):
    texts = ODD + [r.text for r in queries.table(spark, "/root/testdata/sf0.001", "documents").collect()]
    encoder, wanted = bpe.byte_bpe(queries.MULTI_RANKS, public_tokenizers.PATTERN), tiktoken_of(queries.MULTI_RANKS)
    for _ in range(2):  # the second time from memory
        for text, ids in zip(texts, encoder.encode_all([t or "" for t in texts]), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == wanted.encode_ordinary(text or "")
            assert encoder.decode(ids) == (text or "").encode()


def test_long_matches_merge_as_short_ones():
    encoder = bpe.byte_bpe(queries.MULTI_RANKS, public_tokenizers.PATTERN)
    rng = random.Random(3)
    for _ in range(200):
        match = bytes(rng.choice(b"aberthisn ") for _ in range(rng.randint(2, 64)))
        size = 1 << max(1, (len(match) - 1).bit_length())
        assert encoder._merge_rows([match], size) == [encoder._merge_long(match)]


def test_generations_forget_and_still_know(monkeypatch):
    monkeypatch.setattr(chunks, "MOST_REMEMBERED", 3)
    monkeypatch.setattr(chunks, "SLICE_CHARS", 10)
    encoder = chunks.RememberedEncoder(lambda parts: [p.encode() for p in parts])
    texts = ["a b c d e", "b c d", "f g h i  j", "a b z", "", " x"]
    assert [b.decode() for b in encoder.encode_all(texts * 3)] == texts * 3


def test_encode_and_decode_columns(spark):
    frame = docs(spark, ODD)
    back = bpe.bpe_decode(bpe.bpe_encode(frame, queries.MULTI_RANKS, public_tokenizers.PATTERN), queries.MULTI_RANKS, public_tokenizers.PATTERN)
    for row in back.collect():
        assert bytes(row.decoded) == (row.text or "").encode()
    assert bpe.bpe_encode(frame.limit(0), queries.MULTI_RANKS, public_tokenizers.PATTERN).count() == 0
    with pytest.raises(ValueError, match="ids"):
        bpe.bpe_encode(frame.withColumn("IDS", F.lit(1)), queries.MULTI_RANKS, public_tokenizers.PATTERN)


def test_round_trip_digests(spark):
    wanted = tiktoken_of(queries.MULTI_RANKS)
    for row in bpe.bpe_round_trip(docs(spark, ODD), queries.MULTI_RANKS, public_tokenizers.PATTERN).collect():
        ids = wanted.encode_ordinary(ODD[row.doc_id] or "")
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((ODD[row.doc_id] or "").encode()).hexdigest()


def best_fit(lengths, capacity):
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [i for i, room in enumerate(rooms) if room >= length]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= length
        else:
            rooms.append(capacity - length)
    return len(rooms)


@pytest.mark.parametrize("seed", range(20))
def test_plan_is_best_fit_and_gapless(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 20, 64])
    lengths = [rng.randint(1, capacity) for _ in range(rng.choice([0, 1, 50, 400]))]
    counts = {n: lengths.count(n) for n in set(lengths)}
    runs = packing.plan_runs(counts, capacity)
    places = []
    for n, first, pieces, sequence, per, base in runs:
        places += [(sequence + k // per, base + k % per * n, n, first + k) for k in range(pieces)]
    for n, count in counts.items():
        assert sorted(p[3] for p in places if p[2] == n) == list(range(count))
    ends = {}
    for sequence, offset, n, _ in sorted(places):
        assert offset == ends.get(sequence, 0)
        ends[sequence] = offset + n
    assert max(ends.values(), default=0) <= capacity
    assert len(ends) == best_fit(lengths, capacity)


def test_documents_are_packed_whole(spark):
    special = packing.special_strings(queries.VOCABULARY)
    (end,) = special
    texts = ODD + ["one two " * 900, "same"] * 3 + [end, f"{end} hi", f"a {end}{end} b\n{end}", f"<|{end}|> {end.upper()}", f"x{end[:-1]} {end}y", "long" * 5_000 + " " + end]
    packed = packing.pack_documents(docs(spark, texts), queries.RANKS, public_tokenizers.PATTERN, 64, keep_ids=True, special=special)
    assert packed.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset"]
    rows = packed.collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for doc, text in enumerate(texts):
        pieces = sorted((r for r in rows if r.doc_id == doc), key=lambda r: r.piece)
        ids = [i for r in pieces for i in r.ids]
        assert ids == tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        assert [r.length for r in pieces[1:]] == [64] * (len(pieces) - 1)
        assert [r.start for r in pieces] == [sum(p.length for p in pieces[:k]) for k in range(len(pieces))]
        assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in pieces)
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert len(ends) == best_fit([r.length for r in rows], 64)


def test_null_keys_and_nothing_at_all(spark):
    frame = spark.createDataFrame([(None, "a"), (None, "a"), (1, None)], "doc_id long, text string")
    packed = packing.pack_documents(frame, queries.RANKS, public_tokenizers.PATTERN)
    assert sorted((r.length, r.sequence_id) for r in packed.collect()) == [(1, 0), (2, 0), (2, 0)]
    assert packing.pack_documents(frame.limit(0), queries.RANKS, public_tokenizers.PATTERN).count() == 0
