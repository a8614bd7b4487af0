"""Periodic runs against every period of every text."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import queries, runs
from tillroll.llm.runs import RunCatcher


def brute(words, least=12):
    """start, length and period of every run: each period, each stretch that agrees with itself one period before."""
    n, out = len(words), {}
    for q in range(1, n // 2 + 1):
        i = q
        while i < n:
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            if j - (i - q) >= max(least, 2 * q) and j > i:
                out.setdefault((i - q, j), q)
            i = max(j, i + 1)
    return sorted(((s, e - s, q) for (s, e), q in out.items()), key=lambda r: (r[0], r[2]))


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def drawn(rng, n, kind):
    if kind == "fibonacci":
        return fibonacci(n)
    if kind == "thue-morse":
        return [bin(i).count("1") % 2 for i in range(n)]
    if kind in (1, 2, 3, 6):
        return [rng.randrange(kind) for _ in range(n)]
    words = []
    while len(words) < n:
        words += [rng.randrange(4) for _ in range(rng.randrange(1, 25))] * rng.randrange(1, 6)
        words = words[: len(words) - rng.randrange(3)]
    return words


KINDS = [1, 2, 3, 6, "periods", "fibonacci", "thue-morse"]


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("slices", ["whole", "words", "mixed"])
def test_runs_of_a_growing_sequence(kind, slices):
    rng = random.Random(f"{kind} {slices}")
    for _ in range(40 if slices == "whole" else 12):
        words, least = drawn(rng, rng.randrange(0, 140), kind), rng.choice([12, 12, 2, 5, 20])
        catcher, at = RunCatcher(least), 0
        while at < len(words):
            step = {"whole": len(words), "words": 1, "mixed": rng.randrange(1, 40)}[slices]
            catcher.append(np.array(words[at : at + step]))
            at += step
            assert [tuple(x) for x in catcher.runs().T.tolist()] == brute(words[:at], least)


def test_every_word_reports_the_squares_that_end_with_it():
    words, least = [9, *[1, 2, 3, 4, 5, 6, 7] * 3, 8, *[1, 2, 3, 4, 5, 6, 7] * 2, *fibonacci(60)], 12
    catcher, last = RunCatcher(least), {}
    for end in range(1, len(words) + 1):
        for period, start, stop in catcher.append(np.array(words[end - 1 : end])).T.tolist():
            assert stop == end and words[end - 2 * period : end - period] == words[end - period : end]
            last[start, period] = stop
        squares = {q for q in range(6, end // 2 + 1) if words[end - 2 * q : end - q] == words[end - q : end]}
        assert squares <= {q for (_, q), stop in last.items() if stop == end}
    assert {(s, e - s, q) for (s, q), e in last.items()} >= set(brute(words))


@pytest.mark.parametrize("kind", KINDS)
def test_misleading_sums_change_nothing(monkeypatch, kind):
    """Sums that tell only four words apart: comparisons go too far and are cut to what agrees."""
    monkeypatch.setattr(runs, "_mixed", lambda words: (words % 2).astype(np.uint64))
    rng = random.Random(7)
    for _ in range(25):
        words = drawn(rng, rng.randrange(0, 120), kind)
        catcher = RunCatcher()
        catcher.append(np.array(words, np.int64))
        found = {tuple(x) for x in catcher.runs().T.tolist()}
        assert found >= set(brute(words))
        assert all(words[s : s + n - q] == words[s + q : s + n] for s, n, q in found)


def test_long_sequences_of_few_words():
    zeros = np.zeros(300_000, np.int64)
    catcher = RunCatcher()
    catcher.append(zeros)
    assert catcher.runs().T.tolist() == [[0, 300_000, 1]]
    zeros[[100_000, 200_000]] = 1
    catcher = RunCatcher()
    for part in np.split(zeros, 10):
        catcher.append(part)
    assert catcher.runs().T.tolist() == [[0, 100_000, 1], [1, 299_999, 100_000], [100_001, 99_999, 1], [200_001, 99_999, 1]]


def planted(key, text):
    words = [w for w in text.encode().split()]
    h, n = zlib.crc32(str(key).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def expected(key, text):
    words = planted(key, text or "")
    found = brute(words)
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    left = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    numbers = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return (key, len(found), *numbers, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left).hexdigest())


def test_query_against_every_period(spark):
    documents = queries.table(spark, "/root/testdata/sf0.001", "documents").where(F.length("text") < 6_000)
    texts = {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
    rng = random.Random(3)
    for k in range(80):
        texts[10**6 + k] = " \t\n\x0b\x0c\r".join(f"w{x}" for x in drawn(rng, rng.randrange(0, 90), KINDS[k % 7]))
    texts |= {-1: None, -2: "", -3: " \n ", -4: "a\x1cb\x85 c\xa0d a\x1cb\x85 c\xa0d", -5: "ü " * 13, -6: "x " * 11}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumns({"runs": F.lit(0), "words": F.lit("clash")})
    found = queries.run_digests(runs.find_runs(queries.repeated(frame))).collect()
    assert {r.doc_id: tuple(r) for r in found} == {k: expected(k, t) for k, t in texts.items()}
    assert len(found) == len(texts) and sum(r.n_runs > 0 for r in found) > 30


def test_null_keys_repeated_rows_and_nothing(spark):
    frame = spark.createDataFrame([(None, "a b " * 9), (None, "a b " * 9), (1, None)], "doc_id long, text string")
    rows = sorted((r.doc_id or 0, len(r.runs), r.collapsed) for r in runs.find_runs(frame).collect())
    assert rows == [(0, 1, "a b"), (0, 1, "a b"), (1, 0, "")]
    assert runs.find_runs(frame.limit(0)).count() == 0
    assert queries.repeated(frame).count() == 3


def test_a_very_long_text(spark):
    text = F.concat(F.lit("start "), F.repeat(F.lit("one two three "), 400_000), F.lit("end"))
    row = runs.find_runs(spark.range(1).select(F.col("id").alias("doc_id"), text.alias("text"))).first()
    assert [tuple(r) for r in row.runs] == [(1, 1_200_000, 3)] and row.collapsed == "start one two three end"
