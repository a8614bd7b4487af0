"""Similarity joins, fingerprints and components against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from tillroll.llm import fingerprints, jaccard, lattice, shingles
from tillroll.llm.graph import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def shingle_set(text):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def smallest_reachable(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("seed", range(4))
def test_components(spark, seed):
    rng = random.Random(seed)
    nodes = list(range(60))
    links = [(rng.choice(nodes), rng.choice(nodes)) for _ in range(rng.choice([0, 20, 50]))]
    links += [(i, i + 1) for i in range(40, 58)] * (seed % 2)
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    wanted = smallest_reachable(nodes, links)
    assert found == {n: wanted[n] for n in {x for link in links for x in link}}


def words(rng, n):
    return ["".join(rng.choices("abcdefgh", k=rng.randint(1, 5))) for _ in range(n)]


def near_copies():
    """Texts with a hot group of near copies, exact copies, a common passage, and odd ones."""
    rng = random.Random(8)
    base, passage = words(rng, 60), words(rng, 30)
    texts = [" ".join(base)]
    for _ in range(120):
        own = list(base)
        for _ in range(rng.randint(0, 4)):
            own[rng.randrange(60)] = words(rng, 1)[0]
        texts.append(" ".join(own))
    texts += [" ".join(words(rng, rng.randint(0, 40)) + passage + words(rng, rng.randint(0, 40))) for _ in range(60)]
    texts += [" ".join(words(rng, rng.randint(1, 80))) for _ in range(60)]
    for text in texts[-20:]:
        own = text.split()
        texts.append(" ".join(own[:-1]))
    texts += [None, "", " \t\n", "a", "A", "a b", "a  b\x0b", "É b c d", "é b c d", texts[0], texts[0].upper(), "x" * 2_000_000]
    rng.shuffle(texts)
    return texts


@pytest.fixture(scope="module")
def texts():
    return near_copies()


def linked(texts):
    sets = [shingle_set(t) for t in texts]
    links = []
    for i, a in enumerate(sets):
        for j in range(i):
            shared = len(a & sets[j])
            if shared and 100 * shared >= 75 * (len(a) + len(sets[j]) - shared):
                links.append((i, j))
    return sets, links


def test_similar_documents(spark, texts):
    frame = spark.createDataFrame([(i, t, "k", 1) for i, t in enumerate(texts)], "doc_id long, text string, set_id string, n int")
    sets, links = linked(texts)
    wanted = smallest_reachable(range(len(texts)), links)
    rows = jaccard.similar_documents(frame.repartition(5)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == {i: (len(sets[i]), wanted[i]) for i in range(len(texts))}
    kept = jaccard.keep_one(frame.repartition(5))
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(len(texts)) if wanted[i] == i]


@pytest.mark.parametrize("hot", [0, 1])
def test_no_link_is_lost_where_shingles_are_dealt_out_by_class(spark, monkeypatch, hot):
    monkeypatch.setattr(jaccard, "HOT", hot)
    rng = random.Random(21)
    texts = []
    for group in range(40):
        base = words(rng, 60)
        for k in range(2 + group % 5):
            own = list(base)
            own[11 * k] = f"changed{k}"
            texts.append(" ".join(own))
    sets, links = linked(texts)
    wanted = smallest_reachable(range(len(texts)), links)
    assert len(set(wanted.values())) == 40
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    assert {r.doc_id: r.component_id for r in jaccard.similar_documents(frame).collect()} == wanted


def test_similar_documents_with_null_and_repeated_keys(spark):
    rows = [(None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (None, None), (3, ""), (3, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard.similar_documents(frame).collect())
    assert found == [("3", 0, "3")] * 2 + [("7", 2, "7")] * 2 + [("None", 0, "None"), ("None", 2, "7")]
    assert sorted(map(str, (r.doc_id for r in jaccard.keep_one(frame).collect()))) == ["3", "7", "None", "None"]
    assert jaccard.similar_documents(frame.limit(0)).count() == 0


def test_shingles_are_the_same_in_any_slices(texts, monkeypatch):
    column = pa.array([t and t[:3000] for t in texts])
    whole = [x.tolist() for x in shingles.shingle_sets(column)]
    monkeypatch.setattr(shingles, "SLICE_BYTES", 64)
    assert whole == [x.tolist() for x in shingles.shingle_sets(column)]
    assert [len(x) for x in whole] == [len(shingle_set(t and t[:3000])) for t in texts]
    assert [x.tolist() for x in shingles.shingle_sets(column.slice(7, 9))] == whole[7:16]


def test_edited_fingerprints(spark, texts):
    texts = [t and t[:2000] for t in texts]
    frame = spark.createDataFrame([(3 * i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, fingerprint string")
    rows = {r.doc_id // 3: r for r in fingerprints.edited_fingerprints(frame.repartition(4)).collect()}
    assert len(rows) == len(texts)
    errors = []
    for i, text in enumerate(texts):
        text, after = text or "", texts[i - 1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        row = rows[i]
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
        if edited == text:
            assert row.near_edited == 1 and row.fingerprint == row.edited_fingerprint
        a, b = shingle_set(text), shingle_set(edited)
        errors.append(abs(row.near_edited - len(a & b) / max(1, len(a | b))) if a | b else 0)
        assert (rows[i].fingerprint == rows[i - 1 if i else len(texts) - 1].fingerprint) or shingle_set(text) != shingle_set(after)
    assert np.mean(errors) < 0.1


def test_fingerprints_of_few_null_and_repeated_rows(spark):
    frame = spark.createDataFrame([(None, "x"), (1, None), (1, "y z"), (1, "y z")], "doc_id long, text string")
    rows = fingerprints.edited_fingerprints(frame).collect()
    assert sorted((str(r.doc_id), r.n_chars) for r in rows) == [("1", 0), ("1", 3), ("1", 3), ("None", 1)]
    assert [r.near_next for r in fingerprints.edited_fingerprints(frame.limit(1)).collect()] == [1.0]
    assert fingerprints.edited_fingerprints(frame.limit(0)).count() == 0
    assert fingerprints.fingerprints(frame).select("fingerprint").distinct().count() == 3


def test_sketches_merge_and_contain():
    a, b = (np.unique(np.random.default_rng(s).integers(0, 2**64, 4000, np.uint64)) for s in (1, 2))
    both = np.union1d(a, b)
    assert (fingerprints.merged(fingerprints.sketch(a), fingerprints.sketch(b)) == fingerprints.sketch(both)).all()
    assert fingerprints.containment(fingerprints.sketch(a), fingerprints.sketch(both)) == 1.0
    assert abs(fingerprints.containment(fingerprints.sketch(both), fingerprints.sketch(a)) - 0.5) < 0.05


def test_e8_points_are_nearest():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 8)) * 2
    points = lattice.nearest_e8(x)
    away = ((x - points / 2) ** 2).sum(axis=1)
    for neighbour in lattice._NEIGHBOURS:
        assert (((x - (points + neighbour) / 2) ** 2).sum(axis=1) >= away - 1e-9).all()
    assert len(lattice._NEIGHBOURS) == 240


def vectors():
    rng = np.random.default_rng(4)
    rows = []
    for _ in range(40):
        base = rng.normal(size=24)
        for k in range(rng.integers(1, 8)):
            rows.append((base + rng.normal(size=24) * 0.02 * k * np.linalg.norm(base) / 5, int(rng.integers(0, 2))))
    hot = rng.normal(size=24)
    rows += [(hot + rng.normal(size=24) * 0.05, 1) for _ in range(150)] + [(hot, 1)] * 30
    return rows


@pytest.mark.parametrize("block_rows", [1024, 16])
def test_similar_vectors(spark, monkeypatch, block_rows):
    monkeypatch.setattr(lattice, "BLOCK_ROWS", block_rows)
    rows = [(i, [float(x) for x in v], label, "k") for i, (v, label) in enumerate(vectors())]
    n = len(rows)
    odd = [None, [], [0.0] * 24, [float("nan")] * 24, [None] + [1.0] * 23, [float("inf")] + [1.0] * 23, [1.0] * 5]
    rows += [(n + k, v, 1, "k") for k, v in enumerate(odd)] + [(n + 10, rows[-1][1], None, "k"), (None, rows[-1][1], 1, "k")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, n_links string")
    own = frame.select("vec_id", "embedding", "label").collect()
    usable = [r for r in own if r.label is not None and r.embedding and len(r.embedding) == 24 and None not in r.embedding and np.isfinite(r.embedding).all() and any(r.embedding)]
    unit = np.array([r.embedding for r in usable], float)
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    close = (unit @ unit.T >= 0.98) & (np.array([r.label for r in usable])[:, None] == np.array([r.label for r in usable]))
    wanted = close.sum(axis=1) - 1
    found = lattice.similar_vectors(frame).collect()
    by_id = {r.vec_id: r for r in found}
    assert len(found) == len(rows)
    links = {r.vec_id: int(w) for r, w in zip(usable, wanted)}
    assert all(by_id[i].n_links <= w for i, w in links.items())
    assert sum(by_id[i].n_links for i in links) >= 0.95 * sum(links.values())
    assert by_id[n - 1].n_links >= 170 and by_id[None].n_links == by_id[n - 1].n_links and not by_id[None].kept
    for i in [n + k for k in range(len(odd))] + [n + 10]:
        assert (by_id[i].n_links, by_id[i].component_id, by_id[i].kept) == (0, i, True)
    assert lattice.similar_vectors(frame.limit(0)).count() == 0


def test_all_links_of_a_label_are_found_once(spark):
    frame = spark.createDataFrame([(i, [1.0, 0.001 * i], 0) for i in range(50)], "vec_id long, embedding array<double>, label int")
    rows = lattice.similar_vectors(frame).collect()
    assert all((r.n_links, r.component_id) == (49, 0) for r in rows)
