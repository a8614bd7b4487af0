"""Learned operators by held-out accuracy, and how they treat odd rows."""

import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from tillroll.llm import boosting, html_content, labelled, quality, queries, toxicity
from tillroll.llm.dom import FEATURES, read_page
from tillroll.llm.page_samples import labelled_pages

FOLDER = "/root/testdata/sf0.01"


def documents(count=600):
    """Texts of invented words; low quality ones shout or repeat themselves, toxic ones call names."""
    rng = random.Random(1)
    parts = "an ber co de el fi gra ho in ja ker lo mi nu or".split()

    def word():
        return "".join(rng.choices(parts, k=rng.randint(1, 3)))

    rows = []
    for i in range(count):
        good, toxic = int(rng.random() > 0.3), int(rng.random() < 0.3)
        own = [word() for _ in range(rng.randint(20, 120))]
        if toxic:
            for _ in range(3):
                own.insert(rng.randrange(len(own)), rng.choice(["zyxfool", "qwidiot", "vvscum"]) + rng.choice(["", "s", "ly"]))
        text = " ".join(own).capitalize() + "."
        rows.append((i, text if good else text.upper().replace(" ", "!! "), good, toxic))
    return rows


@pytest.fixture(scope="module")
def frames(spark):
    rows = documents()
    docs = spark.createDataFrame([(i, t, "x") for i, t, _, _ in rows], "doc_id long, text string, label string").repartition(3).cache()
    labels = spark.createDataFrame([(i, q, x) for i, _, q, x in rows], "doc_id long, quality int, toxic int")
    return docs, labels, {i: (q, x) for i, _, q, x in rows}


def accuracy(rows, truth):
    held = [r for r in rows if r.held_out]
    assert 0.1 < len(held) / len(rows) < 0.3
    return np.mean([r.predicted == truth[r.doc_id] for r in held])


def test_quality_on_held_out_documents(frames):
    docs, labels, truth = frames
    rows = quality.assess(docs, labels).collect()
    assert accuracy(rows, {i: t[0] for i, t in truth.items()}) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if r.predicted}


def test_toxicity_on_held_out_documents(frames):
    docs, labels, truth = frames
    rows = toxicity.assess(docs, labels).collect()
    assert accuracy(rows, {i: t[1] for i, t in truth.items()}) > 0.97
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if not r.predicted}


@pytest.mark.parametrize("operator", [quality.assess, toxicity.assess])
def test_odd_rows_get_a_score(spark, frames, operator):
    _, labels, _ = frames
    odd = [(None, None), (1, ""), (1, ""), (2, None), (3, " \n"), (4, "x" * 3_000_000), (5, "İ🙂".encode("utf-16", "surrogatepass").decode("utf-16"))]
    docs = spark.createDataFrame(odd, "doc_id long, text string")
    rows = operator(docs, labels).collect()
    assert len(rows) == len(odd) and all(0 <= r.score <= 1 for r in rows)
    empty = {r.score for r in rows if r.doc_id in (1, 2)}
    assert len(empty) == 1
    assert operator(docs.limit(0), labels).count() == 0
    assert {r.score for r in operator(docs, labels.limit(0)).collect()} == {0.5}


def test_training_rows_are_labelled_agreed_and_not_held_out(spark):
    docs = spark.createDataFrame([(i, str(i)) for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)] + [(1, 0), (3, None), (None, 1), (5, 2)], "doc_id long, y int")
    rows = labelled.training_texts(docs, labels, "y", 1000).collect()
    out = {r.doc_id for r in docs.where(labelled.held_out("doc_id")).collect()}
    assert {int(r.text) for r in rows} == set(range(100)) - out - {1}
    assert labelled.training_texts(docs, labels, "y", 7).count() == 7


def test_ngrams_are_the_same_in_any_windows(monkeypatch):
    text = "The İdiot   said\tno " * 50
    whole = np.sort(np.concatenate(list(toxicity.ngram_buckets(text))))
    scratch = np.empty(1 << toxicity.BUCKET_BITS, np.int32)
    monkeypatch.setattr(toxicity, "WINDOW", 17)
    assert (whole == np.sort(np.concatenate(list(toxicity.ngram_buckets(text))))).all()
    assert set(toxicity._distinct(toxicity.ngram_buckets(text), scratch)) == set(whole)


def test_toxicity_scores_by_the_formula():
    rng = np.random.default_rng(1)
    chosen = {g: float(rng.normal()) for g in (" ba", "bad", "ad ", " bad", " bad b", "ood", "good", "xyz")}
    bucket = {}
    for g in chosen:
        codes = np.frombuffer(g.encode("utf-32-le"), np.uint32).astype(np.uint64)
        mixed = sum((int(c) * int(f) for c, f in zip(codes, toxicity._FACTORS)), 0) % 2**64
        last = int(toxicity._FACTORS[len(g) - 1])
        bucket[g] = ((mixed ^ (mixed >> 29)) * last % 2**64) >> (64 - toxicity.BUCKET_BITS)
    order = sorted(chosen, key=bucket.get)
    ratios, weights = np.array([chosen[g] for g in order]), rng.normal(size=len(order))
    model = toxicity.ToxicityModel(np.array([bucket[g] for g in order]), ratios, weights, -0.3)
    for text in ("Bad bad  BAD book", "good", "", "nothing of the kind", "bad xyz " * 9):
        padded = f" {' '.join(text.lower().split())} "
        times = np.array([sum(padded.startswith(g, i) for i in range(len(padded))) for g in order])
        values = ratios * np.log(1 + times)
        length = np.sqrt((values**2).sum())
        margin = -0.3 + (10 * float(values @ weights) / length if length and text else 0)
        assert model.score(text) == pytest.approx(1 / (1 + np.exp(-margin)), rel=1e-9)


def test_trees_learn_and_flat_traversal_follows_them():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    forest = boosting.fit(x[:1500], y[:1500], trees=30)
    assert ((forest.scores(x[1500:]) > 0.5) == y[1500:]).mean() > 0.95
    for row in x[:20]:
        margin = forest.start
        for t in range(len(forest.value)):
            node = 0
            while node < forest.feature.shape[1]:
                node = 2 * node + 1 + int(row[forest.feature[t, node]] > forest.threshold[t, node])
            margin += forest.value[t, node - forest.feature.shape[1]]
        assert margin == pytest.approx(forest.margins(row[None])[0])


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p><article>";</script><style>p{}</style></head><body>
<header><h1>Site of words</h1></header><nav><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></nav>
<div class="cookie-notice"><p>We use cookies. Please agree to that.</p></div><!-- ad --><div class="ad">Buy this thing now.</div>
<article><h1>Fish &amp; chips</h1><p><b>First   paragraph of a &lt;story&gt;,
with <a href="#">a link</a>.<br><p>Second paragraph, longer than the first. It has sentences. Really.
<div class="ad">Another advert in here.</div><p>Third&nbsp;one ends here. Yes.</p></article>
<section id="comments"><h3>Comments</h3><div class="comment"><p>I don't agree with this at all. Really.</p></div></section>
<aside class="sidebar"><h3>Related</h3><ul><li><a href="/x">More</a></li></ul></aside>
<form><p>Sign up for letters.</p><button>Go</button></form><footer>&copy; words &middot; All of it. Here.</footer></body></html>"""
TEXT = "Fish & chips\n\nFirst paragraph of a <story>, with a link.\n\nSecond paragraph, longer than the first. It has sentences. Really.\n\nThird one ends here. Yes."


@pytest.fixture(scope="module")
def model(spark):
    return html_content.train(queries.table(spark, FOLDER, "pages"))


def test_main_text_of_a_page(spark, model):
    odd = [None, "", "plain text only", "<", "<p", "&am", "<article><p>" + "word " * 200_000 + "</article>", "<div>" * 5000 + "deep"]
    pages = spark.createDataFrame([(i, h, "u") for i, h in enumerate([PAGE, PAGE, *odd])], "page_id long, html string, tags string")
    rows = {r.page_id: r.text for r in html_content.extract_main_text(pages, model).collect()}
    assert rows[0] == rows[1] == TEXT and rows[2] == rows[3] == ""
    assert len(rows) == 2 + len(odd)
    assert html_content.extract_main_text(pages.limit(0), model).count() == 0
    with pytest.raises(ValueError, match="text"):
        html_content.extract_main_text(pages.withColumn("Text", F.lit("")), model)


def said(html):
    return [text for _, text, _ in read_page(html).pieces]


@pytest.mark.parametrize(
    "start",
    [
        "<head><title>T</title><meta charset=utf-8><body>",
        "<html><head><title>T</title><script>x</script>",
        "<head><noscript><img src=x></noscript><link rel=y>\n",
        "<head><title>T<body>",
        "<body><select><option>T<option>T",
        "<noscript>T",
        "<!-- <select> -->\n<nav><template>T</nav>",
        "<div>\n<object data=x>T<object>T</object>",
        "<svg><g><text>T</text></g>",
        "<select><option>T<select><option>T</select>",
        "<video>T",
        "<textarea>T",
    ],
)
def test_nothing_is_lost_behind_an_unclosed_element(start):
    assert said(start + "<p>First <b>words</b>.<p>Second <i>words</i>.<svg><title>T</title></svg></html>") == ["First words.", "Second words."]


def test_closed_unseen_elements_hold_their_blocks():
    assert said("<head>Words<p>a</p>") == ["Words", "a"]
    assert said("<p>a</p><head><p>b</p>") == ["a", "b"]
    for tag in ("noscript", "template", "object", "textarea", "iframe", "svg", "select", "canvas"):
        assert said(f"<head><title>T</title></head><body><p>a</p><{tag}><div><p>T</p>T</div>T</{tag}><{tag}/><p>b</p>") == ["a", "b"]
    assert said("<select>\n" * 20_000) == []


def test_layouts_that_were_not_learned(model):
    pages = [read_page(h) for h in labelled_pages(150, seed=991)]
    forest = html_content._forest(pages)
    truth = np.concatenate([html_content._labels(p, False) for p in pages])
    speaks = np.concatenate([np.isin(np.arange(len(p.tags)), [b for b, _, _ in p.pieces]) for p in pages])
    assert ((model.marginals(forest) >= 0.5) == truth)[speaks].mean() > 0.98


def test_marginals_are_those_of_all_labellings():
    page = read_page("<div><p>a</p><ul><li>b</li></ul></div><p>c</p>")
    forest = html_content._forest([page])
    rng = np.random.default_rng(2)
    model = html_content.ContentModel(rng.normal(size=FEATURES), rng.normal(size=(html_content.OTHER + 1, 2, 2)))
    count = len(page.tags)
    weights = []
    for labels in np.ndindex(*[2] * count):
        total = sum(forest.features[i] @ model.own for i in range(count) if labels[i])
        total += sum(model.edge[forest.kind[i], labels[p], labels[i]] for i, p in enumerate(forest.parent) if p >= 0)
        weights.append((np.exp(total), labels))
    whole = sum(w for w, _ in weights)
    wanted = [sum(w for w, labels in weights if labels[i]) / whole for i in range(count)]
    assert model.marginals(forest) == pytest.approx(np.array(wanted))


def test_every_page_of_the_table_gives_its_article(spark, model):
    import html as entities
    import re

    for row in html_content.extract_main_text(queries.table(spark, FOLDER, "pages"), model).collect():
        inside = row.html[row.html.index("<article>") + 9 : row.html.index("</article>")].replace("<b>", "").replace("<br>", " ")
        blocks = [" ".join(entities.unescape(part).split()) for part in re.split(r"</?(?:p|h1)>", inside)]
        assert row.text == "\n\n".join(b for b in blocks if b)
