"""The pipeline's stages, each against what its operator says of its own input."""

import corpus_pipeline
from test_similarity import linked, smallest_reachable

import __spark_entry__ as entry
from tillroll.llm import quality, queries, toxicity

FOLDER = "/root/testdata/sf0.001"


def test_registered():
    names = {name.split("_")[0] for name in entry.queries() if name.startswith("op")}
    assert names == {f"op{n}" for n in range(1, 14)} and "pipeline" in entry.queries()


def test_stages_take_effect(spark):
    docs = queries.table(spark, FOLDER, "documents").cache()
    labels = queries.table(spark, FOLDER, "labels")
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality classifier"](spark, docs, FOLDER).cache()
    assert good.columns == docs.columns
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in quality.assess(docs, labels).collect() if r.predicted}
    clean = stages["toxicity"](spark, good, FOLDER).cache()
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in toxicity.assess(good, labels).collect() if not r.predicted}
    single = stages["n-gram Jaccard join"](spark, clean, FOLDER).cache()
    rows = sorted((r.doc_id, r.text) for r in clean.collect())
    _, links = linked([text for _, text in rows])
    component = smallest_reachable(range(len(rows)), links)
    assert sorted(r.doc_id for r in single.collect()) == [rows[i][0] for i in range(len(rows)) if component[i] == i]
    packed = stages["best-fit packing"](spark, single, FOLDER)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in single.collect()}


def test_run_is_the_stages_one_after_the_other(spark):
    packed = corpus_pipeline.run(spark, FOLDER)
    assert packed.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert packed.count() > 50
