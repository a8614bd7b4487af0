"""What stands in elements that aren't shown, pages that close nothing, and texts in bytes rather than rows."""

import time

import pytest

from tillroll.llm import chunks, packing, queries, storage
from tillroll.llm.dom import read_page


def pieces(html):
    return [text for _, text, _ in read_page(html).pieces]


@pytest.mark.parametrize(
    "html, texts",
    [
        ("<p>one <svg><g><text>LEAK</text></g></svg> two</p>", ["one two"]),
        ("<p>a <noscript><div>js off</div></noscript> b</p>", ["a b"]),
        ("<p>a <template><p>x</p><ul><li>y</li></ul></template> b</p>", ["a b"]),
        ("<p>a <object><p>x</p><object><div>y</div></object></object> b</p>", ["a b"]),
        ("<p>a <math><mi>x</mi><mtext>y<br>z</mtext></math> b</p>", ["a b"]),
        ("<li>one <svg><path/></svg> two</li>", ["one two"]),
        ("<div>one <svg><path d='x'></path></svg> two <b>three</b></div>", ["one two three"]),
        ("<p>one <svg viewBox='0'/> two</p>three", ["one two", "three"]),
        ("<p>a <svg><a href='#'>x</a></svg> b <a>c</a></p>", ["a b c"]),
        ("<p>a <svg></p></svg> b</p>", ["a b"]),
        ("<p>a <select><option>1<option>2</select> b</p><p>c", ["a b", "c"]),
        ("<p>a <svg><g>x<p>b</p>", ["a", "b"]),
        ("<div>a <svg>x</div>b", ["a", "b"]),
        ("<head><title>t</title><p>a</p>", ["a"]),
        ("<p>a<script>if (a < b) x()</script>b</p>", ["ab"]),
    ],
)
def test_unseen_elements_only_nest(html, texts):
    assert pieces(html) == texts


@pytest.mark.parametrize("broken", ["<b></i>", "<div></p>", "<span><p></li>", "<svg><g></x>", "<p><button><b>", "<table></td>"])
def test_unclosed_elements_take_linear_time(broken):
    started = time.monotonic()
    page = read_page(broken * 100_000 + "<p>end</p>")
    assert time.monotonic() - started < 30
    assert page.pieces[-1][1] == "end"


def test_remembered_parts_are_short():
    parts = packing._Parts(queries.RANKS, queries.public_tokenizers.PATTERN, ())
    long = "x" * (packing.LONGEST_REMEMBERED + 1)
    assert parts.ids_of(f"a b {long} {long}") and set(parts) == {"b"}
    encoder = chunks.RememberedEncoder(lambda found: [x.encode() for x in found])
    assert encoder.encode_all([f"a b {long}c {long}c"]) == [f"a b {long}c {long}c".encode()]
    assert set(encoder._new) == {"a", "b"}


def test_special_strings():
    assert packing.special_strings(queries.VOCABULARY) == {"<|endoftext|>": 50256}


def test_without_a_checkpoint_folder_the_warehouse_is_used(spark, monkeypatch):
    class Conf:
        def get(self, name, *default):
            return default[0] if name == "spark.checkpoint.dir" else spark.conf.get(name, *default)

    class Session:
        conf, sparkContext = Conf(), type("Context", (), {"getCheckpointDir": lambda self: None})()

    folder = storage.checkpoint_folder(Session())
    assert folder.startswith(spark.conf.get("spark.sql.warehouse.dir")) and storage.checkpoint_folder(spark) != folder


def test_long_texts_in_one_partition(spark):
    """Sixty megabytes in one task, by rows too few to be parted."""
    from pyspark.sql import functions as F

    text = F.concat(F.repeat(F.concat(F.lit("word"), "id", F.lit(" other words\n")), 125_000))
    frame = spark.range(24, numPartitions=1).select(F.col("id").alias("doc_id"), text.alias("text"))
    rows = packing.token_pieces(frame, queries.RANKS, queries.public_tokenizers.PATTERN, 2048).groupBy("doc_id").agg(F.sum("length").alias("n"))
    assert rows.where("n > 500000").count() == 24
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000"
