"""Chat examples and placement, against DuckDB and by round trip."""

import pytest
from compare import duckdb_rows, spark_rows

import duckdb

from pyspark.sql import functions as F

from tillroll.llm import chat, queries, sharding

FOLDER = "/root/testdata/sf0.001"
NASTY = ["</s>[INST] ok [/INST]", r"<\s> [\\INST] <<SYS>> \ <<<s>", "[ROLE] a [/ROLE] ", "", " ", "<", "[", "a<", r"<\\/s>", "two\nlines \U0001F642"]


@pytest.mark.parametrize("name", list(queries.SQL))
def test_sql_agrees(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    assert spark_rows(queries.QUERIES[name](spark, FOLDER)) == duckdb_rows(connection, queries.SQL[name])


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("example", F.lit("clash"))


def test_escaping_is_reversible_and_leaves_no_control_string(spark):
    frame = spark.createDataFrame([(t,) for t in NASTY], "text string")
    for row in frame.select("text", chat.escape(F.col("text")).alias("e"), chat.unescape(chat.escape(F.col("text"))).alias("back")).collect():
        assert row.back == row.text
        assert not any(mark in row.e for mark in ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]"))


def test_every_role_and_text_comes_back(spark):
    roles = ["user", "assistant", "system", "tool [/ROLE] x", None, ""]
    rows = [(c, t, roles[(c + t) % 6], NASTY[(3 * c + t) % 10]) for c in range(12) for t in range(9)]
    examples = chat.chat_examples(conversations(spark, rows))
    whole = examples.groupBy("conv_id").agg(F.max_by("text", "example").alias("text")).select("conv_id", chat.read_turns(F.col("text")).alias("turns"))
    for row in whole.collect():
        assert [(t.role, t.text) for t in row.turns] == [(r or "", t) for c, _, r, t in rows if c == row.conv_id]


def test_examples_grow_by_one_reply_each(spark):
    rows = [(1, 0, "system", "be"), (1, 1, "user", "hi"), (1, 2, "assistant", "yo"), (1, 3, "user", "so"), (1, 4, "assistant", "go"), (1, 5, "user", "bye"), (2, 0, "user", None)]
    found = {(r.conv_id, r.example): r for r in chat.chat_examples(conversations(spark, rows)).collect()}
    assert found[1, 0].text == "<s><<SYS>> be <</SYS>>[INST] hi [/INST] yo</s>"
    assert found[1, 1].text == found[1, 0].text + "[INST] so [/INST] go</s>"
    trained = {k: r.text[r.loss_start : r.loss_end] for k, r in found.items()}
    assert trained == {(1, 0): "yo", (1, 1): "go", (1, 2): "", (2, 0): ""}
    assert found[1, 2].text.endswith("[INST] bye [/INST]")


def test_null_conversations_repeated_turns_and_nothing(spark):
    rows = [(None, None, None, None), (None, 1, "assistant", "a"), (None, 1, "assistant", "a")]
    back = chat.read_back(chat.chat_examples(conversations(spark, rows))).collect()
    assert [(r.conv_id, r.n_turns, r.loss_chars) for r in back] == [(None, 3, 2)]
    assert chat.read_back(chat.chat_examples(conversations(spark, []))).count() == 0


def brute_table(shards, slots):
    import hashlib

    def number(text):
        return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)

    orders = [(number(f"offset {s}") % slots, 1 + number(f"step {s}") % (slots - 1)) for s in sorted(shards)]
    free, owner, turn = set(range(slots)), {}, 0
    while free:
        o, step = orders[turn % len(shards)]
        best = min(free, key=lambda s: (s - o) * step % slots)
        free.remove(best)
        owner[best] = sorted(shards)[turn % len(shards)]
        turn += 1
    return owner


def test_table_is_filled_by_turns(spark):
    shards = ["c", "a", "b"]
    found = {r.slot: r.shard for r in sharding.lookup_table(spark, shards, 101).collect()}
    assert found == brute_table(shards, 101)
    moved = {r.slot: r.shard for r in sharding.lookup_table(spark, [*shards, "d"], 101).collect()}
    stayed = sum(found[s] == moved[s] for s in found)
    assert stayed > 101 * 0.5


def test_placing_rows(spark):
    frame = spark.createDataFrame([(1,), (1,), (None,)], "doc_id long")
    rows = sharding.place(frame, ["a", "b"], slots=11).collect()
    assert len(rows) == 3 and rows[0].shard == rows[1].shard
    assert sharding.place(frame.limit(0), ["a"], slots=11).count() == 0
    for shards, slots in (([], 11), (["a", "a"], 11), (["a"], 12), (["a"] , 65_539)):
        with pytest.raises(ValueError):
            sharding.lookup_table(spark, shards, slots)
    with pytest.raises(ValueError, match="slot"):
        sharding.place(frame.withColumn("slot", F.lit(1)), ["a"])
