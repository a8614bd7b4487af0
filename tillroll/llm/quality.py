"""Quality of documents: boosted trees over statistics of the whole text."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tillroll.llm.boosting import Forest, fit
from tillroll.llm.labelled import held_out, training_texts
from tillroll.llm.shingles import sliced

#: Labelled documents to learn from, at most.
TRAINING_ROWS = 20_000
THRESHOLD = 0.3

# Kinds of bytes: 0 others (parts of non-ASCII letters), 1 lower, 2 upper, 3 digit, 4 space, 5 line feed,
# 6 full stops and commas, 7 quotes and brackets, 8 other signs.
_KIND = np.zeros(256, np.uint8)
_KIND[97:123], _KIND[65:91], _KIND[48:58] = 1, 2, 3
_KIND[[32, 9, 13]], _KIND[10] = 4, 5
_KIND[[ord(c) for c in ".,;:?!-"]] = 6
_KIND[[ord(c) for c in "\"'()"]] = 7
_KIND[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = 8
_KINDS = 9

FEATURES = 24


def statistics(text: str) -> list[float]:
    """FEATURES numbers that describe a text; all 0 for an empty one."""
    if not text:
        return [0.0] * FEATURES
    raw = np.frombuffer(text.encode(), np.uint8)
    kinds = np.bincount(_KIND[raw], minlength=_KINDS) / len(raw)
    words = text.split()
    many = max(1, len(words))
    distinct = set(words)
    lines = [line for line in text.split("\n") if line.strip()]
    rows = max(1, len(lines))
    long_lines = [line for line in lines if len(line) > 20]
    repeats = sum(map(str.__eq__, words, words[1:])) / many
    pairs = set(zip(words, words[1:], strict=False))
    ends = [w[-1] for w in words]
    odd_ends = sum(c in "#$%&*|!+=~" for c in ends) / many
    stops = sum(c in ".?!" for c in ends) / many
    upper = sum(map(str.isupper, words)) / many
    title = sum(map(str.istitle, words)) / many
    short = sum(len(w) <= 3 for w in words) / many
    largest = max(map(len, words), default=0)
    return [
        np.log1p(len(text)),
        np.log1p(len(words)),
        len(text) / many,
        largest,
        len(distinct) / many,
        (len(pairs) + 1) / many,
        repeats,
        odd_ends,
        stops,
        upper,
        title,
        short,
        np.log1p(rows),
        len(text) / rows,
        1 - len(set(lines)) / rows,
        1 - len(set(long_lines)) / max(1, len(long_lines)),
        *kinds[1:],
    ]


def _rows_of(column: pa.Array) -> np.ndarray:
    return np.array([statistics(t or "") for t in column.to_pylist()], float).reshape(len(column), FEATURES)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAINING_ROWS, key: str = "doc_id", text: str = "text") -> Forest:
    """Trees learned from at most `rows` labelled documents that aren't held out.

    Statistics are computed where the texts are; rows * FEATURES numbers and the
    labels come to the driver. Without labels the forest is empty.
    """

    def describe(batches):
        for batch in sliced(batches, "text"):
            found = _rows_of(batch.column("text"))
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.list_(pa.float64())), batch.column("label")], names=["x", "label"])

    texts = training_texts(docs, labels, label, rows, key, text)
    sample = texts.mapInArrow(describe, "x array<double>, label int").toArrow()
    if not sample.num_rows:
        return fit(np.zeros((0, FEATURES)), np.zeros(0))
    x = np.array(sample["x"].to_pylist())
    y = sample["label"].to_numpy().astype(float)
    # The order in which rows arrive must not matter.
    order = np.lexsort((*x.T, y))
    return fit(x[order], y[order])


def score(frame: DataFrame, forest: Forest, text: str = "text", name: str = "score") -> DataFrame:
    """All columns and the probability, from 0 to 1, of label 1 for the whole text; null and empty texts alike.

    Rows are scored one by one; an empty table gives an empty one. A column of
    that name is refused.
    """
    if name.lower() in {c.lower() for c in frame.columns}:
        raise ValueError(f"The frame already has a column {name}.")
    schema = T.StructType([*frame.schema.fields, T.StructField(name, T.DoubleType(), False)])

    def add(batches):
        for batch in sliced(batches, text):
            found = forest.scores(_rows_of(batch.column(text)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], names=schema.names)

    return frame.mapInArrow(add, schema)


def assess(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per document: key, held_out, score, predicted (1 if score >= threshold)."""
    scored = score(docs.select(key, text), train(docs, labels, key=key, text=text), text)
    return scored.select(key, held_out(key).alias("held_out"), "score", (scored["score"] >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score reaches the threshold, with the columns they came with."""
    scored = score(docs, train(docs, labels, key=key, text=text), text, "_quality_score")
    return scored.where(scored["_quality_score"] >= threshold).select(*docs.columns)
