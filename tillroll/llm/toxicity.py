"""Toxicity of documents: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text's features are its n-grams, hashed into buckets. The value of a feature is
log(1 + how often the text holds it) times r, the log ratio of the feature's
smoothed rates among toxic and other training texts. A text's values are scaled
to the length LENGTH, so that a long text is no surer than a short one; a
logistic regression over them gives the weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from tillroll.llm.labelled import held_out, training_texts
from tillroll.llm.shingles import sliced
from tillroll.llm.storage import saved

#: Labelled documents to learn from, at most, and the tasks they are dealt to.
TRAINING_ROWS = 10_000
TRAINING_TASKS = 12
THRESHOLD = 0.5
ORDERS = (3, 4, 5, 6)
BUCKET_BITS = 20
#: A feature takes part if so many training texts hold it and its log-count ratio is so far from 0.
LEAST_TEXTS = 5
LEAST_RATIO = 1.5
#: Length of a text's vector of values.
LENGTH = 10.0
#: Characters hashed at once, so that long texts need little memory.
WINDOW = 1 << 18

_FACTORS = np.random.Generator(np.random.PCG64(7)).integers(1, 2**63, max(ORDERS), np.uint64) | np.uint64(1)


def ngram_buckets(text: str) -> Iterator[np.ndarray]:
    """Buckets of all n-grams of the lower-cased text between two spaces, white space being one space; with repeats.

    Each array is of the n-grams that begin in one window of the text.
    """
    whole = np.frombuffer(f" {' '.join(text.lower().split())} ".encode("utf-32-le", "replace"), np.uint32)
    for start in range(0, len(whole), WINDOW):
        codes = whole[start : start + WINDOW + max(ORDERS) - 1].astype(np.uint64)
        rolled, found = np.zeros(len(codes), np.uint64), [np.empty(0, np.uint64)]
        for n in range(1, max(ORDERS) + 1):
            if len(codes) < n:
                break
            rolled = rolled[: len(codes) - n + 1] + codes[n - 1 :] * _FACTORS[n - 1]
            if n in ORDERS:
                mixed = ((rolled ^ (rolled >> np.uint64(29))) * _FACTORS[n - 1]) >> np.uint64(64 - BUCKET_BITS)
                # What begins behind the window is left to the next one.
                found.append(mixed[:WINDOW])
        yield np.concatenate(found).astype(np.int64)


def _distinct(buckets: Iterator[np.ndarray], scratch: np.ndarray) -> np.ndarray:
    """Each bucket once; scratch has a place for every bucket, and what it holds doesn't matter."""
    kept = None
    for window in buckets:
        at = np.arange(len(window), dtype=scratch.dtype)
        scratch[window] = at
        own = window[scratch[window] == at]
        kept = own if kept is None else np.union1d(kept, own)
    return kept


def _values(buckets: Iterator[np.ndarray], number: np.ndarray, ratios: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of a text and their values; number has a feature for each bucket, or -1."""
    held = [number[window] for window in buckets]
    found, times = np.unique(np.concatenate([x[x >= 0] for x in held]), return_counts=True)
    values = ratios[found] * np.log1p(times)
    return found, values * (LENGTH / max(np.sqrt((values**2).sum()), 1e-300))


@dataclass(frozen=True)
class ToxicityModel:
    """Buckets that take part, with the ratio and the weight of each; empty if nothing could be learned."""

    buckets: np.ndarray
    ratios: np.ndarray
    weights: np.ndarray
    start: float

    def numbers(self) -> np.ndarray:
        """For every bucket which feature it is, or -1."""
        number = np.full(1 << BUCKET_BITS, -1, np.int32)
        number[self.buckets] = np.arange(len(self.buckets))
        return number

    def score(self, text: str, number: np.ndarray | None = None) -> float:
        """Probability that the text is toxic; number: what numbers() gives, for many texts."""
        margin = self.start
        if text and len(self.weights):
            found, values = _values(ngram_buckets(text), self.numbers() if number is None else number, self.ratios)
            margin += float(values @ self.weights[found])
        return float(1.0 / (1.0 + np.exp(-np.clip(margin, -500, 500))))


def fit_logistic(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, labels: np.ndarray, features: int, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """Weights and intercept of a ridge-penalised logistic regression, by Newton steps with conjugate gradients."""
    count = len(labels)
    weights = np.zeros(features + 1)

    def times(w: np.ndarray) -> np.ndarray:
        return np.bincount(rows, values * w[columns], count) + w[-1]

    def back(x: np.ndarray) -> np.ndarray:
        return np.append(np.bincount(columns, values * x[rows], features), x.sum())

    penalty = np.append(np.full(features, ridge), 1e-6)
    for _ in range(12):
        chance = 1 / (1 + np.exp(-np.clip(times(weights), -30, 30)))
        slope = back(labels - chance) - penalty * weights
        if np.abs(slope).max() < 1e-4:
            break
        curve = chance * (1 - chance)
        step, rest = np.zeros_like(weights), slope.copy()
        direction, size = rest.copy(), rest @ rest
        for _ in range(25):
            bent = back(curve * times(direction)) + penalty * direction
            share = size / (direction @ bent)
            step += share * direction
            rest -= share * bent
            new = rest @ rest
            if new < 1e-8 * (slope @ slope):
                break
            direction, size = rest + new / size * direction, new
        weights += step
    return weights[:-1], float(weights[-1])


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = TRAINING_ROWS, key: str = "doc_id", text: str = "text") -> ToxicityModel:
    """The model learned from at most `rows` labelled documents that aren't held out.

    Buckets are counted where the texts are. The driver gets the buckets that
    take part, 2**BUCKET_BITS at most, and for each training text those it holds.
    Without texts of both labels the score is the smoothed share of label 1.
    """
    sample = saved(training_texts(docs, labels, label, rows, key, text).repartition(TRAINING_TASKS))
    of_label = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    others, toxic = of_label.get(0, 0), of_label.get(1, 0)
    share = (toxic + 0.5) / (others + toxic + 1.0)
    start = float(np.log(share / (1 - share)))
    if not others or not toxic:
        return ToxicityModel(np.zeros(0, np.int64), np.zeros(0), np.zeros(0), start)

    def count(batches):
        seen = np.zeros((2, 1 << BUCKET_BITS), np.int32)
        scratch = np.empty(1 << BUCKET_BITS, np.int32)
        for batch in sliced(batches, "text"):
            for value, kind in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                seen[kind, _distinct(ngram_buckets(value or ""), scratch)] += 1
        at = np.flatnonzero(seen.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[0, at]), pa.array(seen[1, at])], names=["bucket", "others", "toxic"])

    counted = sample.mapInArrow(count, "bucket long, others int, toxic int").groupBy("bucket").agg(
        F.sum("others").alias("others"), F.sum("toxic").alias("toxic")
    )
    ratio = F.log((F.col("toxic") + 1.0) / (toxic + 2.0)) - F.log((F.col("others") + 1.0) / (others + 2.0))
    picked = (
        counted.where(F.col("others") + F.col("toxic") >= LEAST_TEXTS)
        .select("bucket", ratio.alias("ratio"))
        .where(F.abs("ratio") >= LEAST_RATIO)
        .orderBy("bucket")
        .toArrow()
    )
    buckets, ratios = picked["bucket"].to_numpy(), picked["ratio"].to_numpy()
    unfitted = ToxicityModel(buckets, ratios, np.zeros(len(buckets)), start)

    def held(batches):
        number = unfitted.numbers()
        for batch in sliced(batches, "text"):
            own = [_values(ngram_buckets(value or ""), number, ratios) for value in batch.column("text").to_pylist()]
            columns = [pa.array([x[0] for x in own], pa.list_(pa.int32())), pa.array([x[1] for x in own], pa.list_(pa.float64())), batch.column("label")]
            yield pa.RecordBatch.from_arrays(columns, names=["features", "values", "label"])

    texts = sample.mapInArrow(held, "features array<int>, values array<double>, label int").toArrow()
    features, values = texts["features"].to_pylist(), texts["values"].to_pylist()
    y = texts["label"].to_numpy().astype(float)
    # The order in which rows arrive must not matter.
    order = sorted(range(len(y)), key=lambda i: (y[i], features[i], values[i]))
    columns = np.array([c for i in order for c in features[i]], np.int64)
    own_row = np.repeat(np.arange(len(y)), [len(features[i]) for i in order])
    weights, intercept = fit_logistic(own_row, columns, np.array([v for i in order for v in values[i]]), y[order], len(buckets))
    return ToxicityModel(buckets, ratios, weights, intercept)


def score(frame: DataFrame, model: ToxicityModel, text: str = "text", name: str = "score") -> DataFrame:
    """All columns and the probability, from 0 to 1, that the whole text is toxic; null and empty texts alike.

    Rows are scored one by one; an empty table gives an empty one. A column of
    that name is refused.
    """
    if name.lower() in {c.lower() for c in frame.columns}:
        raise ValueError(f"The frame already has a column {name}.")
    schema = T.StructType([*frame.schema.fields, T.StructField(name, T.DoubleType(), False)])

    def add(batches):
        number = model.numbers()
        for batch in sliced(batches, text):
            found = [model.score(value or "", number) for value in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], names=schema.names)

    return frame.mapInArrow(add, schema)


def assess(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per document: key, held_out, score, predicted (1 if score >= threshold)."""
    scored = score(docs.select(key, text), train(docs, labels, key=key, text=text), text)
    return scored.select(key, held_out(key).alias("held_out"), "score", (scored["score"] >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score is below the threshold, with the columns they came with."""
    scored = score(docs, train(docs, labels, key=key, text=text), text, "_toxicity_score")
    return scored.where(scored["_toxicity_score"] < threshold).select(*docs.columns)
