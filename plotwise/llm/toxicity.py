"""Toxicity: a linear classifier over character n-grams, scaled by naive Bayes log-count ratios.

An n-gram counts once per document. Log-count ratios between toxic and other documents are
counted over hashed n-grams; those whose ratio is surest become features, each with its
ratio as its value, and a regularised logistic regression is fitted on them.

Learning takes at most ``PER_LABEL`` different rows of each label, by a hash of their ids
(``learning.sample_texts``); each counts as often as it repeats. It weighs them so that the labels are as frequent as in all labelled rows; the score is then the
probability of label 1. Scoring covers whole texts. Null and empty texts have no n-gram and
get the model's base rate. Repeated rows are scored alike. Without rows of both labels, the
score is the share of label 1, or 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotwise.llm import learning, ngrams
from plotwise.llm.common import columns, records, ship, slices

ORDERS, BITS = (3, 4, 5), 20
PER_LABEL = 5_000
FEATURES = 4_096
ROUNDS, PENALTY = 200, 3e-3


def present(texts: pa.Array, of: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, number) of each different n-gram; ``of`` maps a bucket to a number, -1 for none."""
    offsets, codes = ngrams.words_of(*ngrams.code_points(texts))
    pairs = []
    for n, bucket in ngrams.hashes(codes, ORDERS, BITS):
        number = bucket.astype(np.int64) if of is None else of[bucket].astype(np.int64)
        owner = ngrams.owners(offsets, n, len(bucket))
        good = owner >= 0 if of is None else (owner >= 0) & (number >= 0)
        pairs.append((owner[good] << BITS) | number[good])
    pairs = np.unique(np.concatenate(pairs))
    return pairs >> BITS, pairs & ((1 << BITS) - 1)


def document_counts(sample: DataFrame) -> np.ndarray:
    """For label 0 and 1, the documents (with their copies) that hold each bucket's n-grams. Each part sends one message of fixed size."""
    layout = pa.schema([("counts", pa.binary())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 << BITS), np.int64)
        for batch in slices(batches):
            row, bucket = present(batch.column("text"))
            label, copies = np.asarray(batch.column("label"))[row], np.asarray(batch.column("copies"))[row]
            for k in (0, 1):
                total[k] += np.bincount(bucket[label == k], copies[label == k], 1 << BITS).astype(np.int64)
        yield records({"counts": [total.tobytes()]}, layout)

    out = np.zeros((2, 1 << BITS), np.int64)
    for part in sample.mapInArrow(count, "counts binary").toLocalIterator():
        out += np.frombuffer(part["counts"], np.int64).reshape(2, -1)
    return out


class Model:
    """Feature of each bucket, weight of each feature, and the constant; fixed in size."""

    def __init__(self, feature: np.ndarray, weight: np.ndarray, constant: float):
        self.feature, self.weight, self.constant = feature, weight, constant

    def scores(self, texts: pa.Array) -> np.ndarray:
        row, number = present(texts, self.feature)
        sums = np.bincount(row, self.weight[number], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(sums + self.constant, -30, 30)))


def log_ratios(counts: np.ndarray, documents: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Naive Bayes log-count ratio of each bucket, and how sure it is (in standard errors)."""
    rate = (counts + 1) / (documents[:, None] + 2)
    ratio = np.log(rate[1] / rate[0])
    return ratio, np.abs(ratio) / np.sqrt((1 / (counts + 1)).sum(axis=0))


def fit(rows: np.ndarray, numbers: np.ndarray, labels: np.ndarray, weights: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression on ratio-scaled presence, by accelerated gradient steps."""
    value = ratio[numbers]
    size = len(ratio)
    weights = weights / weights.sum()
    share = float(np.clip((weights * labels).sum(), 1e-6, 1 - 1e-6))
    w, constant = np.zeros(size), float(np.log(share / (1 - share)))
    look, look0, old, old0 = w.copy(), constant, w, constant
    # Bound of the curvature, by the power method.
    v = np.ones(size) / np.sqrt(size)
    for _ in range(10):
        u = np.bincount(numbers, value * (weights * np.bincount(rows, value * v[numbers], minlength=len(labels)))[rows], minlength=size)
        top = float(np.linalg.norm(u)) or 1.0
        v = u / top
    step = 1 / (0.5 * top + PENALTY + 0.5)
    for k in range(ROUNDS):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(rows, value * look[numbers], minlength=len(labels)) + look0, -30, 30)))
        wrong = weights * (p - labels)
        w, constant = look - step * (np.bincount(numbers, value * wrong[rows], minlength=size) + PENALTY * look), look0 - step * wrong.sum()
        speed = k / (k + 3)
        look, look0 = w + speed * (w - old), constant + speed * (constant - old0)
        old, old0 = w, constant
    return w, float(constant)


def learn(docs: DataFrame, labels: DataFrame, learnable: Column | None = None, label: str = "toxic", id_column: str = "doc_id",
          text_column: str = "text", per_label: int = PER_LABEL, seed: int = 3) -> Model:
    """Fit on labelled documents. ``labels`` has ``doc_id`` and ``label`` (0 or 1); ``learnable`` is a condition on ``doc_id``.

    Of different labels of one id the larger counts.
    """
    ship(docs.sparkSession)
    marked = columns(labels, doc_id="doc_id", label=labels[label].cast("int")).filter("doc_id is not null and label in (0, 1)")
    marked = (marked.filter(learnable) if learnable is not None else marked).groupBy("doc_id").agg(F.max("label").alias("label"))
    frequency = {r["label"]: r["n"] for r in marked.groupBy("label").agg(F.count("*").alias("n")).collect()}
    total = sum(frequency.values())
    none = np.full(1 << BITS, -1, np.int32)
    if len(frequency) < 2:
        share = np.clip(frequency.get(1, 0) / total if total else 0.0, 1e-9, 1 - 1e-9)
        return Model(none, np.zeros(1), float(np.log(share / (1 - share))))
    chosen = learning.pick(marked, "label", per_label, seed)
    sample = learning.sample_texts(columns(docs, doc_id=id_column, text=text_column), chosen, F.coalesce(F.col("text").cast("string"), F.lit("")), "toxicity", "label", per_label, seed)
    sample = sample.withColumn("doc_id", F.col("doc_id").cast("long"))
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.sum("copies").alias("n")).collect()}
    documents = np.array([sizes.get(0, 0), sizes.get(1, 0)])
    if not documents.all():
        return Model(none, np.zeros(1), -20.0 if documents[0] else 20.0)
    ratio, sure = log_ratios(document_counts(sample), documents)
    best = np.sort(np.argsort(-sure, kind="stable")[:FEATURES])
    feature = none
    feature[best] = np.arange(len(best))
    scale = ratio[best]
    shared = sample.sparkSession.sparkContext.broadcast(feature)
    layout = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("copies", pa.int64()), ("hash", pa.int64()), ("numbers", pa.list_(pa.int32()))])

    def numbers_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            row, number = present(batch.column("text"), shared.value)
            ends = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield records({**{c: batch.column(c) for c in ("doc_id", "label", "copies", "hash")}, "numbers": pa.ListArray.from_arrays(ends, number.astype(np.int32))}, layout)

    table = sample.withColumn("hash", F.xxhash64("text")).mapInArrow(numbers_of, "doc_id long, label int, copies long, hash long, numbers array<int>").toArrow()
    table = table.sort_by([("doc_id", "ascending"), ("hash", "ascending")]).combine_chunks()  # sums in the same order each time
    lists = table.column("numbers").combine_chunks()
    y = np.asarray(table.column("label")).astype(np.float64)
    rows = np.repeat(np.arange(len(y), dtype=np.int32), np.diff(np.asarray(lists.offsets)))
    weight = np.where(y == 1, frequency[1] / documents[1], frequency[0] / documents[0]) * np.asarray(table.column("copies"))
    w, constant = fit(rows, np.asarray(lists.flatten()), y, weight, scale)
    return Model(feature, w * scale, constant)


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Probability of label 1 for every whole text."""
    shared = ship(docs.sparkSession).sparkContext.broadcast(model)
    layout = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield records({"doc_id": batch.column("doc_id"), "score": shared.value.scores(batch.column("text"))}, layout)

    return columns(docs, doc_id=docs[id_column].cast("long"), text=docs[text_column].cast("string")).mapInArrow(scored, "doc_id long, score double")
