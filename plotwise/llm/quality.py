"""Quality rules: counts of a text's words and lines, and a hashed n-gram log-likelihood ratio.

Two multinomials over hashed character n-grams are counted: one over all documents, one over
all trusted ones. A document's score is the mean over its n-grams of the log ratio of the
two, so length does not matter; it is kept if the score reaches a threshold that nearly all
trusted documents reach, and if it breaks no base rule. Counts over all documents are summed
per task and bucket, so what moves is the number of buckets and not the number of words.

Null and empty texts have no words and break the first rule. Repeated rows count as often as
they occur. Without trusted documents (or with an empty table) the ratio is 0 and the base
rules decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotwise.llm import ngrams
from plotwise.llm.common import buffers, columns, mixed, records, segment_sums, ship, slices, split_words
from plotwise.operators.quantiles import exact_quantiles
from plotwise.session import staged

ORDERS, BITS = (2, 3), 16
#: Ids of trusted documents that every task may hold; texts meet more by a shuffled join.
MAX_SENT = 2_000_000
#: Part of the trusted documents that may fall below the threshold, and the room below that.
TRUSTED_LOSS, SLACK = 0.002, 0.2

SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeats(owner: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """For each (owner, key), how many equal ones there are."""
    order = np.lexsort((keys, owner))
    o, k = owner[order], keys[order]
    new = np.ones(len(o), bool)
    new[1:] = (o[1:] != o[:-1]) | (k[1:] != k[:-1])
    group = np.cumsum(new) - 1
    out = np.empty(len(o), np.int64)
    out[order] = np.bincount(group)[group] if len(o) else 0
    return out


def repeated_words(bounds: np.ndarray, codes: np.ndarray, size: int = 3) -> np.ndarray:
    """Words of each text that lie in a window of ``size`` words which its text has twice or more."""
    windows = max(0, len(codes) - size + 1)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    key = np.zeros(windows, np.uint64)
    for i in range(size):
        key = mixed(key + codes[i:i + windows].astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    inside = owner[:windows] == owner[size - 1:]
    twice = np.zeros(windows, bool)
    twice[inside] = repeats(owner[:windows][inside], key[inside]) > 1
    marked = np.zeros(len(codes) + 1, np.int64)
    np.add.at(marked, np.flatnonzero(twice), 1)
    np.add.at(marked, np.flatnonzero(twice) + size, -1)
    return segment_sums((np.cumsum(marked[:-1]) > 0).astype(np.int64), bounds).astype(np.int64)


def duplicate_lines(texts: pa.Array) -> np.ndarray:
    """Lines of each text that hold a word and equal an earlier one."""
    parts = pc.split_pattern(texts.fill_null(""), "\n")
    bounds = np.asarray(parts.offsets, np.int64)
    lines = parts.flatten()
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    real = np.asarray(pc.not_equal(pc.binary_length(pc.ascii_trim_whitespace(lines)), 0))
    coded = np.asarray(lines.dictionary_encode().indices)[real].astype(np.int64)
    owner = owner[real]
    if not len(owner):
        return np.zeros(len(texts), np.int64)
    distinct = np.unique(owner * (int(coded.max()) + 1) + coded) // (int(coded.max()) + 1)
    return np.bincount(owner, minlength=len(texts)) - np.bincount(distinct, minlength=len(texts))


def base_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts that the base rules use, for whole texts."""
    texts = texts.fill_null("")
    bounds, words = split_words(texts)
    offsets, raw = buffers(texts)
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS.encode())] = True
    coded = np.asarray(words.dictionary_encode().indices)
    chars = np.concatenate([[0], np.cumsum(np.asarray(pc.utf8_length(words)), dtype=np.int64)])[bounds]
    return {"n_words": np.diff(bounds), "word_chars": np.diff(chars),
            "n_symbols": segment_sums(symbol[raw], offsets).astype(np.int64),
            "n_dup_lines": duplicate_lines(texts), "n_repeat_words": repeated_words(bounds, coded)}


def breaks_rules(counts: dict[str, np.ndarray], least_words: int = 50, most_repeated: int = 50) -> np.ndarray:
    """Too few words, or too many of them in repeated windows (in percent)."""
    return (counts["n_words"] < least_words) | (100 * counts["n_repeat_words"] > most_repeated * counts["n_words"])


def log_ratio(trusted: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Log ratio of the two multinomials with one count added to each bucket."""
    if not trusted.sum():
        return np.zeros(len(raw), np.float32)
    return (np.log((trusted + 1) / (trusted.sum() + len(raw))) - np.log((raw + 1) / (raw.sum() + len(raw)))).astype(np.float32)


def mean_ratio(texts: pa.Array, ratio: np.ndarray) -> np.ndarray:
    """Mean log ratio of each text's n-grams; 0 without any."""
    offsets, codes = ngrams.code_points(texts)
    total, count = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
    for n, bucket in ngrams.hashes(codes, ORDERS, BITS):
        first, end = ngrams.places(offsets, n)
        total += ngrams.within(ratio[bucket], first, end)
        count += end - first
    return total / np.maximum(count, 1)


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """N-grams of all texts by bucket, each text as often as its ``copies`` if there are any: summed per task, then per bucket; the driver gets a row per bucket."""
    layout = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])
    weighted = "copies" in texts.columns

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BITS, np.int64)
        for batch in slices(batches):
            offsets, codes = ngrams.code_points(batch.column("text"))
            if weighted:
                copies = np.asarray(batch.column("copies"))
                for n, bucket in ngrams.hashes(codes, ORDERS, BITS):
                    owner = ngrams.owners(offsets, n, len(bucket))
                    total += np.bincount(bucket[owner >= 0], copies[owner[owner >= 0]], len(total)).astype(np.int64)
                continue
            for n, bucket in ngrams.hashes(codes, ORDERS, BITS):
                _, end = ngrams.places(offsets, n)
                total += np.bincount(bucket, minlength=len(total))
                # Take back what runs into the next text.
                over = np.concatenate([np.arange(e, min(o, len(bucket))) for e, o in zip(end, offsets[1:], strict=True)])
                total -= np.bincount(bucket[over.astype(np.int64)], minlength=len(total))
        some = np.flatnonzero(total)
        yield records({"bucket": some.astype(np.int32), "n": total[some]}, layout)

    rows = texts.mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << BITS, np.int64)
    out[np.asarray(rows.column("bucket"))] = np.asarray(rows.column("n"))
    return out


def quantile(values: np.ndarray, copies: np.ndarray, part: float) -> float:
    """The quantile of values that each repeat, as ``np.quantile`` has it of all of them."""
    order = np.argsort(values, kind="stable")
    ends = np.cumsum(copies[order])
    at = np.stack([ends - copies[order], ends - 1], axis=1).ravel()
    return float(np.interp(part * (ends[-1] - 1), at, np.repeat(values[order], 2)))


class Judge:
    """The log ratio and the threshold; small and fixed in size."""

    def __init__(self, ratio: np.ndarray, threshold: float):
        self.ratio, self.threshold = ratio, threshold


def trusted_texts(docs: DataFrame, trusted_ids: DataFrame, max_sent: int = MAX_SENT) -> DataFrame:
    """Texts of all rows with a trusted id. Texts that were shuffled for it are written down, as they are read twice."""
    ids = staged(trusted_ids.select(F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id")).dropna().distinct(), "trusted")
    texts = docs.select("doc_id", "text").filter("text is not null")
    if ids.count() <= max_sent:
        return texts.join(F.broadcast(ids), "doc_id", "left_semi").select("text")
    return staged(texts.join(ids, "doc_id", "left_semi").select("text"), "trusted")


def learn(docs: DataFrame, trusted_ids: DataFrame, id_column: str = "doc_id", text_column: str = "text", max_sent: int = MAX_SENT) -> Judge:
    """Count both multinomials, and find the threshold on all trusted texts. ``trusted_ids`` has the ids of trusted documents as ``doc_id``."""
    spark = ship(docs.sparkSession)
    docs = columns(docs, doc_id=id_column, text=docs[text_column].cast("string"))
    trusted = trusted_texts(docs, trusted_ids, max_sent)
    ratio = spark.sparkContext.broadcast(log_ratio(bucket_counts(trusted), bucket_counts(docs.select("text"))))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array(mean_ratio(batch.column("text"), ratio.value))], names=["score"])

    # Short texts are left to the base rules.
    scores = staged(trusted.filter(F.length("text") >= 200).mapInArrow(score, "score double"), "scores")
    found = exact_quantiles(scores, "score", {"low": TRUSTED_LOSS}).first()
    return Judge(ratio.value, found["low"] - SLACK if found and found["low"] is not None else -np.inf)


def judge(docs: DataFrame, by: Judge, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Counts, score and verdict of every document."""
    spark = ship(docs.sparkSession)
    model = spark.sparkContext.broadcast(by)
    layout = pa.schema([("doc_id", pa.int64())] + [(c, pa.int64()) for c in COUNTS]
                       + [("base_failed", pa.bool_()), ("score", pa.float64()), ("kept", pa.bool_())])

    def verdict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts = base_counts(batch.column("text"))
            failed = breaks_rules(counts)
            score = mean_ratio(batch.column("text"), model.value.ratio)
            yield records({"doc_id": batch.column("doc_id"), **counts, "base_failed": failed, "score": score,
                           "kept": ~failed & (score >= model.value.threshold)}, layout)

    schema = "doc_id long, " + "".join(f"{c} long, " for c in COUNTS) + "base_failed boolean, score double, kept boolean"
    return columns(docs, doc_id=docs[id_column].cast("long"), text=docs[text_column].cast("string")).mapInArrow(verdict, schema)
