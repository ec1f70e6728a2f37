"""Helpers shared by the operators: input columns, batches of text, code on the executors."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

import plotwise
from plotwise.session import staged

#: Bytes of text that one vectorised step works on, so that a task's memory stays flat.
SLICE_BYTES = 4 << 20
SLICE_ROWS = 8192

#: White space of the word rules: blank and the code points 9 to 13.
SPACES = "\t\n\x0b\x0c\r "


@functools.cache
def _package() -> str:
    """A zip of this package, in the driver's own temporary folder."""
    top = os.path.dirname(os.path.abspath(plotwise.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="plotwise-code-"), "plotwise_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("plotwise", os.path.relpath(full, top)))
    return path


def ship(spark: SparkSession) -> SparkSession:
    """Give the executors this package, wherever the driver was started."""
    context = spark.sparkContext
    if getattr(context, "_plotwise_code", None) is None:
        context.addPyFile(_package())
        context._plotwise_code = True
    return spark


def columns(df: DataFrame, **wanted: str | Column) -> DataFrame:
    """Only the wanted columns under the operator's own names, so that other columns cannot clash."""
    return df.select(*[(df[c] if isinstance(c, str) else c).alias(name) for name, c in wanted.items()])


def slices(batches: Iterator[pa.RecordBatch], column: str | int = "text", limit: int = SLICE_BYTES,
           rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Rows of the batches in runs of about ``limit`` bytes of text; a longer text is a run of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.cumsum(lengths(batch.column(column)))
        first = 0
        while first < batch.num_rows:
            done = sizes[first - 1] if first else 0
            last = min(first + rows, max(first + 1, int(np.searchsorted(sizes, done + limit, side="right"))))
            yield batch.slice(first, last - first)
            first = last
    # The worker stays for other tasks; what this one no longer needs is given back.
    pa.default_memory_pool().release_unused()


def lengths(texts: pa.Array) -> np.ndarray:
    """Bytes of each text, null as 0."""
    return np.diff(buffers(texts)[0])


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from 0 and the bytes of all texts in a row; null texts are empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1]
    at = at.astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    return at - at[0], raw


def segment_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over consecutive runs, empty runs as 0."""
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def remainder(doc_id: Column, parts: int = 4) -> Column:
    """crc32 of an id's text, modulo ``parts``: the split into learning and held-out rows; null ids as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """Rows with ``number``, from 0 in ascending order: counts of range partitions, not one task, give the start of each."""
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("spot", F.monotonically_increasing_id())
    ranged = staged(ranged.withColumn("part", F.shiftright("spot", 33)), "numbered")
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = ranged.groupBy("part").agg(F.count("*").alias("rows"), F.min("spot").alias("first"))  # a row per partition
    starts = parts.select("part", (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return ranged.join(F.broadcast(starts), "part").select(*rows.columns, (F.col("spot") + F.col("shift")).alias("number"))


def records(rows: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(rows[f.name], f.type) for f in schema], schema=schema)


def mixed(keys: np.ndarray) -> np.ndarray:
    """64-bit mixing, so that sums of mixed keys hardly ever meet."""
    keys = (keys ^ (keys >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    keys = (keys ^ (keys >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return keys ^ (keys >> np.uint64(31))


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Offsets of each text's words, and the words of all texts."""
    parts = pc.ascii_split_whitespace(texts.fill_null(""))
    words = parts.flatten()
    real = np.asarray(pc.not_equal(pc.binary_length(words), 0))
    bounds = np.asarray(parts.offsets, np.int64)
    bounds = np.concatenate([[0], np.cumsum(real)])[bounds - bounds[0]]
    return bounds, words if real.all() else words.filter(pa.array(real))
