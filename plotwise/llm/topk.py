"""Exact top-k by inner product, with elimination by a table of distances to pivots.

Each vector's distances to many pivots are computed once and written down. For a query q
and a candidate x, every pivot p gives |d(q,p) - d(x,p)| <= d(q,x); the largest of these
bounds the inner product from above, as q.x = (|q|^2 + |x|^2 - d(q,x)^2) / 2. Candidates
are evaluated in the order of that bound until the next bound is below the k-th best
score, so no answer is lost, ties included. Scores are exact integers.

Queries and candidates are dealt at random into blocks; a task holds one block of each.
Each pair of blocks gives k rows per query, of which the best k are kept.

Vectors that are null or hold a null or non-finite component take no part, and neither do
rows without an id. Shorter vectors count as if zeros followed. A row is never its own
candidate, but a repeated row with the same id is. An empty table gives an empty result.
Components so large that a score could leave 64 bits are an error, never a wrapped score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plotwise.llm.common import columns, records, ship
from plotwise.session import staged

PIVOTS = 64
#: Rows among which the driver looks for pivots.
PIVOT_SAMPLE = 1024
CANDIDATE_ROWS, QUERY_ROWS = 8192, 1024
FIRST_LOOK = 256

FOUND = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("row_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def whole(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of each component, null where the vector takes no part."""
    x = vector.cast("array<double>")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.when(fine, F.transform(x, lambda v: F.floor(v * scale).cast("long")))


def matrix(lists: pa.Array, width: int | None = None) -> np.ndarray:
    """Vectors as rows of a matrix, zeros behind shorter ones."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    bounds = np.asarray(lists.offsets, np.int64)
    sizes = np.diff(bounds)
    width = max(width or 0, int(sizes.max(initial=0)))
    flat = np.asarray(lists.flatten())
    if len(flat) == width * len(sizes):
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), flat.dtype)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def widen(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (a, b))


def distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    a, b = (m.astype(np.float64) for m in widen(vectors, pivots))
    square = (a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * a @ b.T
    return np.sqrt(np.maximum(square, 0))


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Vectors far from one another: each is the farthest from those before."""
    if not len(sample):
        return sample
    chosen = [0]
    nearest = distances(sample, sample[:1])[:, 0]
    while len(chosen) < min(count, len(sample)):
        far = int(nearest.argmax())
        if nearest[far] == 0:
            break
        chosen.append(far)
        nearest = np.minimum(nearest, distances(sample, sample[far:far + 1])[:, 0])
    return sample[chosen]


def pivot_table(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", pivots: int = PIVOTS) -> DataFrame:
    """Whole-number vectors with their distances to the pivots, written to the shared folder."""
    spark = ship(vectors.sparkSession)
    rows = columns(vectors, vec_id=vectors[id_column].cast("long"), vector=whole(vectors[vector_column]),
                   row_id=F.monotonically_increasing_id()).filter("vec_id is not null and vector is not null")
    sample = rows.select("vector", F.xxhash64("vec_id", "vector").alias("order")).orderBy("order").limit(PIVOT_SAMPLE).toArrow()
    table = choose_pivots(matrix(sample.column("vector")), pivots)
    layout = pa.schema([("vec_id", pa.int64()), ("row_id", pa.int64()), ("vector", pa.list_(pa.int64())), ("far", pa.list_(pa.float64()))])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = distances(matrix(batch.column("vector")), table)
            ends = np.arange(len(far) + 1, dtype=np.int32) * far.shape[1]
            yield records({"vec_id": batch.column("vec_id"), "row_id": batch.column("row_id"), "vector": batch.column("vector"),
                           "far": pa.ListArray.from_arrays(ends, far.ravel())}, layout)

    return staged(rows.mapInArrow(measure, "vec_id long, row_id long, vector array<long>, far array<double>"), "pivots")


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products: in floating point where that is exact, which is faster."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[-1])
    if most >= 2 ** 63:
        raise ValueError("components are too large for scores of 64 bits")
    if most < 2 ** 53:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def eliminate(queries: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    """The k best candidates of one block for each query of one block."""
    if not queries.num_rows or not candidates.num_rows:
        return FOUND.empty_table()
    q, x = widen(matrix(queries.column("vector")), matrix(candidates.column("vector")))
    q_far, x_far = matrix(queries.column("far")), np.ascontiguousarray(matrix(candidates.column("far")).T)
    q_rows, x_rows = np.asarray(queries.column("query_row")), np.asarray(candidates.column("row_id"))
    q_ids, x_ids = np.asarray(queries.column("query_id")), np.asarray(candidates.column("vec_id"))
    q_norm, x_norm = ((m.astype(np.float64) ** 2).sum(1) for m in (q, x))
    out: list[list] = [[], [], [], [], []]
    for i in range(len(q)):
        bound = np.zeros(len(x))
        for p in range(len(x_far)):
            np.maximum(bound, np.abs(x_far[p] - q_far[i, p]), out=bound)
        norms = q_norm[i] + x_norm
        top = (norms - bound * bound) / 2 + 1e-7 * norms + 1  # with room for rounding
        top[x_rows == q_rows[i]] = -np.inf
        scores = np.zeros(0, np.int64)
        seen = np.zeros(0, np.int64)
        size = max(FIRST_LOOK, k)
        while True:
            if size < len(x):
                order = np.argpartition(-top, size)
                look, rest = order[:size], top[order[size]]
            else:
                look, rest = np.arange(len(x)), -np.inf
            new = np.setdiff1d(look, seen, assume_unique=True)
            scores = np.concatenate([scores, products(x[new], q[i])])
            seen = np.concatenate([seen, new])
            if rest == -np.inf or (len(scores) > k and rest < np.partition(scores, -k)[-k]):
                break
            size *= 4
        keep = np.isfinite(top[seen])
        seen, scores = seen[keep], scores[keep]
        best = np.lexsort((x_rows[seen], x_ids[seen], -scores))[:k]
        for column, values in zip(out, (np.full(len(best), q_rows[i]), np.full(len(best), q_ids[i]), x_rows[seen[best]],
                                        x_ids[seen[best]], scores[best]), strict=True):
            column.append(values)
    return pa.table([np.concatenate(c) for c in out], schema=FOUND)


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, id_column: str = "vec_id", vector_column: str = "embedding",
          pivots: int = PIVOTS, candidate_rows: int = CANDIDATE_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """The k candidates with the highest inner products of each query, ties to the smaller id.

    ``is_query`` is a condition on ``vec_id``; all other rows than the query's own are candidates.
    """
    rows = pivot_table(vectors, id_column, vector_column, pivots)
    queries = rows.filter(is_query)
    candidate_blocks = max(1, -(-rows.count() // candidate_rows))
    query_blocks = max(1, -(-queries.count() // query_rows))

    def blocks(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def block(n: int) -> Column:
        return F.pmod(F.xxhash64("row_id"), F.lit(n)).cast("int")

    left = queries.select(F.col("row_id").alias("query_row"), F.col("vec_id").alias("query_id"), "vector", "far",
                          block(query_blocks).alias("q_block")).withColumn("c_block", blocks(candidate_blocks))
    right = rows.select("row_id", "vec_id", "vector", "far", block(candidate_blocks).alias("c_block")).withColumn("q_block", blocks(query_blocks))

    def search(a: pa.Table, b: pa.Table) -> pa.Table:
        return eliminate(a, b, k)

    found = left.groupBy("c_block", "q_block").cogroup(right.groupBy("c_block", "q_block")).applyInArrow(
        search, "query_row long, query_id long, row_id long, vec_id long, score long")
    w = W.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id", "row_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
