"""Exact, linearly interpolated quantiles that hold at any size.

The built-in ``percentile`` keeps every distinct value of a group in one task,
which fails for a group of billions of prices (and is slow long before). Here the
target ranks are narrowed down in up to three rounds. Each round is one count per
bin, combined on the map side, with a fixed upper bound of bins per group:

1. bins on a logarithmic scale (monotone in the value),
2. equal bins between the smallest and largest value of each target bin,
3. the distinct values of each target bin, at most a few hundred thousand doubles.

A round ends the search when every target bin holds a single distinct value,
which prices with two decimals reach after the second round.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotwise.operators.sizes import MAX_LOCAL_ROWS
from plotwise.session import staged

# The logarithm is shifted so that even the smallest magnitude gives a positive bin.
_LOG_BIN = "cast(coalesce(signum(_v) * floor(least((log2(abs(_v)) + 1100) * 4096, 1e9)), 0) as bigint)"
_LINEAR_BIN = "cast(if(_hi > _lo, floor((_v - _lo) / (_hi - _lo) * 2097152), 0) as bigint)"


def exact_quantiles(df: DataFrame, value: str, probs: Mapping[str, float], by: Sequence[str] = (),
                    accuracy: int | None = None, max_local: int = MAX_LOCAL_ROWS) -> DataFrame:
    """One row per group (one in all without ``by``), one column per quantile.

    Runs its rounds when called, like fitting a model; stage a long plan first.
    ``accuracy`` opts in to the approximate sketch instead. Groups with a NULL
    key are dropped, as are NULL values. With few groups the result is a local
    table; with more than ``max_local`` targets the rounds pass through files.
    """
    by = list(by)
    data = df.select(*by, F.col(value).cast("double").alias("_v")).dropna(subset=[*by, "_v"])
    if accuracy is not None:
        sketch = [F.percentile_approx("_v", p, accuracy).alias(n) for n, p in probs.items()]
        return data.groupBy(*by).agg(*sketch) if by else data.agg(*sketch)

    rows = data.selectExpr("*", f"{_LOG_BIN} as _b1")
    keys = [*by, "_b1"]
    hits, local, done = _settle(_hit(_target_ranks(_bins(rows, by, "_b1"), by, probs), keys), max_local)
    for bin_col, bin_expr in (("_b2", _LINEAR_BIN), ("_b3", "_v")):
        if not done:
            wanted = hits.select(*keys, "_lo", "_hi").distinct()
            rows = (rows.join(F.broadcast(wanted) if local else wanted, keys)
                    .selectExpr(*keys, "_v", f"{bin_expr} as {bin_col}"))
            ranks = hits.drop("_lo", "_hi")
            found = _bins(rows, keys, bin_col).join(F.broadcast(ranks) if local else ranks, keys)
            keys = [*keys, bin_col]
            hits, local, done = _settle(_hit(found, keys), max_local)

    cols = []
    for name in probs:
        low, high = (f"max(if(_q = '{name}' and _side = {side}, _lo, null))" for side in (0, 1))
        share = f"max(if(_q = '{name}', _share, null))"
        cols.append(F.expr(f"{low} + ({high} - {low}) * {share}").alias(name))
    result = hits.groupBy(*by).agg(*cols)
    return df.sparkSession.createDataFrame(result.toArrow(), schema=result.schema) if local else result


def scalar_quantile(df: DataFrame, value: str, p: float):
    """The quantile of the whole column as a scalar expression."""
    return exact_quantiles(df, value, {"q": p}).scalar()


def _over(keys: Sequence[str], tail: str = "") -> str:
    return f"over (partition by {', '.join(f'`{k}`' for k in keys) or '0'} {tail})"


def _bins(rows: DataFrame, keys: Sequence[str], bin_col: str) -> DataFrame:
    """Count, bounds and preceding count of every bin; the number of bins is bounded."""
    counts = rows.groupBy(*keys, bin_col).agg(
        F.expr("count(1) as _n"), F.expr("min(_v) as _lo"), F.expr("max(_v) as _hi"))
    running = _over(keys, f"order by {bin_col} rows unbounded preceding")
    return counts.selectExpr("*", f"sum(_n) {running} - _n as _before")


def _target_ranks(bins: DataFrame, by: Sequence[str], probs: Mapping[str, float]) -> DataFrame:
    """Each bin beside every target: the two ranks around a quantile and the share between them."""
    wanted = []
    for name, p in probs.items():
        at = f"{float(p)!r}D * (_total - 1)"
        for side, rank in ((0, f"floor({at})"), (1, f"ceil({at})")):
            wanted.append(f"struct('{name}' as _q, {side} as _side, cast({rank} as bigint) as _rank, "
                          f"{at} - floor({at}) as _share)")
    counted = bins.selectExpr("*", f"sum(_n) {_over(by)} as _total")
    return counted.selectExpr("*", f"inline(array({', '.join(wanted)}))")


def _hit(bins: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bins that hold a target rank; the rank becomes relative to its bin."""
    return bins.filter("_before <= _rank and _rank < _before + _n").selectExpr(
        *[f"`{k}`" for k in keys], "_q", "_side", "_share", "_lo", "_hi", "_rank - _before as _rank")


def _settle(hits: DataFrame, max_local: int) -> tuple[DataFrame, bool, bool]:
    """Finish a round: (targets, whether they are a checked small table, whether all are found)."""
    found = hits.limit(max_local + 1).toArrow()
    if found.num_rows > max_local:
        return staged(hits, "quantile-round"), False, False
    done = found.num_rows == 0 or pc.all(pc.equal(found["_lo"], found["_hi"])).as_py()
    return hits.sparkSession.createDataFrame(found, schema=hits.schema), True, done
