"""Size checks behind every broadcast and every in-memory aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A fitted table with more rows than this is joined by shuffle instead.
MAX_LOCAL_ROWS = 20_000


def small_or_none(df: DataFrame, max_rows: int = MAX_LOCAL_ROWS) -> DataFrame | None:
    """The rows as a local table if there are at most ``max_rows``, else None.

    Never more than ``max_rows + 1`` rows leave the executors.
    """
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        return None
    return df.sparkSession.createDataFrame(rows, schema=df.schema)


def join_fitted(df: DataFrame, fitted: DataFrame, on: list[str], how: str = "left",
                max_rows: int = MAX_LOCAL_ROWS) -> DataFrame:
    """Join a table of per-group values: broadcast if checked small, else shuffled.

    In the shuffled case adaptive execution splits the partitions of hot groups.
    """
    small = small_or_none(fitted, max_rows)
    return df.join(fitted if small is None else F.broadcast(small), on, how)
