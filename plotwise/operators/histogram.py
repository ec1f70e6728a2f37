"""Equal-width histogram."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotwise.functions.display import bin_label
from plotwise.operators.filters import below_quantile
from plotwise.operators.sizes import small_or_none


def histogram(df: DataFrame, value: str, bins: int = 20, cap_quantile: float | None = 0.95) -> DataFrame:
    """Counts of equal bins over the values up to a quantile; empty bins stay.

    The last bin is closed. A range of zero is widened by half a unit on both
    sides, so equal values fall into one bin.
    """
    rows = df.select(F.col(value).cast("double").alias("_v")).dropna()
    if cap_quantile is not None:
        rows = below_quantile(rows, "_v", cap_quantile)
    lo, hi = F.min("_v"), F.max("_v")
    flat = lo == hi
    low, high = F.when(flat, lo - 0.5).otherwise(lo), F.when(flat, hi + 0.5).otherwise(hi)
    # One row, fetched so that the passes below read a constant instead of repeating the aggregate.
    edges = small_or_none(rows.agg(low.alias("low"), ((high - low) / bins).alias("width")))
    low, width = edges.select("low").scalar(), edges.select("width").scalar()
    at = F.least(F.floor((F.col("_v") - low) / width), F.lit(bins - 1)).cast("int")
    counts = rows.groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("count"))

    all_bins = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    from_edge = low + F.col("bin") * width
    return (all_bins.join(F.broadcast(counts), "bin", "left")  # at most one row per bin
            .select("bin", from_edge.alias("from_edge"), (low + (F.col("bin") + 1) * width).alias("to_edge"),
                    F.coalesce("count", F.lit(0)).alias("count"))
            .filter(F.col("from_edge").isNotNull()).orderBy("bin"))


def labelled(hist: DataFrame) -> DataFrame:
    return hist.select("bin", bin_label(F.col("from_edge"), F.col("to_edge")).alias("label"), "count")
