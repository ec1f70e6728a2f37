"""KPIs and group summaries. One pass each, combined on the map side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotwise.functions.dates import month_label, parse_date
from plotwise.functions.numbers import rounded
from plotwise.operators.quantiles import scalar_quantile


def kpis(df: DataFrame, price: str = "price_thb", ratio: str = "price_per_sqm") -> DataFrame:
    median = scalar_quantile(df, price, 0.5)
    return df.agg(F.count(F.lit(1)).alias("total_listings"), F.avg(price).alias("avg_price"),
                  F.avg(ratio).alias("avg_price_per_sqm")).withColumn("median_price", median)


def group_prices(df: DataFrame, by: str, price: str = "price_thb", ratio: str | None = None) -> DataFrame:
    """Priced rows and average price (and average ratio) per group; no NULL group."""
    aggs = [F.count(price).alias("count"), F.avg(price).alias("avg_price")]
    if ratio is not None:
        aggs.append(F.avg(ratio).alias("avg_price_per_sqm"))
    return df.filter(F.col(by).isNotNull()).groupBy(by).agg(*aggs)


def value_counts(df: DataFrame, by: str | Sequence[str], keep_null: bool = False) -> DataFrame:
    """Rows per value, most frequent first, ties by value."""
    keys = [by] if isinstance(by, str) else list(by)
    if not keep_null:
        df = df.dropna(subset=keys)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), *keys)


def with_share(counts: DataFrame, count: str = "count", share: str = "share_pct") -> DataFrame:
    """Percent of the total of a table that is already grouped."""
    total = counts.agg(F.sum(count)).scalar()
    return counts.withColumn(share, rounded(F.col(count) * 100.0 / total, 1))


def ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Minimum and maximum of several columns in one row."""
    return df.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))])


def average_by(df: DataFrame, by: str, value: str, name: str = "avg_price", digits: int = 2) -> DataFrame:
    """Rounded average per group, highest (before rounding) first."""
    return (df.filter(F.col(by).isNotNull()).groupBy(by).agg(F.avg(value).alias("_avg"))
            .orderBy(F.desc("_avg"), by).select(by, rounded(F.col("_avg"), digits).alias(name)))


def dated(df: DataFrame, day_text: str, value: str, iso_only: bool = False) -> DataFrame:
    """Rows with a readable date and a value; the date as ``_day``."""
    return df.withColumn("_day", parse_date(F.col(day_text), iso_only)).dropna(subset=["_day", value])


def monthly_average(df: DataFrame, day_text: str, value: str, iso_only: bool = False,
                    name: str = "avg_price", digits: int = 2) -> DataFrame:
    rows = dated(df, day_text, value, iso_only)
    return (rows.groupBy(month_label(F.col("_day")).alias("month"))
            .agg(rounded(F.avg(value), digits).alias(name)).orderBy("month"))


def undated_count(df: DataFrame, day_text: str, value: str, iso_only: bool = False) -> DataFrame:
    """One row: rows the monthly average leaves out."""
    out = parse_date(F.col(day_text), iso_only).isNull() | F.col(value).isNull()
    return df.agg(F.count_if(out).alias("excluded"))


def null_count(c: str | Column) -> Column:
    return F.count_if((F.col(c) if isinstance(c, str) else c).isNull())
