"""Sorting, pages, top rows and fixed-size samples."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotwise.functions import display
from plotwise.functions.numbers import rounded
from plotwise.session import staged

DISPLAY_COLUMNS = ["id", "title", "property_type", "location", "zone", "price_thb", "area_sqm",
                   "price_per_sqm", "bedrooms", "bathrooms", "floor", "source"]


def sort_keys(df: DataFrame, by: str, price: str = "price_thb", tie: str = "id") -> list[Column]:
    """Descending for the price, ascending for others, missing last; none if unknown."""
    if by not in df.columns:
        return [F.col(tie)]
    key = F.col(by).desc_nulls_last() if by == price else F.col(by).asc_nulls_last()
    return [key, F.col(tie)]


# Beyond this position a page is not cut from a per-task heap any more.
DEEP = 100_000


@dataclass(frozen=True)
class PageIndex:
    """The order of a table: its sort keys in slices, and how many rows lie before each slice.

    Written once, then every page sorts the keys of the one or two slices that it lies in, and
    fetches the other columns for its own rows only.
    """

    keys: DataFrame                       # sort key, tie and slice
    slices: list[tuple[int, int, int]]    # slice, rows before it, rows
    sort_by: str
    price: str
    tie: str

    def page(self, df: DataFrame, page: int = 1, per_page: int = 20, columns: Sequence[str] | None = None) -> DataFrame:
        """One page of the table that was indexed, as it was then. Pages below 1 are the first."""
        wanted = [c for c in (columns or DISPLAY_COLUMNS) if c in df.columns]
        offset = (max(1, page) - 1) * per_page
        around = [(s, before) for s, before, rows in self.slices if before < offset + per_page and before + rows > offset]
        if not around:
            return df.limit(0).select(*wanted)
        near = self.keys.filter(F.col("_slice").isin([s for s, _ in around]))
        order = sort_keys(self.keys, self.sort_by, self.price, self.tie)
        rows = near.orderBy(*order).offset(offset - min(b for _, b in around)).limit(per_page).select(self.tie).collect()  # one page
        return df.filter(F.col(self.tie).isin([r[0] for r in rows])).orderBy(*sort_keys(df, self.sort_by, self.price, self.tie)).select(*wanted)


def page_index(df: DataFrame, sort_by: str = "price_thb", price: str = "price_thb", tie: str = "id") -> PageIndex:
    """Index of a table by its sort keys; ``tie`` is unique and not NULL, and splits even a single hot value."""
    keys = df.select(*dict.fromkeys([c for c in (sort_by, tie) if c in df.columns]))
    sliced = staged(keys.repartitionByRange(*sort_keys(keys, sort_by, price, tie)).withColumn("_slice", F.spark_partition_id()), "page-index", by="_slice")
    slices, before = [], 0
    for r in sliced.groupBy("_slice").agg(F.count(F.lit(1)).alias("n")).orderBy("_slice").collect():  # a row per slice
        slices.append((r["_slice"], before, r["n"]))
        before += r["n"]
    return PageIndex(sliced, slices, sort_by, price, tie)


def page(df: DataFrame, page: int = 1, per_page: int = 20, sort_by: str = "price_thb",
         columns: Sequence[str] | None = None, price: str = "price_thb", tie: str = "id",
         deep: int = DEEP) -> DataFrame:
    """One page of a sorted table; each task keeps only the rows up to the page's end. Pages below 1 are the first.

    A deep page goes through an index; who shows many of them builds it once (``page_index``).
    """
    page = max(1, page)
    if page * per_page > deep:
        return page_index(df, sort_by, price, tie).page(df, page, per_page, columns)
    wanted = [c for c in (columns or DISPLAY_COLUMNS) if c in df.columns]
    return df.orderBy(*sort_keys(df, sort_by, price, tie)).offset((page - 1) * per_page).limit(per_page).select(*wanted)


def page_info(df: DataFrame, page: int = 1, per_page: int = 20) -> DataFrame:
    total = F.count(F.lit(1))
    return df.agg(total.alias("total"), F.lit(page).alias("page"),
                  F.greatest(F.lit(1), F.ceil(total / per_page)).cast("bigint").alias("pages"))


def display_rows(df: DataFrame) -> DataFrame:
    """Listing rows as the table on screen shows them."""
    return df.select("id", display.short_title(F.col("title")).alias("title"),
                     *[display.or_dash(F.col(c)).alias(c) for c in ("property_type", "location", "zone")],
                     display.price_text(F.col("price_thb")).alias("price"),
                     display.area_label(F.col("area_sqm")).alias("area"),
                     display.ratio_label(F.col("price_per_sqm")).alias("price_per_sqm"))


def top(df: DataFrame, n: int, by: str, tie: str = "id", columns: Sequence[str] | None = None) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(by), tie).limit(n).select(*(columns or df.columns))


def head(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def sample_rows(df: DataFrame, n: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, the same ones whatever the partitioning."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key])
    return df.orderBy(F.md5(text), *key).limit(n)


def series(sample: DataFrame, label: str, x: str, y: str) -> DataFrame:
    """Rounded points of a bounded sample, one row per label."""
    point = F.struct(rounded(F.col(x), 1).alias("x"), rounded(F.col(y), 0).alias("y"))
    return sample.dropna(subset=[x, y]).groupBy(F.col(label).alias("label")).agg(
        F.sort_array(F.collect_list(point)).alias("data"))
