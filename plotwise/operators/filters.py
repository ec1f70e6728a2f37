"""Row filters of the analytic queries. Plain predicates, so they reach the scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotwise.functions import text
from plotwise.operators.quantiles import exact_quantiles, scalar_quantile
from plotwise.operators.sizes import join_fitted


def listing_filter(df: DataFrame, *, equals: dict[str, str | None] | None = None,
                   price: str = "price_thb", min_price: float | None = None, max_price: float | None = None,
                   title: str = "title", search: str | None = None, literal: bool = False) -> DataFrame:
    """Optional equality, inclusive price range and title search; ``all`` passes."""
    for column, wanted in (equals or {}).items():
        if wanted and wanted != "all":
            df = df.filter(F.col(column) == wanted)
    if min_price is not None:
        df = df.filter(F.col(price) >= min_price)
    if max_price is not None:
        df = df.filter(F.col(price) <= max_price)
    if search:
        df = df.filter(text.matches(F.col(title), search, literal))
    return df


def required_positive(df: DataFrame, present: Sequence[str], positive: Sequence[str]) -> DataFrame:
    """Rows with all ``present`` columns set and all ``positive`` ones above 0."""
    for c in present:
        df = df.filter(F.col(c).isNotNull())
    for c in positive:
        df = df.filter(F.col(c) > 0)
    return df


def below_quantile(df: DataFrame, value: str, p: float, inclusive: bool = True,
                   fitted_on: DataFrame | None = None) -> DataFrame:
    """Rows up to the exact quantile of the column (of ``fitted_on`` if given)."""
    source = df if fitted_on is None else fitted_on
    limit = scalar_quantile(source, value, p)
    return df.filter(F.col(value) <= limit if inclusive else F.col(value) < limit)


def plot_range(df: DataFrame, area: str = "area_sqm", price: str = "price_thb", max_area: float = 2000.0,
               p: float = 0.95) -> DataFrame:
    """Rows a scatter plot shows: sensible area, price strictly below the P95 of all rows."""
    limit = scalar_quantile(df, price, p)
    return df.filter((F.col(area) > 0) & (F.col(area) < max_area)
                     & (F.col(price) > 0) & (F.col(price) < limit))


def iqr_filter(df: DataFrame, value: str, by: Sequence[str] = (), k: float = 1.5) -> DataFrame:
    """Rows within ``k`` interquartile ranges of the quartiles, per group."""
    q = exact_quantiles(df, value, {"_q1": 0.25, "_q3": 0.75}, by)
    spread = (F.col("_q3") - F.col("_q1")) * k
    bounds = q.select(*by, (F.col("_q1") - spread).alias("_from"), (F.col("_q3") + spread).alias("_to"))
    if by:
        return join_fitted(df, bounds, list(by), "inner").filter(
            F.col(value).between(F.col("_from"), F.col("_to"))).select(*df.columns)
    return df.filter(F.col(value).between(bounds.select("_from").scalar(), bounds.select("_to").scalar()))


def keep_unless(condition: Column) -> Column:
    """Predicate that drops only rows where the condition is TRUE, never NULL ones."""
    return ~F.coalesce(condition, F.lit(False))
