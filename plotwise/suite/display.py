"""Filtered, sorted and paged tables; samples; display texts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotwise.functions import fixed, display
from plotwise.operators import filters, impute, paging
from plotwise.suite.registry import query, sql_pick, table
from plotwise.suite.scalars import raw, raw_sql

RAW_LISTINGS = {
    "id": "'P' || lpad(CAST(p_partkey AS STRING), 9, '0')",
    "title": "CASE WHEN p_partkey % 13 = 0 THEN NULL WHEN p_partkey % 17 = 0 THEN '' WHEN p_partkey % 3 = 0 THEN "
             "upper(p_name) || ' (' || p_brand || ') with a view and a garden' ELSE p_name || ' ' || p_brand END",
    "property_type": "CASE WHEN p_size % 9 = 0 THEN NULL ELSE p_type END", "location": "p_brand",
    "zone": sql_pick("p_partkey", list(fixed.ZONES)),
    "price_thb": "CASE WHEN p_size = 7 THEN NULL ELSE round(p_retailprice * (p_size * 100), 2) END",
    "area_sqm": "CASE WHEN p_size = 11 THEN NULL WHEN p_size = 12 THEN 0.0 ELSE CAST(p_size * 7 AS DOUBLE) END",
    "price_per_sqm": "CASE WHEN p_size = 13 THEN NULL ELSE CAST(p_partkey % 5000 AS DOUBLE) + 0.25 END",
    "bedrooms": "CAST(p_size % 5 AS DOUBLE)", "bathrooms": "CAST(p_size % 3 AS DOUBLE)",
    "floor": "CAST(p_size % 40 AS DOUBLE)", "source": "'P' || CAST(p_size % 3 AS STRING)",
}
_LISTINGS = raw_sql("part", RAW_LISTINGS)
_SHOWN = ", ".join(paging.DISPLAY_COLUMNS)


def listings(spark, d):
    return raw(spark, d, "part", RAW_LISTINGS)


@query("listing_page", f"""
    SELECT {_SHOWN} FROM {_LISTINGS} WHERE property_type = 'PROMO' AND zone = 'CBD' AND price_thb >= 100000
        AND price_thb <= 4000000 ORDER BY price_thb DESC NULLS LAST, id LIMIT 15 OFFSET 15""")
def listing_page(spark, d):
    rows = filters.listing_filter(listings(spark, d), equals={"property_type": "PROMO", "zone": "CBD"},
                                  min_price=100000.0, max_price=4000000.0)
    return paging.page(rows, page=2, per_page=15)


@query("page_info", f"""
    SELECT count(*) AS total, 2 AS page, CAST(greatest(1, ceil(count(*) / 15.0)) AS BIGINT) AS pages
    FROM {_LISTINGS} WHERE zone = 'Outer'""")
def page_info(spark, d):
    rows = filters.listing_filter(listings(spark, d), equals={"property_type": "all", "zone": "Outer"})
    return paging.page_info(rows, page=2, per_page=15)


_ORDERS_PAGE = "SELECT {n} AS page, o_orderkey, o_totalprice, o_orderstatus FROM (SELECT * FROM orders ORDER BY {by}, o_orderkey LIMIT 40 OFFSET {at})"


@query("deep_pages", " UNION ALL ".join(f"({_ORDERS_PAGE.format(n=n, by='o_totalprice', at=40 * (n - 1))})" for n in (1, 250, 375, 10_000)))
def deep_pages(spark, d):
    """Pages far behind in a sorted table, all through one index."""
    orders = table(spark, d, "orders")
    index = paging.page_index(orders, "o_totalprice", tie="o_orderkey")
    pages = [index.page(orders, n, 40, ["o_orderkey", "o_totalprice", "o_orderstatus"]).withColumn("page", F.lit(n)) for n in (1, 250, 375, 10_000)]
    return reduce(DataFrame.unionByName, pages).select("page", "o_orderkey", "o_totalprice", "o_orderstatus")


@query("search", f"""
    SELECT id, title, price_thb FROM {_LISTINGS} WHERE regexp_matches(title, '(?i)RING.*brand#1')""")
def search(spark, d):
    return filters.listing_filter(listings(spark, d), search="RING.*brand#1").select("id", "title", "price_thb")


@query("search_literal", f"""
    SELECT id, title FROM {_LISTINGS} WHERE contains(lower(title), 'gear (brand#2)')""")
def search_literal(spark, d):
    return filters.listing_filter(listings(spark, d), search="Gear (Brand#2)", literal=True).select("id", "title")


@query("sort_nulls", f"""
    SELECT id, property_type, area_sqm FROM {_LISTINGS} ORDER BY area_sqm ASC NULLS LAST, id
    LIMIT 200 OFFSET (SELECT CAST(greatest(0, (ceil(count(*) / 200.0) - 1) * 200) AS BIGINT) FROM part)""")
def sort_nulls(spark, d):
    # The last page: missing areas come after all others.
    last = -(-table(spark, d, "part").count() // 200)
    return paging.page(listings(spark, d), page=last, per_page=200, sort_by="area_sqm",
                       columns=["id", "property_type", "area_sqm"])


@query("top20", """
    SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderpriority = '1-URGENT'
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""")
def top20(spark, d):
    rows = table(spark, d, "orders").filter("o_orderpriority = '1-URGENT'")
    return paging.top(rows, 20, "o_totalprice", "o_orderkey", ["o_orderkey", "o_totalprice", "o_orderstatus"])


@query("head_rows", "SELECT * FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 8")
def head_rows(spark, d):
    return paging.head(table(spark, d, "orders"), 8, ["o_orderdate", "o_orderkey"])


_LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_LINE_MD5 = "md5('42|' || l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey)"
_SCATTER = f"""
    SELECT * FROM (SELECT *, l_quantity * 45 AS area FROM lineitem)
    WHERE area > 0 AND area < 2000 AND l_extendedprice > 0
      AND l_extendedprice < (SELECT quantile_cont(l_extendedprice, 0.95) FROM lineitem)
    ORDER BY {_LINE_MD5}, {', '.join(_LINE_KEY)} LIMIT 500"""


def _scatter(spark, d):
    rows = table(spark, d, "lineitem").withColumn("area", F.col("l_quantity") * 45)
    return paging.sample_rows(filters.plot_range(rows, "area", "l_extendedprice"), 500, _LINE_KEY)


@query("sample_hash", f"""
    SELECT {', '.join(_LINE_KEY)}, l_returnflag AS label, round(area, 1) AS x, round(l_extendedprice, 0) AS y FROM ({_SCATTER})""")
def sample_hash(spark, d):
    return _scatter(spark, d).select(*_LINE_KEY, F.col("l_returnflag").alias("label"), F.round("area", 1).alias("x"),
                                     F.round("l_extendedprice", 0).alias("y"))


@query("sample_series", f"""
    SELECT l_returnflag AS label, count(*) AS points, sum(round(l_extendedprice, 0)) AS y_sum
    FROM ({_SCATTER}) GROUP BY 1""")
def sample_series(spark, d):
    s = paging.series(_scatter(spark, d), "l_returnflag", "area", "l_extendedprice")
    total = F.aggregate("data", F.lit(0.0), lambda acc, p: acc + p["y"])
    return s.select("label", F.size("data").cast("bigint").alias("points"), total.alias("y_sum"))


@query("sample_peek", f"""
    SELECT {', '.join(_LINE_KEY)} FROM lineitem ORDER BY {_LINE_MD5}, {', '.join(_LINE_KEY)} LIMIT 8""")
def sample_peek(spark, d):
    return paging.sample_rows(table(spark, d, "lineitem"), 8, _LINE_KEY).select(*_LINE_KEY)


@query("shown_cells", f"""
    SELECT id, coalesce(title, '') AS title, coalesce(property_type, '') AS property_type, coalesce(zone, '') AS zone
    FROM {_LISTINGS}""")
def shown_cells(spark, d):
    return impute.shown(listings(spark, d), ["id", "title", "property_type", "zone"])


def price_text_sql(p: str) -> str:
    return f"""(CASE WHEN {p} IS NULL THEN '฿0'
        WHEN {p} >= 1000000 THEN '฿' || printf('%.2f', {p} / 1000000) || ' ล้าน'
        WHEN {p} >= 100000 THEN '฿' || printf('%.1f', {p} / 100000) || ' แสน'
        ELSE '฿' || format('{{:,}}', CAST(round({p}) AS BIGINT)) END)"""


@query("display_rows", f"""
    SELECT id, CASE WHEN length(title) > 40 THEN substr(title, 1, 40) || '...'
                    ELSE coalesce(nullif(title, ''), 'ไม่มีหัวข้อ') END AS title,
           coalesce(nullif(property_type, ''), '-') AS property_type, coalesce(nullif(location, ''), '-') AS location,
           coalesce(nullif(zone, ''), '-') AS zone, {price_text_sql('price_thb')} AS price,
           CASE WHEN area_sqm <> 0 THEN printf('%.0f', round(area_sqm)) || ' ตร.ม.' ELSE '-' END AS area,
           CASE WHEN price_per_sqm <> 0 THEN '฿' || format('{{:,}}', CAST(round(price_per_sqm) AS BIGINT)) ELSE '-' END AS price_per_sqm
    FROM {_LISTINGS}""")
def display_rows(spark, d):
    return paging.display_rows(listings(spark, d))


RAW_AMOUNTS = {"id": "o_orderkey", "amount": "CASE o_custkey % 50 WHEN 0 THEN NULL WHEN 1 THEN 12.0 ELSE o_totalprice * 10 END"}


@query("price_text", f"SELECT id, {price_text_sql('amount')} AS price_text FROM {raw_sql('orders', RAW_AMOUNTS)}")
def price_text(spark, d):
    return raw(spark, d, "orders", RAW_AMOUNTS).select("id", display.price_text(F.col("amount")).alias("price_text"))


@query("compact_text", f"""
    SELECT id, CASE WHEN amount IS NULL THEN '0' WHEN amount >= 1000000 THEN printf('%.1f', amount / 1e6 + CASE WHEN amount % 500000 = 250000 THEN 0.01 ELSE 0 END) || 'M'
                    WHEN amount >= 1000 THEN printf('%.0f', amount / 1e3 + CASE WHEN amount % 1000 = 500 THEN 0.1 ELSE 0 END) || 'K'
                    ELSE CAST(CAST(amount AS BIGINT) AS VARCHAR) END AS compact,
           CASE WHEN amount IS NULL THEN '0' ELSE format('{{:,}}', CAST(round(amount) AS BIGINT)) END AS grouped
    FROM {raw_sql('orders', RAW_AMOUNTS)}""")
def compact_text(spark, d):
    return raw(spark, d, "orders", RAW_AMOUNTS).select(
        "id", display.compact(F.col("amount")).alias("compact"), display.number_text(F.col("amount")).alias("grouped"))
