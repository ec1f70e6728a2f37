"""KPIs, group summaries, histogram, trend."""

from __future__ import annotations

from pyspark.sql import functions as F

from plotwise.operators import aggregates, histogram
from plotwise.suite.registry import query, table
from plotwise.suite.scalars import RAW_DATES, parse_date_sql, raw, raw_sql

RAW_GROUPS = {
    "id": "o_orderkey", "kind": "CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderpriority END",
    "zone": "o_orderstatus", "price": "CASE WHEN o_custkey % 8 = 0 THEN NULL ELSE o_totalprice END",
    "ratio": "o_totalprice / (o_custkey % 90 + 10)",
}
_GROUPS = raw_sql("orders", RAW_GROUPS)


def _groups(spark, d):
    return raw(spark, d, "orders", RAW_GROUPS)


@query("kpis", f"""
    SELECT count(*) AS total_listings, round(avg(price), 4) AS avg_price, round(median(price), 4) AS median_price,
           round(avg(ratio), 4) AS avg_price_per_sqm FROM {_GROUPS}""")
def kpis(spark, d):
    k = aggregates.kpis(_groups(spark, d), "price", "ratio")
    return k.select("total_listings", *[F.round(c, 4).alias(c) for c in ("avg_price", "median_price", "avg_price_per_sqm")])


@query("by_type", f"""
    SELECT kind, count(price) AS count, round(avg(price), 4) AS avg_price, round(avg(ratio), 4) AS avg_price_per_sqm
    FROM {_GROUPS} WHERE kind IS NOT NULL GROUP BY kind""")
def by_type(spark, d):
    g = aggregates.group_prices(_groups(spark, d), "kind", "price", "ratio")
    return g.select("kind", "count", *[F.round(c, 4).alias(c) for c in ("avg_price", "avg_price_per_sqm")])


@query("by_zone", f"""
    SELECT zone, count(price) AS count, round(avg(price), 4) AS avg_price FROM {_GROUPS} GROUP BY zone""")
def by_zone(spark, d):
    g = aggregates.group_prices(_groups(spark, d), "zone", "price")
    return g.select("zone", "count", F.round("avg_price", 4).alias("avg_price"))


@query("by_source", """
    SELECT l_returnflag AS source, count(*) AS count FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1""")
def by_source(spark, d):
    return aggregates.value_counts(table(spark, d, "lineitem").select(F.col("l_returnflag").alias("source")), "source")


@query("by_source_price", """
    SELECT l_linestatus AS source, count(l_extendedprice) AS count, round(avg(l_extendedprice), 4) AS avg_price
    FROM lineitem GROUP BY 1""")
def by_source_price(spark, d):
    rows = table(spark, d, "lineitem").withColumnRenamed("l_linestatus", "source")
    g = aggregates.group_prices(rows, "source", "l_extendedprice")
    return g.select("source", "count", F.round("avg_price", 4).alias("avg_price"))


@query("group_counts_null", f"SELECT kind, zone, count(*) AS count FROM {_GROUPS} GROUP BY kind, zone")
def group_counts_null(spark, d):
    return aggregates.value_counts(_groups(spark, d), ["kind", "zone"], keep_null=True)


@query("value_counts_null", f"SELECT kind, count(*) AS count FROM {_GROUPS} GROUP BY kind ORDER BY 2 DESC, 1")
def value_counts_null(spark, d):
    return aggregates.value_counts(_groups(spark, d), "kind", keep_null=True)


@query("summary_minmax", f"""
    SELECT min(price) AS min_price, max(price) AS max_price, round(min(ratio), 4) AS min_ratio,
           round(max(ratio), 4) AS max_ratio FROM {_GROUPS}""")
def summary_minmax(spark, d):
    r = aggregates.ranges(_groups(spark, d), ["price", "ratio"])
    return r.select("min_price", "max_price", *[F.round(c, 4).alias(c) for c in ("min_ratio", "max_ratio")])


@query("avg_by_group", f"""
    SELECT zone, round(avg(price), 2) AS avg_price FROM {_GROUPS} GROUP BY zone ORDER BY avg(price) DESC, zone""")
def avg_by_group(spark, d):
    return aggregates.average_by(_groups(spark, d), "zone", "price")


@query("rounded_ties", """
    SELECT l_orderkey, round_even(avg(l_quantity) * 10, 0) / 10 AS avg_price FROM lineitem GROUP BY l_orderkey""")
def rounded_ties(spark, d):
    """Averages of a few whole numbers, many of them exactly between two decimals."""
    return aggregates.average_by(table(spark, d, "lineitem"), "l_orderkey", "l_quantity", digits=1)


@query("type_share", f"""
    SELECT kind, count(*) AS count, round(count(*) * 100.0 / sum(count(*)) OVER (), 1)::DOUBLE AS share_pct
    FROM {_GROUPS} WHERE kind IS NOT NULL GROUP BY kind""")
def type_share(spark, d):
    return aggregates.with_share(aggregates.value_counts(_groups(spark, d), "kind"))


_DATED = raw_sql("orders", RAW_DATES)


@query("monthly_avg", f"""
    SELECT strftime({parse_date_sql('written')}, '%Y-%m') AS month, round(avg(price), 2) AS avg_price
    FROM {_DATED} WHERE {parse_date_sql('written')} IS NOT NULL AND price IS NOT NULL GROUP BY 1 ORDER BY 1""")
def monthly_avg(spark, d):
    return aggregates.monthly_average(raw(spark, d, "orders", RAW_DATES), "written", "price")


@query("monthly_avg_iso", f"""
    SELECT strftime(try_strptime(written, '%Y-%m-%d'), '%Y-%m') AS month, round(avg(price), 2) AS avg_price
    FROM {_DATED} WHERE try_strptime(written, '%Y-%m-%d') IS NOT NULL AND price IS NOT NULL GROUP BY 1 ORDER BY 1""")
def monthly_avg_iso(spark, d):
    return aggregates.monthly_average(raw(spark, d, "orders", RAW_DATES), "written", "price", iso_only=True)


@query("undated_count", f"""
    SELECT count(*) FILTER (WHERE {parse_date_sql('written')} IS NULL OR price IS NULL) AS excluded FROM {_DATED}""")
def undated_count(spark, d):
    return aggregates.undated_count(raw(spark, d, "orders", RAW_DATES), "written", "price")


_HIST = """
    WITH v AS (SELECT l_extendedprice AS v FROM lineitem
               WHERE l_extendedprice <= (SELECT quantile_cont(l_extendedprice, 0.95) FROM lineitem)),
    e AS (SELECT min(v) AS lo, (max(v) - min(v)) / 20 AS w FROM v),
    c AS (SELECT CAST(least(floor((v - lo) / w), 19) AS INTEGER) AS bin, count(*) AS n FROM v, e GROUP BY 1),
    h AS (SELECT b.bin, lo + b.bin * w AS from_edge, lo + (b.bin + 1) * w AS to_edge, coalesce(n, 0) AS count
          FROM (SELECT CAST(unnest(range(20)) AS INTEGER) AS bin) b LEFT JOIN c USING (bin), e)"""


@query("histogram20", _HIST + """
    SELECT bin, round(from_edge, 3) AS from_edge, round(to_edge, 3) AS to_edge, count FROM h ORDER BY bin""")
def histogram20(spark, d):
    h = histogram.histogram(table(spark, d, "lineitem"), "l_extendedprice")
    return h.select("bin", F.round("from_edge", 3).alias("from_edge"), F.round("to_edge", 3).alias("to_edge"), "count")


@query("histogram_labels", _HIST.replace("l_extendedprice", "(l_extendedprice * 100)") + """
    SELECT bin, printf('%.1f', round(from_edge / 1e6, 1)) || '-' || printf('%.1f', round(to_edge / 1e6, 1)) || 'M' AS label,
           count FROM h ORDER BY bin""")
def histogram_labels(spark, d):
    prices = table(spark, d, "lineitem").select((F.col("l_extendedprice") * 100).alias("price"))
    return histogram.labelled(histogram.histogram(prices, "price"))
