"""Sources, duplicates and distinct rows."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from plotwise.functions import text
from plotwise.operators import dedup, similar
from plotwise.session import shared_folder, staged
from plotwise.sources import feeds, html, reports
from plotwise.suite.registry import query, table

_UNION = """
    SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_acctbal AS amount, 'balance' AS unit,
           'customer' AS source, NULL AS brand FROM customer
    UNION ALL
    SELECT CAST(s_suppkey AS VARCHAR), s_name, s_acctbal, 'balance', 'supplier', NULL FROM supplier
    UNION ALL
    SELECT CAST(p_partkey AS VARCHAR), p_name, p_retailprice, 'price', 'part', p_brand FROM part"""


def _three_sources(spark, d):
    def mapped(name, key, label, amount, unit):
        df = table(spark, d, name)
        cols = [F.col(key).cast("string").alias("id"), F.col(label).alias("name"), F.col(amount).alias("amount"),
                F.lit(unit).alias("unit"), F.lit(name).alias("source")]
        return df.select(*cols, F.col("p_brand").alias("brand")) if name == "part" else df.select(*cols)
    return feeds.union_feeds([mapped("customer", "c_custkey", "c_name", "c_acctbal", "balance"),
                              mapped("supplier", "s_suppkey", "s_name", "s_acctbal", "balance"),
                              mapped("part", "p_partkey", "p_name", "p_retailprice", "price")])


@query("union_sources", f"SELECT id, name, amount, unit, source, brand FROM ({_UNION})")
def union_sources(spark, d):
    return _three_sources(spark, d)


@query("source_counts", f"""
    SELECT source, count(*) AS rows, CAST(grouping(source) AS INTEGER) AS is_total
    FROM ({_UNION}) GROUP BY ROLLUP (source)""")
def source_counts(spark, d):
    return feeds.source_counts(_three_sources(spark, d))


@query("csv_round_trip", r"""
    SELECT CAST(p_partkey AS VARCHAR) AS id, ' ' || p_name || ' ' AS title, '"' || p_brand || '", ' || chr(10) || p_type AS note FROM part""")
def csv_round_trip(spark, d):
    """Blanks, quotes, commas and line breaks come back from a CSV file as they were."""
    raw = table(spark, d, "part").select(
        F.col("p_partkey").cast("string").alias("id"), F.concat(F.lit(" "), "p_name", F.lit(" ")).alias("title"),
        F.concat(F.lit('"'), "p_brand", F.lit('", \n'), "p_type").alias("note"))
    path = f"{shared_folder(spark)}/csv-{uuid.uuid4().hex}"
    reports.write_csv(raw, path)
    return feeds.read_csv(spark, path).select("id", "title", "note")


@query("csv_split", "SELECT CAST(page_id AS VARCHAR) AS id, url, html, CAST(length(html) - length(replace(html, chr(10), '')) AS BIGINT) AS breaks FROM pages")
def csv_split(spark, d):
    """Pages with quotes and line breaks come back from quoted files that are cut into records by many tasks."""
    path = f"{shared_folder(spark)}/csv-{uuid.uuid4().hex}"
    reports.write_csv(table(spark, d, "pages").select(F.col("page_id").cast("string").alias("id"), "url", "html").repartition(2), path)
    rows = feeds.read_csv(spark, path, split=True).select("id", "url", "html")
    return rows.withColumn("breaks", (F.length("html") - F.length(F.replace("html", F.lit("\n"), F.lit("")))).cast("bigint"))


@query("csv_null_tokens", """
    SELECT CAST(o_orderkey AS VARCHAR) AS id,
           CASE WHEN o_orderkey % 6 BETWEEN 0 AND 3 THEN NULL ELSE o_orderpriority END AS note,
           o_orderstatus AS status
    FROM orders""")
def csv_null_tokens(spark, d):
    k = F.col("o_orderkey") % 6
    raw = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.when(k == 0, "N/A").when(k == 1, "null").when(k == 2, "").when(k == 3, F.lit(None))
        .otherwise(F.col("o_orderpriority")).alias("note"),
        F.col("o_orderstatus").alias("status"))
    path = f"{shared_folder(spark)}/csv-{uuid.uuid4().hex}"
    reports.write_csv(raw, path)
    return feeds.read_csv(spark, path).select("id", "note", "status")


_LINE_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
               "l_linestatus", "l_shipdate"]
_FIRST_LINES = f"""
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(_LINE_ORDER)}) AS rn
        FROM lineitem) WHERE rn = 1"""


def first_lines(spark, d):
    return dedup.keep_first(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], _LINE_ORDER)


@query("dedup_first", _FIRST_LINES)
def dedup_first(spark, d):
    return first_lines(spark, d)


@query("dedup_two_pass", f"""
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey, floor(l_extendedprice / 1000)
                                     ORDER BY l_orderkey, l_linenumber) AS rn
        FROM ({_FIRST_LINES})) WHERE rn = 1""")
def dedup_two_pass(spark, d):
    return dedup.keep_first(first_lines(spark, d),
                            ["l_partkey", "l_suppkey", F.floor(F.col("l_extendedprice") / 1000)],
                            ["l_orderkey", "l_linenumber"])


@query("dup_count", """
    SELECT count(*) - count(DISTINCT text) AS duplicates,
           count(DISTINCT doc_id) = count(*) AS is_unique FROM documents""")
def dup_count(spark, d):
    docs = table(spark, d, "documents")
    # Whole texts are compared by digest, so the shuffle carries 32 bytes a row.
    copies = dedup.duplicate_count(docs.select(F.sha2("text", 256).alias("digest")), ["digest"])
    return copies.withColumn("is_unique", dedup.is_unique(docs, "doc_id").scalar())


@query("dup_count_rows", """
    SELECT count(*) - count(DISTINCT (l_partkey, l_suppkey, l_quantity)) AS duplicates FROM lineitem""")
def dup_count_rows(spark, d):
    return dedup.duplicate_count(table(spark, d, "lineitem"), ["l_partkey", "l_suppkey", "l_quantity"])


@query("distinct_pairs", """
    SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders ORDER BY 1, 2""")
def distinct_pairs(spark, d):
    pair = ["o_orderpriority", "o_orderstatus"]
    return dedup.distinct_sorted(table(spark, d, "orders"), pair, pair)


@query("fuzzy_dedup", r"""
    WITH k AS (
        SELECT p_partkey, p_name, p_brand, p_retailprice,
               list_aggregate(list_sort(list_distinct(string_split(trim(regexp_replace(lower(spelled), '[^\pL\pM\pN]+', ' ', 'g')), ' '))), 'string_agg', ' ') AS t,
               trim(regexp_replace(lower(p_brand), '[^\pL\pM\pN]+', ' ', 'g')) AS b
        FROM (SELECT *, CASE p_partkey % 3 WHEN 0 THEN upper(p_name) WHEN 1 THEN p_name || '!!'
                                           ELSE replace(p_name, ' ', ' - ') END AS spelled FROM part)),
    g AS (SELECT *, (SELECT max(o.p_retailprice) FROM k o WHERE o.t = k.t AND o.b = k.b AND o.p_retailprice < k.p_retailprice) AS below FROM k),
    c AS (SELECT *, (SELECT max(s.p_retailprice) FROM g s WHERE s.t = g.t AND s.b = g.b AND s.p_retailprice <= g.p_retailprice
                     AND (s.below IS NULL OR s.p_retailprice > s.below * 1.05)) AS bottom FROM g)
    SELECT p_partkey, p_name, p_brand, p_retailprice FROM c
    WHERE p_partkey = (SELECT min(o.p_partkey) FROM c o WHERE o.t = c.t AND o.b = c.b AND o.bottom = c.bottom)""")
def fuzzy_dedup(spark, d):
    parts = table(spark, d, "part")
    k = F.col("p_partkey") % 3
    spelled = (F.when(k == 0, F.upper("p_name")).when(k == 1, F.concat("p_name", F.lit("!!")))
               .otherwise(F.replace("p_name", F.lit(" "), F.lit(" - "))))
    kept = dedup.keep_first_similar(parts.withColumn("spelled", spelled), "spelled", "p_brand", "p_retailprice",
                                    ["p_partkey"])
    return kept.select("p_partkey", "p_name", "p_brand", "p_retailprice")


# Nine words, of which the number is nearly a row's own.
_AD = "lower(p_name || ' ' || p_type) || ' close to the park, lot ' || CAST(p_partkey % 701 AS {text})"


@query("similar_titles", f"""
    WITH k AS (SELECT p_partkey, p_brand, p_retailprice, {_AD.format(text='VARCHAR')} AS ad,
        list_distinct(list_filter(string_split(trim(regexp_replace({_AD.format(text='VARCHAR')}, '[^a-z0-9]+', ' ', 'g')), ' '), lambda w: w <> '')) AS words FROM part)
    SELECT p_partkey, ad, p_brand, p_retailprice FROM k WHERE NOT EXISTS (
        SELECT 1 FROM k o WHERE o.p_brand = k.p_brand AND o.p_partkey < k.p_partkey
          AND abs(ln(o.p_retailprice) - ln(k.p_retailprice)) <= ln(1.05) + 1e-9
          AND greatest(len(o.words), len(k.words)) - len(list_intersect(o.words, k.words)) <= least(3, greatest(len(o.words), len(k.words)) // 8))""")
def similar_titles(spark, d):
    parts = table(spark, d, "part").select("p_partkey", "p_brand", "p_retailprice", F.expr(_AD.format(text="STRING")).alias("ad"))
    kept = similar.drop_similar(staged(parts, "ads"), "p_partkey", "ad", "p_brand", "p_retailprice", ["p_partkey"])
    return kept.select("p_partkey", "ad", "p_brand", "p_retailprice")


def _element_sql(tag: str, css: str | None = None) -> str:
    attrs = r"(?:\s[^>]*)?" if css is None else (
        rf"""\s[^>]*?class\s*=\s*["''](?:[^"''>]*\s)?{css}(?:\s[^"''>]*)?["''][^>]*""")
    pattern = rf"(?is)<{tag}{attrs}>(.*?)</{tag}\s*>"
    found = f"regexp_replace(regexp_extract(html, '{pattern}', 1), '<[^>]*>', '', 'g')"
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
        found = f"replace({found}, '{entity}', '{char}')"
    return f"CASE WHEN regexp_matches(html, '{pattern}') THEN {found} ELSE 'N/A' END"


@query("html_fields", f"""
    SELECT page_id, {_element_sql('h1', 'listing-title')} AS title, {_element_sql('span', 'price')} AS price,
           'DDProperty' AS source, {_element_sql('h1')} AS heading, {_element_sql('title')} AS head_title,
           {_element_sql('div', 'ad')} AS ad FROM pages""")
def html_fields(spark, d):
    pages = table(spark, d, "pages").withColumns({
        "heading": html.first_element_text(F.col("html"), "h1"),
        "head_title": html.first_element_text(F.col("html"), "title"),
        "ad": html.first_element_text(F.col("html"), "div", "ad")})
    return html.parse_listings(pages, keep=("page_id", "heading", "head_title", "ad"))


# Pages around elements of the same tag, to four levels; what stands behind them belongs to the next element.
_NESTED = """concat('<p>', url, '</p><span class="price">', page_id, repeat('<span>&amp;', page_id % 5), ' a', repeat('</span> b', page_id % 5),
    '<br/><span/></span><span>c</span><h1 class="x listing-title"><b>', page_id % 7, '</b><h1>', 'd', '</h1> e</h1><div class=ad>', page_id % 3, ' < f<div>g</div>')"""


@query("html_nested", """
    SELECT page_id, page_id % 7 || 'd e' AS title, page_id || repeat('&', page_id % 5) || ' a' || repeat(' b', page_id % 5) AS price,
           'DDProperty' AS source, page_id % 3 || ' < fg' AS ad FROM pages""")
def html_nested(spark, d):
    pages = table(spark, d, "pages").select("page_id", F.expr(_NESTED).alias("html"))
    return html.parse_listings(pages.withColumn("ad", html.first_element_text(F.col("html"), "div", "ad")), keep=("page_id", "ad"))


@query("text_cleanup", r"""
    SELECT page_id, regexp_replace(regexp_replace(html, '&amp;|<br>|\\n\\t', '', 'g'), '[🏠🔥⭐\x{0E00}]', '', 'g') AS cleaned
    FROM pages""")
def text_cleanup(spark, d):
    return table(spark, d, "pages").select("page_id", text.clean_title(F.col("html")).alias("cleaned"))
