"""Profiles, missing values, quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from plotwise.functions import dates, numbers
from plotwise.operators import impute, quality
from plotwise.operators.features import split_slot
from plotwise.operators.quantiles import scalar_quantile
from plotwise.suite.registry import query
from plotwise.suite.scalars import RAW_DATES, RAW_GAPS, parse_date_sql, raw, raw_sql

RAW_HOLES = {
    "id": "o_orderkey", "price": "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END",
    "kind": "CASE WHEN o_custkey % 9 = 0 THEN NULL ELSE o_orderpriority END",
    "none": "CAST(NULL AS STRING)", "flag": "o_orderkey % 2 = 0",
}
_PROFILED = [("id", "bigint"), ("price", "double"), ("kind", "string"), ("none", "string"), ("flag", "boolean")]


@query("profile", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", '{t}' AS dtype, count(*) - count({c}) AS missing,
        round((count(*) - count({c})) * 100.0 / count(*), 2)::DOUBLE AS missing_pct FROM {raw_sql('orders', RAW_HOLES)}"""
    for c, t in _PROFILED))
def profile(spark, d):
    return quality.profile(raw(spark, d, "orders", RAW_HOLES))


RAW_PEOPLE = {"id": "c_custkey", "price": "CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END",
              "zone": "CASE WHEN c_nationkey = 3 THEN NULL ELSE c_mktsegment END"}


def _missing_sql(column: str, source: str, present: bool) -> str:
    rows = raw_sql("orders", RAW_HOLES) if source == "orders" else raw_sql("customer", RAW_PEOPLE)
    return f"(SELECT count(*) - count({column}) FROM {rows})" if present else "0"


@query("missing_matrix", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CAST({_missing_sql(c, 'orders', c in RAW_HOLES)} AS BIGINT) AS orders,
        CAST({_missing_sql(c, 'customer', c in RAW_PEOPLE)} AS BIGINT) AS customer"""
    for c in ["id", "price", "kind", "none", "flag", "zone"]))
def missing_matrix(spark, d):
    return quality.missing_matrix({"orders": raw(spark, d, "orders", RAW_HOLES),
                                   "customer": raw(spark, d, "customer", RAW_PEOPLE)})


RAW_CHECKED = {
    "id": "CASE WHEN l_suppkey = 3 THEN NULL ELSE l_orderkey * 10 + l_linenumber END", "price_thb": "l_extendedprice",
    "area_sqm": "l_quantity - CASE WHEN l_partkey % 97 = 0 THEN 60 ELSE 0 END",
    "price_per_sqm": "l_extendedprice / (l_quantity - CASE WHEN l_partkey % 97 = 0 THEN 60 ELSE 0 END) * 1.000001",
    "has_bts": "CAST(l_linenumber % 2 AS INT)",
}


@query("quality_checks", f"""
    WITH x AS (SELECT * FROM {raw_sql('lineitem', RAW_CHECKED)})
    SELECT 'unique_id' AS check_name, (SELECT max(n) <= 1 FROM (SELECT count(*) AS n FROM x GROUP BY id)) AS passed
    UNION ALL SELECT 'price_present_and_positive', (SELECT bool_and(coalesce(price_thb > 0, false)) FROM x)
    UNION ALL SELECT 'area_present_and_positive', (SELECT bool_and(coalesce(area_sqm > 0, false)) FROM x)
    UNION ALL SELECT 'price_per_sqm_consistent', (SELECT bool_and(abs(price_per_sqm - price_thb / area_sqm)
        <= 1e-8 + 1e-5 * abs(price_thb / area_sqm)) FROM x)
    UNION ALL SELECT 'has_bts_binary', (SELECT bool_and(has_bts IN (0, 1)) FROM x)
    UNION ALL SELECT 'exactly_5_columns', true""")
def quality_checks(spark, d):
    return quality.quality_checks(raw(spark, d, "lineitem", RAW_CHECKED), n_columns=5)


@query("unparsed_count", f"""
    SELECT count(*) FILTER (WHERE {parse_date_sql('written')} IS NULL) AS unparsed_dates,
           count(*) FILTER (WHERE written IS NULL) AS missing_dates,
           count(*) FILTER (WHERE price IS NULL) AS missing_prices FROM {raw_sql('orders', RAW_DATES)}""")
def unparsed_count(spark, d):
    return quality.missing_counts(raw(spark, d, "orders", RAW_DATES), {
        "unparsed_dates": dates.parse_date(F.col("written")).isNull(),
        "missing_dates": F.col("written").isNull(), "missing_prices": F.col("price").isNull()})


# Areas for the ratio; priced and unpriced rows on both sides of the split.
RAW_FITTED = {**RAW_GAPS, "area": "CAST(o_custkey % 90 + 10 AS DOUBLE)"}
SLOT_SQL = "(('0x' || substr(md5(CAST({k} AS VARCHAR)), 1, 7))::BIGINT % 10)"


@query("fit_thresholds_on_train", f"""
    WITH x AS (SELECT *, {SLOT_SQL.format(k='id')} < 8 AS is_train FROM {raw_sql('orders', RAW_FITTED)}),
    m AS (SELECT priority, status, median(price) AS med FROM x WHERE is_train GROUP BY ALL),
    t AS (SELECT quantile_cont(price / area, 0.99) AS p99 FROM x WHERE is_train AND price IS NOT NULL)
    SELECT id, round(coalesce(price, med), 3) AS price, price IS NOT NULL AS observed,
           coalesce(price, med) / area <= (SELECT p99 FROM t) AS kept
    FROM x LEFT JOIN m USING (priority, status) WHERE NOT is_train""")
def fit_thresholds_on_train(spark, d):
    rows = raw(spark, d, "orders", RAW_FITTED).withColumn("is_train", split_slot(F.col("id")) < 8)
    train, test = rows.filter("is_train"), rows.filter("not is_train")
    filled = impute.impute_group_median(test.withColumn("observed", F.col("price").isNotNull()), "price",
                                        ["priority", "status"], fitted_on=train)
    ratio = numbers.price_per_area(F.col("price"), F.col("area"))
    p99 = scalar_quantile(train.withColumn("ratio", ratio), "ratio", 0.99)
    return filled.select("id", F.round("price", 3).alias("price"), "observed", (ratio <= p99).alias("kept"))
