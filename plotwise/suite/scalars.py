"""Row-local rules: filters, text, numbers, units, dates.

Raw texts, gaps and units are derived from the tables by expressions that both
engines read alike (the ``RAW_*`` strings); the rules under test are written
separately on each side.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from plotwise.functions import dates, fixed, numbers, text
from plotwise.operators import filters, impute, keywords
from plotwise.suite.registry import query, sql_case, sql_pick, table


def raw(spark, d, name, columns: dict[str, str]):
    return table(spark, d, name).selectExpr(*[f"{e} AS {c}" for c, e in columns.items()])


def raw_sql(name: str, columns: dict[str, str]) -> str:
    return "(SELECT " + ", ".join(f"{e} AS {c}" for c, e in columns.items()) + f" FROM {name})"


SPACES = " \t"

RAW_PRICED = {
    "id": "o_orderkey",
    "price_raw": "CASE o_orderkey % 9 WHEN 0 THEN NULL WHEN 1 THEN 'ราคาต่อรอง' WHEN 2 THEN ' สอบถาม ' "
                 "ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) END",
    "area_raw": "CASE WHEN o_orderkey % 18 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END",
}


@query("drop_missing_sentinel", f"""
    SELECT id, price_raw, area_raw, price_raw IS NULL AS price_imputed FROM {raw_sql('orders', RAW_PRICED)}
    WHERE NOT (price_raw IS NULL AND area_raw IS NULL)
      AND coalesce(trim(price_raw) NOT IN ('ราคาต่อรอง', 'สอบถาม'), true)""")
def drop_missing_sentinel(spark, d):
    price, area = F.col("price_raw"), F.col("area_raw")
    rows = raw(spark, d, "orders", RAW_PRICED).filter(filters.keep_unless(price.isNull() & area.isNull()))
    return (rows.withColumn("price_imputed", price.isNull())
            .filter(~text.is_sentinel(price)))


RAW_ROOMS = {
    "id": "p_partkey",
    "beds": "CASE p_size % 6 WHEN 0 THEN 'studio' WHEN 1 THEN '3+1' WHEN 2 THEN 'N/A' WHEN 3 THEN NULL "
            "WHEN 4 THEN '5d' ELSE CAST(p_size AS STRING) END",
    "kind": "CASE p_partkey % 7 WHEN 0 THEN 'Luxury CONDO' WHEN 1 THEN 'Townhouse' WHEN 2 THEN 'Townhome' "
            "WHEN 3 THEN 'land plot' WHEN 4 THEN 'บ้านเดี่ยว' WHEN 5 THEN 'Detached' ELSE p_type END",
}


@query("default_by_type", f"""
    SELECT id, kind, coalesce(
        CASE beds WHEN 'studio' THEN 0 WHEN '3+1' THEN 4 WHEN 'N/A' THEN NULL ELSE try_cast(beds AS DOUBLE) END,
        CASE WHEN regexp_matches(kind, '(?i)คอนโด|condo|condominium') THEN 1
             WHEN regexp_matches(kind, '(?i)บ้าน|house|detached') THEN 3
             WHEN regexp_matches(kind, '(?i)ทาวน์|town') THEN 2
             WHEN regexp_matches(kind, '(?i)ที่ดิน|land') THEN 0 END)::DOUBLE AS bedrooms
    FROM {raw_sql('part', RAW_ROOMS)}""")
def default_by_type(spark, d):
    return raw(spark, d, "part", RAW_ROOMS).select(
        "id", "kind", numbers.default_bedrooms(numbers.bedroom_number(F.col("beds")), F.col("kind")).alias("bedrooms"))


_WORDS = ["Ring", "anvil", "ed w", "OLD", "small", "gizmo"]


_NOTE = "'Ref ' || CAST(o_custkey * 7 AS {t}) || '/' || CAST(o_orderkey AS {t}) || substr(' abcdefghij', CAST(o_orderkey % 10 AS INT) + 1, 2)"
_KEY = "CASE WHEN p_partkey % 400 = 3 THEN substr('ABCDEFGHIJ', CAST(p_partkey % 9 AS INT) + 1, 2) ELSE CAST((p_partkey * 37 + 100) % 100000 AS {t}) END"


@query("keyword_index", f"""
    WITH x AS (SELECT o_orderkey AS id, {_NOTE.format(t='VARCHAR')} AS note FROM orders),
    k AS (SELECT {_KEY.format(t='VARCHAR')} AS keyword, (p_partkey * 7919) % 1000003 AS rank FROM part)
    SELECT id, note, (SELECT arg_min(keyword, rank) FROM k WHERE contains(lower(note), lower(keyword))) AS keyword FROM x""")
def keyword_index(spark, d):
    """The first of thousands of keywords, by an index of their rarest parts."""
    texts = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.expr(_NOTE.format(t="STRING")).alias("note"))
    words = table(spark, d, "part").select(F.expr(_KEY.format(t="STRING")).alias("keyword"), (F.col("p_partkey") * 7919 % 1000003).alias("rank"))
    return keywords.with_first_keyword(texts, "note", words, output="keyword")


@query("keyword_extract", """
    SELECT p_partkey, p_name, CASE WHEN contains(p_name, 'ring') THEN 'Ring' WHEN contains(p_name, 'anvil') THEN 'anvil'
        WHEN contains(p_name, 'ed w') THEN 'ed w' WHEN contains(p_name, 'old') THEN 'OLD'
        WHEN contains(p_name, 'small') THEN 'small' WHEN contains(p_name, 'gizmo') THEN 'gizmo' END AS keyword
    FROM part""")
def keyword_extract(spark, d):
    return table(spark, d, "part").select("p_partkey", "p_name",
                                          text.first_keyword(F.col("p_name"), _WORDS).alias("keyword"))


@query("spam_filter", r"""
    SELECT doc_id, lang, source FROM documents
    WHERE NOT regexp_matches(text, '0\d{1,2}[-\s]?\d{3}[-\s]?\d{4}')
      AND NOT (contains(text, 'token') OR contains(text, 'nichten') OR contains(text, 'queque'))
      AND NOT contains(text, '###')
      AND (contains(lower(lang), 'en') OR contains(lower(lang), 'fr') OR contains(lower(lang), 'de'))""")
def spam_filter(spark, d):
    body = F.col("text")
    return table(spark, d, "documents").filter(
        ~text.has_phone(body) & ~text.contains_any(body, ["token", "nichten", "queque"])
        & ~text.contains_any(body, ["###"]) & text.contains_any(F.lower("lang"), ["en", "fr", "de"])
    ).select("doc_id", "lang", "source")


RAW_NUMBERS = {
    "id": "c_custkey",
    "price_raw": "CASE c_custkey % 11 WHEN 0 THEN '0' WHEN 1 THEN '0.0' WHEN 2 THEN NULL WHEN 3 THEN '5d' WHEN 4 THEN '42' "
                 "ELSE CAST(CAST(round(c_acctbal) AS BIGINT) AS STRING) END",
    "area_raw": "CASE c_custkey % 5 WHEN 0 THEN '999999' WHEN 1 THEN '-250' WHEN 2 THEN '250000' WHEN 3 THEN NULL "
                "ELSE CAST(c_nationkey AS STRING) END",
    "bedrooms": "CASE WHEN c_nationkey % 8 = 0 THEN NULL ELSE CAST(c_nationkey AS DOUBLE) END",
    "is_text": "c_custkey % 2 = 0",
}


@query("numeric_repair", f"""
    WITH parsed AS (SELECT *, try_cast(price_raw AS DOUBLE) AS p, try_cast(area_raw AS DOUBLE) AS a
                    FROM {raw_sql('customer', RAW_NUMBERS)}),
    repaired AS (SELECT id, bedrooms, abs(p) AS p1, abs(a) AS a1 FROM parsed
                 WHERE NOT coalesce(p IN (0, 1) AND (NOT is_text OR regexp_full_match(trim(price_raw), '[0-9]+')), false)),
    swapped AS (SELECT id, bedrooms, CASE WHEN p1 < 1000 AND a1 > 100000 THEN a1 ELSE p1 END AS price,
                       CASE WHEN p1 < 1000 AND a1 > 100000 THEN p1 ELSE a1 END AS area FROM repaired)
    SELECT * FROM swapped WHERE (bedrooms <= 15 OR bedrooms IS NULL) AND (area <> 999999 OR area IS NULL)""")
def numeric_repair(spark, d):
    rows = raw(spark, d, "customer", RAW_NUMBERS)
    p, a = numbers.to_number(F.col("price_raw")), numbers.to_number(F.col("area_raw"))
    price, area = numbers.repaired(p, a)
    rows = rows.filter(~numbers.is_test_price(F.col("price_raw"), p, F.col("is_text")))
    return (rows.select("id", "bedrooms", price.alias("price"), area.alias("area"))
            .filter(filters.keep_unless(F.col("bedrooms") > fixed.MAX_BEDROOMS))
            .filter(filters.keep_unless(F.col("area") == fixed.AREA_PLACEHOLDER)))


RAW_PRICE_TEXT = {
    "id": "o_orderkey",
    "price_raw": "CASE o_orderkey % 12 "
                 "WHEN 0 THEN CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS STRING) || '.5 ล้าน' "
                 "WHEN 1 THEN CAST(CAST(floor(o_totalprice / 10000) AS BIGINT) AS STRING) || 'แสน' "
                 "WHEN 2 THEN CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS STRING) || ',' || "
                 "lpad(CAST(CAST(floor(o_totalprice) AS BIGINT) % 1000 AS STRING), 3, '0') || ' บาท' "
                 "WHEN 3 THEN '-' || CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) "
                 "WHEN 4 THEN '0 ล้าน' WHEN 5 THEN '0' WHEN 6 THEN 'สอบถาม' WHEN 7 THEN NULL "
                 "WHEN 8 THEN ' 1' || CAST(CAST(floor(o_totalprice * 100) AS BIGINT) AS STRING) || ' ' "
                 "WHEN 9 THEN '2 ล้าน 5 แสน' "
                 "ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) END",
    "source": "CASE o_custkey % 3 WHEN 0 THEN 'HipFlat' WHEN 1 THEN 'Baania' ELSE 'DDProperty' END",
    "unit": "CASE o_custkey % 3 WHEN 0 THEN 'sqm_split' WHEN 1 THEN 'sqw' ELSE 'sqm' END",
}


def parse_price_sql(price: str = "price_raw", source: str = "source", unit: str = "unit") -> str:
    plain = f"replace(replace(replace({price}, ',', ''), 'บาท', ''), ' ', '')"
    def worded(word, factor):
        digits = rf"replace(regexp_extract({price}, '([\d,.]+)\s*{word}', 1), ',', '')"
        return rf"WHEN regexp_matches({price}, '([\d,.]+)\s*{word}') THEN try_cast({digits} AS DOUBLE) * {factor}"
    return f"""(CASE {worded('ล้าน', 1000000)} {worded('แสน', 100000)}
        WHEN try_cast({plain} AS DOUBLE) > 0 THEN try_cast({plain} AS DOUBLE) *
             CASE WHEN {source} = 'HipFlat' AND {unit} <> 'sqm_split_thb' THEN 35 ELSE 1 END END)"""


@query("parse_price", f"""
    WITH flagged AS (SELECT id, price_raw, source, CASE WHEN source = 'HipFlat' AND try_cast(price_raw AS DOUBLE) > 500000
                            THEN 'sqm_split_thb' ELSE unit END AS unit FROM {raw_sql('orders', RAW_PRICE_TEXT)}),
    parsed AS (SELECT *, {parse_price_sql()} AS p FROM flagged)
    SELECT id, source, unit, round(CASE WHEN p <= 500000000 THEN p END, 2) AS price_thb FROM parsed""")
def parse_price(spark, d):
    rows = raw(spark, d, "orders", RAW_PRICE_TEXT)
    thb = numbers.looks_thb(F.col("source"), numbers.to_number(F.col("price_raw")))
    rows = rows.withColumn("unit", F.when(thb, F.lit(fixed.SPLIT_UNIT_THB)).otherwise(F.col("unit")))
    price = numbers.cap_price(numbers.parse_price(F.col("price_raw"), F.col("source"), F.col("unit")))
    return rows.select("id", "source", "unit", F.round(price, 2).alias("price_thb"))


RAW_LAND = {
    "id": "p_partkey",
    "unit": "CASE p_partkey % 4 WHEN 0 THEN 'sqm' WHEN 1 THEN 'sqw' WHEN 2 THEN 'sqm_split' ELSE 'sqm_split_thb' END",
    "area": "CASE p_partkey % 10 WHEN 0 THEN NULL WHEN 1 THEN CAST(-p_size AS DOUBLE) ELSE CAST(p_size * 150 AS DOUBLE) END",
    "rai": "CASE WHEN p_partkey % 6 = 2 THEN NULL ELSE p_size % 15 + 0.5 END",
    "ngan": "CASE WHEN p_partkey % 6 = 3 THEN NULL ELSE CAST(p_size % 7 AS DOUBLE) END",
    "wah": "CAST(p_size % 50 AS DOUBLE)",
}


@query("convert_area", """
    WITH x AS (SELECT *, CASE
        WHEN unit IN ('sqm_split', 'sqm_split_thb') AND rai IS NOT NULL AND ngan IS NOT NULL AND wah IS NOT NULL
             AND least(rai, 10) * 1600 + least(ngan, 3) * 400 + wah * 4 > 0
        THEN least(rai, 10) * 1600 + least(ngan, 3) * 400 + wah * 4
        WHEN area IS NULL OR area <= 0 THEN NULL WHEN unit = 'sqw' THEN area * 4 ELSE area END AS s FROM """
       + raw_sql("part", RAW_LAND) + """)
    SELECT id, unit, round(CAST(CASE WHEN s <= 20000 THEN s END AS DOUBLE), 3) AS area_sqm FROM x""")
def convert_area(spark, d):
    c = {n: F.col(n).cast("double") for n in ("area", "rai", "ngan", "wah")}
    sqm = numbers.cap_area(numbers.to_sqm(c["area"], F.col("unit"), c["rai"], c["ngan"], c["wah"]))
    return raw(spark, d, "part", RAW_LAND).select("id", "unit", F.round(sqm, 3).alias("area_sqm"))


_PLACES = ["Sukhumvit", " สุขุมวิท", "สุขุมวิทร์", "SILOM", "Lat Phrao ", "บางแค", "rangsit", "Nowhere", "  Ari", "หนองจอก"]
RAW_PLACES = {
    "id": "c_custkey", "nation": "c_nationkey",
    "place": "CASE WHEN c_custkey % 11 = 10 THEN NULL ELSE " + sql_case("c_custkey % 11", dict(enumerate(_PLACES))) + " END",
    "kind": "CASE c_mktsegment WHEN 'HOUSEHOLD' THEN ' House ' WHEN 'BUILDING' THEN 'CONDOMINIUM' "
            "WHEN 'FURNITURE' THEN 'Land plot' ELSE c_mktsegment END",
}


@query("normalise_zone", f"""
    WITH named AS (SELECT *, coalesce({sql_case("lower(trim(place))", fixed.LOCATION_ALIASES)}, trim(place)) AS location,
                          coalesce({sql_case("lower(trim(kind))", fixed.TYPE_ALIASES)}, kind) AS property_type
                   FROM {raw_sql('customer', RAW_PLACES)})
    SELECT id, location, {sql_case('location', {p: z for z, ps in fixed.ZONES.items() for p in ps}, "'Unknown'")} AS zone,
           location AS district, property_type, r_name AS region
    FROM named LEFT JOIN nation ON nation = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def normalise_zone(spark, d):
    rows = raw(spark, d, "customer", RAW_PLACES).withColumns({
        "location": text.normalise_location(F.col("place")), "property_type": text.normalise_type(F.col("kind"))})
    rows = rows.withColumns({"zone": text.zone_of(F.col("location")), "district": F.col("location")})
    # No hint: the planner broadcasts the two dimensions by their known file size.
    nations = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return (rows.join(nations, F.col("nation") == F.col("n_nationkey"), "left")
            .select("id", "location", "zone", "district", "property_type", F.col("r_name").alias("region")))


_MONTH = "substr('JanFebMarAprMayJunJulAugSepOctNovDec', month({c}) * 3 - 2, 3)"


def date_text(column: str, style: str) -> str:
    """Expression, read alike by both engines, that writes a date in one of the feeds' styles."""
    y, m, day = (f"CAST({p}({column}) AS STRING)" for p in ("year", "month", "day"))
    mm, dd, yy = f"lpad({m}, 2, '0')", f"lpad({day}, 2, '0')", f"substr({y}, 3, 2)"
    name = _MONTH.format(c=column)
    return {"iso": f"{y} || '-' || {mm} || '-' || {dd}", "dmy": f"{dd} || '/' || {mm} || '/' || {y}",
            "d_mon_yy": f"{dd} || ' ' || {name} || ' ' || {yy}", "mon_d_y": f"{name} || ' ' || {dd} || ', ' || {y}",
            "dmyy": f"{dd} || '/' || {mm} || '/' || {yy}",
            "d_mon_yyyy": f"{dd} || ' ' || {name} || ' ' || {y}"}[style]


RAW_DATES = {
    "id": "o_orderkey", "price": "o_totalprice",
    "written": f"CASE o_orderkey % 12 WHEN 0 THEN {date_text('o_orderdate', 'iso')} "
               f"WHEN 1 THEN {date_text('o_orderdate', 'dmy')} WHEN 2 THEN {date_text('o_orderdate', 'd_mon_yy')} "
               f"WHEN 3 THEN {date_text('o_orderdate', 'mon_d_y')} WHEN 4 THEN {date_text('o_orderdate', 'dmyy')} "
               "WHEN 5 THEN 'junk' "
               f"WHEN 6 THEN {date_text('o_orderdate', 'iso')} || ' 10:00:00' WHEN 7 THEN {date_text('o_orderdate', 'iso')} || 'T23:59:59' "
               f"WHEN 8 THEN replace({date_text('o_orderdate', 'iso')}, '-', '/') WHEN 9 THEN replace({date_text('o_orderdate', 'dmy')}, '/', '-') "
               f"WHEN 10 THEN {date_text('o_orderdate', 'd_mon_yyyy')} ELSE NULL END",
}


def parse_date_sql(c: str) -> str:
    # Short years first: %Y would read two digits as a year of the first century.
    formats = ["%Y-%m-%d", "%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%d/%m/%y", "%d/%m/%Y", "%d-%m-%Y", "%d %b %y", "%d %b %Y", "%b %d, %Y",
               "%Y/%m/%d"]
    return "CAST(coalesce(" + ", ".join(f"try_strptime({c}, '{f}')" for f in formats) + ") AS DATE)"


AS_OF = "2002-01-01"


@query("parse_dates", f"""
    SELECT id, written, {parse_date_sql('written')} AS day FROM {raw_sql('orders', RAW_DATES)}""")
def parse_dates(spark, d):
    return raw(spark, d, "orders", RAW_DATES).select("id", "written", dates.parse_date(F.col("written")).alias("day"))


@query("age_days", f"""
    SELECT id, CAST(coalesce(date_diff('day', {parse_date_sql('written')}, DATE '{AS_OF}'), 180) AS INTEGER) AS age_days
    FROM {raw_sql('orders', RAW_DATES)}""")
def age_days(spark, d):
    day = dates.parse_date(F.col("written"))
    return raw(spark, d, "orders", RAW_DATES).select("id", dates.age_days(day, AS_OF).alias("age_days"))


# One whole group without prices, one missing price in seven elsewhere.
RAW_GAPS = {
    "id": "o_orderkey", "priority": "o_orderpriority", "status": "o_orderstatus",
    "price": "CASE WHEN o_orderkey % 7 = 0 OR (o_orderpriority = '5-LOW' AND o_orderstatus = 'P') THEN NULL "
             "ELSE o_totalprice END",
    "imputed": "o_orderkey % 14 = 0",
}


@query("impute_median", f"""
    WITH x AS (SELECT * FROM {raw_sql('orders', RAW_GAPS)}),
    m AS (SELECT priority, status, median(price) AS med FROM x GROUP BY ALL),
    filled AS (SELECT id, coalesce(price, med) AS price, imputed OR (price IS NULL AND med IS NOT NULL) AS imputed
               FROM x JOIN m USING (priority, status))
    SELECT id, round(coalesce(price, (SELECT median(price) FROM filled)), 3) AS price, imputed FROM filled""")
def impute_median(spark, d):
    rows = impute.impute_group_median(raw(spark, d, "orders", RAW_GAPS), "price", ["priority", "status"], "imputed")
    rows = impute.impute_overall_median(rows, "price")
    return rows.select("id", F.round("price", 3).alias("price"), "imputed")


RAW_RATIO = {"k": "l_orderkey", "line": "l_linenumber",
             "price": "CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE l_extendedprice END",
             "area": "CASE l_suppkey % 20 WHEN 0 THEN 0.0 WHEN 1 THEN NULL ELSE l_quantity END"}


@query("trim_p99", f"""
    WITH r AS (SELECT k, line, price, area, price / area AS ratio FROM {raw_sql('lineitem', RAW_RATIO)}
               WHERE price IS NOT NULL AND area > 0 AND price / area > 0)
    SELECT k, line, round(ratio, 8) AS ratio FROM r WHERE ratio <= (SELECT quantile_cont(ratio, 0.99) FROM r)""")
def trim_p99(spark, d):
    rows = raw(spark, d, "lineitem", RAW_RATIO)
    rows = rows.withColumn("ratio", numbers.price_per_area(F.col("price"), F.col("area").cast("double")))
    rows = filters.required_positive(rows, ["price"], ["area", "ratio"])
    return filters.below_quantile(rows, "ratio", 0.99).select("k", "line", F.round("ratio", 8).alias("ratio"))


@query("ratio", f"""
    SELECT k, line, round(CASE WHEN area > 0 THEN price / area END, 8) AS ratio FROM {raw_sql('lineitem', RAW_RATIO)}""")
def ratio(spark, d):
    value = numbers.price_per_area(F.col("price"), F.col("area").cast("double"))
    return raw(spark, d, "lineitem", RAW_RATIO).select("k", "line", F.round(value, 8).alias("ratio"))


@query("iqr_filter", """
    WITH b AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3
               FROM lineitem GROUP BY 1)
    SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem JOIN b USING (l_returnflag)
    WHERE l_extendedprice BETWEEN q1 - 0.5 * (q3 - q1) AND q3 + 0.5 * (q3 - q1)""")
def iqr_filter(spark, d):
    return filters.iqr_filter(table(spark, d, "lineitem"), "l_extendedprice", ["l_returnflag"], k=0.5).select(
        "l_orderkey", "l_linenumber", "l_extendedprice")


RAW_ESTIMATE = {
    "id": "p_partkey", "area_sqm": "CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE CAST(p_size * 3 AS DOUBLE) END",
    "floor_text": "CASE p_partkey % 4 WHEN 0 THEN 'G' WHEN 1 THEN NULL ELSE CAST(p_size AS STRING) END",
    "near_bts": "CASE p_partkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '  ' ELSE 'BTS ' || p_name END",
    "property_type": sql_pick("p_partkey", [*fixed.TYPE_BASE_PRICE, "villa"]),
    "zone": sql_case("p_size % 6", dict(enumerate([*fixed.ZONES, fixed.UNKNOWN_ZONE]))),
}


@query("rule_estimate", f"""
    SELECT id, coalesce(try_cast(floor_text AS DOUBLE), 0) AS floor,
           CASE WHEN trim(near_bts) <> '' THEN 1 ELSE 0 END AS has_bts,
           round(coalesce(area_sqm, 50) * {sql_case('property_type', fixed.TYPE_BASE_PRICE, '80000')}
                 * {sql_case("coalesce(zone, 'CBD')", fixed.ZONE_FACTOR, '1.0')}
                 * CASE WHEN trim(near_bts) <> '' THEN 1.1 ELSE 1.0 END, 2)::DOUBLE AS estimate
    FROM {raw_sql('part', RAW_ESTIMATE)}""")
def rule_estimate(spark, d):
    rows = raw(spark, d, "part", RAW_ESTIMATE).withColumn("has_bts", text.has_text(F.col("near_bts")))
    floor = F.coalesce(numbers.to_number(F.col("floor_text")), F.lit(0.0))
    price = numbers.rule_estimate(*[F.col(c) for c in ("area_sqm", "property_type", "zone", "has_bts")])
    return rows.select("id", floor.alias("floor"), "has_bts", F.round(price, 2).alias("estimate"))
