import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from plotwise.operators import aggregates, audit, dedup, features, filters, histogram, impute, metrics, paging, quality
from plotwise.operators.quantiles import exact_quantiles
from plotwise.operators.sizes import join_fitted, small_or_none

PROBS = {"q05": 0.05, "q50": 0.5, "q99": 0.99, "q100": 1.0}


def frame(spark, values, groups=None):
    groups = groups or ["g"] * len(values)
    return spark.createDataFrame(list(zip(groups, values)), "g string, v double")


DISTRIBUTIONS = {
    "uniform": lambda r: [r.uniform(0, 1e6) for _ in range(2000)],
    "signed": lambda r: [r.gauss(0, 10) for _ in range(2000)] + [0.0] * 50,
    "wide": lambda r: [10 ** r.uniform(-300, 300) * r.choice([-1, 1]) for _ in range(1000)],
    "neighbours": lambda r: [float(np.nextafter(1.0, 2.0)) if r.random() < .5 else 1.0 for _ in range(501)]
    + [1.0 + k * 2.0 ** -52 for k in range(500)],
    "ties": lambda r: [r.choice([1.0, 2.0, 3.0, 10.0]) for _ in range(1000)],
    "one": lambda r: [7.5],
}


@pytest.mark.parametrize("name", DISTRIBUTIONS)
def test_quantiles_equal_sorted_values(spark, name):
    values = DISTRIBUTIONS[name](random.Random(3))
    got = exact_quantiles(frame(spark, values), "v", PROBS).first()
    for q, p in PROBS.items():
        assert got[q] == pytest.approx(float(np.quantile(values, p)), rel=1e-12)


def test_known_quantile(spark):
    assert exact_quantiles(frame(spark, [1.0, 2.0, 3.0, 10.0]), "v", {"q": 0.99}).first().q == pytest.approx(9.79)
    assert exact_quantiles(frame(spark, []), "v", {"q": 0.5}).first().q is None


@pytest.mark.parametrize("max_local", [20_000, 5])
def test_grouped_quantiles_with_hot_group_and_nulls(spark, max_local):
    r = random.Random(5)
    groups = ["hot" if r.random() < .4 else f"g{r.randrange(12)}" for _ in range(4000)] + [None, "empty"]
    values = [round(r.uniform(-100, 1e5), 2) for _ in range(4000)] + [1.0, None]
    got = exact_quantiles(frame(spark, values, groups), "v", PROBS, ["g"], max_local=max_local).toPandas().set_index("g")
    want = pd.DataFrame({"g": groups, "v": values}).dropna().groupby("g").v
    assert set(got.index) == set(want.groups)
    for q, p in PROBS.items():
        assert np.allclose(got[q].sort_index(), want.quantile(p).sort_index(), rtol=1e-15)


def test_size_check(spark):
    df = spark.range(10)
    assert small_or_none(df, 9) is None and small_or_none(df, 10).count() == 10
    facts = spark.range(100).select((F.col("id") % 20).alias("id"))
    for limit in (5, 100):
        assert join_fitted(facts, df.withColumn("x", F.lit(1)), ["id"], max_rows=limit).filter("x = 1").count() == 50


def test_impute(spark):
    df = spark.createDataFrame([("a", 1.0, False), ("a", 3.0, False), ("a", None, False), ("b", None, True), (None, None, False)],
                               "g string, v double, f boolean")
    one = impute.impute_group_median(df, "v", ["g"], "f")
    two = impute.impute_overall_median(one, "v")
    assert sorted((str(r.g), r.v, r.f) for r in two.collect()) == [
        ("None", 2.0, False), ("a", 1.0, False), ("a", 2.0, True), ("a", 3.0, False), ("b", 2.0, True)]


def test_keep_first_prunes_before_the_shuffle(spark, capsys):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    kept = dedup.keep_first(df, ["k"], ["id"])
    assert sorted((r.k, r.id) for r in kept.collect()) == [(0, 0), (1, 1), (2, 2)]
    kept.explain()
    plan = capsys.readouterr().out
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit") and "Partial" in plan


def test_null_keys_are_equal(spark):
    df = spark.createDataFrame([("t", None, 1), ("t", None, 2), ("t", 1.0, 3)], "t string, p double, o int")
    assert sorted(r.o for r in dedup.keep_first(df, ["t", "p"], ["o"]).collect()) == [1, 3]
    assert dedup.duplicate_count(df, ["t", "p"]).first().duplicates == 1
    assert dedup.is_unique(df, "o").first().is_unique and not dedup.is_unique(df, "t").first().is_unique


def test_similar_listings(spark):
    df = spark.createDataFrame([(1, "Nice  Condo!", "Ari", 1000000.0), (2, "nice condo", "ari ", 1001000.0),
                                (3, "nice condo", "ari", 2000000.0), (4, "other", "ari", 1000000.0)],
                               "id int, t string, l string, p double")
    assert sorted(r.id for r in dedup.keep_first_similar(df, "t", "l", "p", ["id"]).collect()) == [1, 3, 4]


def test_histogram(spark):
    r = random.Random(1)
    values = [r.uniform(1e6, 9e6) for _ in range(1500)] + [5e7] * 10
    got = histogram.histogram(frame(spark, values), "v").collect()
    cap = np.quantile(values, 0.95)
    counts, edges = np.histogram([v for v in values if v <= cap], bins=20)
    assert [x["count"] for x in got] == counts.tolist()
    assert np.allclose([x.from_edge for x in got] + [got[-1].to_edge], edges)
    flat = histogram.histogram(frame(spark, [5.0] * 9), "v").collect()
    assert len(flat) == 20 and sum(x["count"] for x in flat) == 9 and max(x["count"] for x in flat) == 9
    assert [x["count"] for x in flat].index(9) == int(np.argmax(np.histogram([5.0] * 9, bins=20)[0]))
    assert histogram.histogram(frame(spark, []), "v").count() == 0
    assert histogram.labelled(histogram.histogram(frame(spark, [0.0, 2e7]), "v", cap_quantile=None)).first().label == "0.0-1.0M"


@pytest.fixture(scope="module")
def listings(spark):
    rows = [(f"L{i:02d}", f"Flat {i} (A+)" if i % 5 else None, ["คอนโด", "ที่ดิน", None][i % 3],
             "CBD" if i % 2 else "Outer", float(1000 * i) if i != 7 else None, 10.0 + i) for i in range(30)]
    return spark.createDataFrame(rows, "id string, title string, property_type string, zone string, price_thb double, area_sqm double")


def test_listing_filter(listings):
    f = filters.listing_filter
    assert f(listings, equals={"zone": "all", "property_type": None}).count() == 30
    assert f(listings, equals={"zone": "CBD"}, min_price=1000.0, max_price=5000.0).count() == 3
    assert f(listings, search="flat 1").count() == 9
    assert f(listings, search="(a+)", literal=True).count() == 24
    assert f(listings, search="FLAT (1|2) ").count() == 2


def test_pages(listings):
    first = paging.page(listings, 1, 4).collect()
    assert [r.id for r in first] == ["L29", "L28", "L27", "L26"]
    last = paging.page(listings, 8, 4).collect()
    assert [r.id for r in last] == ["L00", "L07"]            # missing price last
    assert [r.id for r in paging.page(listings, 1, 2, sort_by="area_sqm").collect()] == ["L00", "L01"]
    assert [r.id for r in paging.page(listings, 1, 2, sort_by="nope").collect()] == ["L00", "L01"]
    for n in range(1, 10):
        shallow, deep = (paging.page(listings, n, 4, deep=x).collect() for x in (paging.DEEP, 0))
        assert shallow == deep
    info = paging.page_info(listings, 2, 20).first()
    assert (info.total, info.page, info.pages) == (30, 2, 2)
    assert paging.page_info(listings.limit(0)).first().pages == 1
    assert [r.id for r in paging.top(listings, 2, "price_thb").collect()] == ["L29", "L28"]


def test_sample_is_repeatable_and_exact(listings):
    a = [r.id for r in paging.sample_rows(listings, 8, ["id"]).collect()]
    b = [r.id for r in paging.sample_rows(listings.repartition(5), 8, ["id"]).collect()]
    assert a == b and len(set(a)) == 8
    assert paging.sample_rows(listings, 500, ["id"]).count() == 30
    points = paging.series(paging.sample_rows(listings, 500, ["id"]), "property_type", "area_sqm", "price_thb")
    assert sum(len(r.data) for r in points.collect()) == 29


def test_aggregates(listings):
    k = aggregates.kpis(listings.withColumn("price_per_sqm", F.col("price_thb") / F.col("area_sqm"))).first()
    prices = sorted(1000.0 * i for i in range(30) if i != 7)
    assert k.total_listings == 30 and k.avg_price == pytest.approx(np.mean(prices)) and k.median_price == np.median(prices)
    by_type = {r.property_type: r["count"] for r in aggregates.group_prices(listings, "property_type").collect()}
    assert by_type == {"คอนโด": 10, "ที่ดิน": 9}
    assert aggregates.value_counts(listings, "property_type", keep_null=True).count() == 3
    share = aggregates.with_share(aggregates.value_counts(listings, "property_type"))
    assert [r.share_pct for r in share.collect()] == [50.0, 50.0]


def test_monthly(spark):
    df = spark.createDataFrame([("2024-03-05", 1.0), ("06/03/2024", 2.0), ("junk", 3.0), ("2024-04-01", None)], "d string, p double")
    assert [tuple(r) for r in aggregates.monthly_average(df, "d", "p").collect()] == [("2024-03", 1.5)]
    assert [tuple(r) for r in aggregates.monthly_average(df, "d", "p", iso_only=True).collect()] == [("2024-03", 1.0)]
    assert aggregates.undated_count(df, "d", "p").first().excluded == 2


def test_ranges_and_iqr(spark):
    df = frame(spark, [1.0, 2.0, 3.0, 4.0, 100.0, 5.0], ["a"] * 5 + ["b"])
    assert tuple(aggregates.ranges(df, ["v"]).first()) == (1.0, 100.0)
    assert filters.iqr_filter(df, "v").count() == 5
    assert filters.iqr_filter(df, "v", ["g"]).count() == 5
    assert filters.below_quantile(df, "v", 1.0, inclusive=False).count() == 5


def test_profile_and_matrix(spark):
    a = spark.createDataFrame([(1, None), (2, "x"), (3, None)], "a int, b string")
    got = {r.column: (r.dtype, r.missing, r.missing_pct) for r in quality.profile(a).collect()}
    assert got == {"a": ("int", 0, 0.0), "b": ("string", 2, 66.67)}
    b = spark.createDataFrame([(None, 1.0)], "b string, `c.d` double")
    rows = {r.column: (r.one, r.two) for r in quality.missing_matrix({"one": a, "two": b}).collect()}
    assert rows == {"a": (0, 0), "b": (2, 1), "c.d": (0, 0)}


def test_funnel(spark):
    screened = spark.createDataFrame([("x",), ("y",), (None,), (None,)], "drop_reason string")
    steps = audit.step_audit(audit.removed_by_step(screened, F.lit(6), {"one": ["x"], "two": ["y", "z"]}))
    got = [(r.step, r.remaining, r.removed, r.pct_of_initial, r.total_removed) for r in audit.funnel(steps).orderBy("step_no").collect()]
    assert got == [("merge", 6, 0, 100.0, 4), ("deduplication", 4, 2, 66.67, 4), ("one", 3, 1, 50.0, 4), ("two", 2, 1, 33.33, 4)]


def test_metrics(spark):
    r = random.Random(2)
    rows = [(y := r.uniform(0, 10), y + r.gauss(0, 1), 5.0) for _ in range(500)]
    df = spark.createDataFrame(rows, "y double, p double, c double")
    got = {m.model: m for m in metrics.metrics(df, "y", {"good": "p", "flat": "c"}).collect()}
    y, p, _ = (np.array(c) for c in zip(*rows))
    assert got["good"].MAE == pytest.approx(np.abs(p - y).mean())
    assert got["good"].RMSE == pytest.approx(np.sqrt(((p - y) ** 2).mean()))
    assert got["good"].R2 == pytest.approx(1 - ((p - y) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    tie = spark.createDataFrame([("b", 1, 0., 0., .5), ("a", 0, 0., 0., .5), ("c", 2, 0., 0., .4)],
                                "model string, rank int, MAE double, RMSE double, R2 double")
    assert metrics.best_model(tie).first().model == "a"
    assert [x.model for x in metrics.comparison(tie).collect()] == ["a", "b", "c"]
    assert metrics.importances_or_default(spark, None).count() == 7


def test_date_cast_types(spark):
    df = spark.createDataFrame([("2024-03-05", 1.0)], "d string, p double")
    assert aggregates.dated(df, "d", "p").first()["_day"] == dt.date(2024, 3, 5)


def test_undefined_r2_never_wins(spark):
    rows = spark.createDataFrame([("a", 0, float("nan")), ("b", 1, 0.7), ("c", 2, None), ("d", 3, 0.7)], "model string, rank int, R2 double")
    assert metrics.best_model(rows).first()["model"] == "b"
    assert [r["model"] for r in metrics.comparison(rows).collect()] == ["b", "d", "a", "c"]


def test_pages_below_the_first(spark):
    rows = spark.createDataFrame([(i, float(i)) for i in range(50)], "id long, price_thb double")
    want = paging.page(rows, 1, columns=["id"]).collect() if "id" in paging.DISPLAY_COLUMNS else paging.page(rows, 1, columns=["price_thb"]).collect()
    assert paging.page(rows, 0, columns=["price_thb"]).collect() == paging.page(rows, -3, columns=["price_thb"]).collect()
    assert len(want) == 20


def test_levels_are_learned(spark):
    rows = spark.createDataFrame([("x", "t1"), ("y", "t2"), ("Unknown", None)], "zone string, property_type string")
    out = features.one_hot(rows)
    assert set(out.columns) == {"zone_x", "zone_y", "zone_Unknown", "property_type_t1", "property_type_t2"}
    with pytest.raises(ValueError):
        features.levels_of(rows, most=2)


def test_similar_prices_within_a_block(spark):
    rows = [(1, "Nice Condo!!", "Ari", 100.0), (2, "condo - nice", "ARI", 100.5), (3, "nice condo", "Ari", 104.0), (4, "nice condo", "Ari", 104.9),
            (5, "nice condo", "Ari", 120.0), (6, "nice condo", "Ari", None), (7, "nice condo", "Ari", 0.0), (8, "nice condo", "Ari", -5.0),
            (9, "nice condo", "Ari", 0.0), (10, "nice condo", "Ari", None), (11, "nice condo", "Silom", 100.0), (12, None, "Ari", 100.0)]
    df = spark.createDataFrame(rows, "id long, title string, place string, price double")
    kept = {r["id"] for r in dedup.keep_first_similar(df, "title", "place", "price", ["id"]).collect()}
    assert kept == {1, 5, 6, 7, 8, 11, 12}


def test_rows_meet_marked_positions(spark):
    """Positions of any sign and distance, far more than are sent one by one, without a shuffle of the rows."""
    at = [0, 1, 63, 64, 65, 4095, 4096, -1, -64, -4097, 2 ** 40 + 5, 2 ** 62, *range(9000, 9300, 3)]
    rows = spark.createDataFrame([(p, f"row {p}") for p in [*at, *[p + 2 for p in at]]] + [(None, "none")], "p long, x string").distinct().localCheckpoint()
    marks = spark.createDataFrame([(p,) for p in at] + [(None,)], "p long")
    held = dedup.within(rows, "p", marks)
    assert sorted(r.p for r in held.collect()) == sorted(set(at)) and held.columns == ["p", "x"]
    wanted = sorted([p + 2 for p in at if p + 2 not in at]) + [None]
    for sent, pages in ((1000, 1000), (0, 1000), (0, 0)):
        left = dedup.without(rows, "p", marks.dropna(), sent, pages)
        assert sorted((r.p for r in left.collect()), key=lambda p: (p is None, p or 0)) == wanted
    assert sorted(r.p for r in dedup.within(rows, "p", marks, 0).collect()) == sorted(set(at))
    assert "Exchange hashpartitioning" not in dedup.without(rows, "p", marks, 0)._jdf.queryExecution().executedPlan().toString()
    assert dedup.within(rows, "p", marks.limit(0)).isEmpty()
