import random

from pyspark.sql import functions as F

from plotwise.operators import keywords, paging


def plain(text, words):
    if text is None:
        return None
    return min(((r, w) for w, r in words if w is not None and r is not None and w.lower() in text.lower()), default=(None, None))[1]


def run(spark, texts, words, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "id long, title string")
    found = keywords.with_first_keyword(df, "title", spark.createDataFrame(words, "keyword string, rank long"), **options)
    assert found.columns == ["id", "title", "found"]
    return [r["found"] for r in found.orderBy("id").collect()]


def test_against_the_plain_search(spark):
    rng = random.Random(6)
    texts = ["".join(rng.choice("abcAB é ") for _ in range(rng.randint(0, 25))) for _ in range(300)] + [None, "", "same", "same", "สุขุมวิท road"]
    words = [("".join(rng.choice("abc é") for _ in range(rng.choice([3, 4, 4, 5]))), i * 7 % 101) for i in range(90)] + [("สุขุมวิท", 1000), ("b ", 700), ("É", 800), ("same", 5), (None, 1), ("x", None)]
    want = [plain(t, words) for t in texts]
    assert run(spark, texts, words) == want and len(set(want)) > 20
    assert run(spark, texts, words, max_keywords=0) == want
    assert run(spark, texts, [*words, ("", 50)]) == [plain(t, [*words, ("", 50)]) for t in texts]
    assert run(spark, texts, []) == [None] * len(texts) and run(spark, [], words) == []


def test_a_hundred_thousand_keywords(spark):
    words = spark.range(100_000).select(F.concat(F.lit("place "), F.col("id").cast("string"), F.lit(" end")).alias("keyword"), F.col("id").alias("rank"))
    texts = spark.range(20_000).select("id", F.concat(F.lit("Flat at PLACE "), (F.col("id") * 9 + 1).cast("string"), F.when(F.col("id") % 2 == 0, F.lit(" end")).otherwise(F.lit(""))).alias("title"))
    found = keywords.with_first_keyword(texts, "title", words)
    assert found.filter("id % 2 = 1 and found is not null").isEmpty()
    even = found.filter("id % 2 = 0 and id * 9 + 1 < 100000")
    assert even.filter("found is null or found <> concat('place ', id * 9 + 1, ' end')").isEmpty() and even.count() > 5000


def test_second_page_writes_nothing(spark, monkeypatch):
    rows = spark.range(5000).select(F.concat(F.lit("L"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("id"),
                                    F.when(F.col("id") % 11 != 0, (F.col("id") * 37 % 100).cast("double")).alias("price_thb"), F.lit("t").alias("title"))
    for by in ("price_thb", "id", "nope"):
        index = paging.page_index(rows, by)
        with monkeypatch.context() as closed:
            closed.setattr(paging, "staged", None)
            for page in (1, 2, 40, 250, 251, -1):
                got = [r.id for r in index.page(rows, page, 20).collect()]
                assert got == [r.id for r in paging.page(rows, page, 20, by).collect()]
            assert index.page(rows, 251, 20).collect() == []


def test_index_of_an_empty_table(spark):
    rows = spark.createDataFrame([], "id string, price_thb double")
    assert paging.page_index(rows).page(rows, 1).collect() == []


def test_columns_of_a_page_are_read_for_its_rows_only(spark, tmp_path):
    spark.range(1000).select(F.col("id"), (F.col("id") * 7 % 1000).cast("double").alias("price_thb"), F.lit("x").alias("title")).write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    index = paging.page_index(rows)
    assert set(index.keys.columns) == {"id", "price_thb", "_slice"}
    plan = index.page(rows, 3, 5)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(id" in plan


def test_keywords_that_repeat_are_met_once(spark):
    """Copies of a keyword under other ranks and in other cases make no more pairs, and pairs are not sorted."""
    words = [(w.upper() if i % 2 else w, 5000 - 7 * i) for i in range(60) for w in ("abc", "bcd", "xyz", "q")]
    texts = ["an abcd", "XYZ", "q", "none", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, title string")
    found = keywords.with_first_keyword(df, "title", spark.createDataFrame(words, "keyword string, rank long"), max_keywords=20)
    assert [r["found"] for r in found.orderBy("id").collect()] == [plain(t, words) for t in texts]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("BroadcastHashJoin") >= 2
