import random
import re
from math import log

import pytest
from pyspark.sql import functions as F

from plotwise.operators import similar
from plotwise.session import staged

SCHEMA = "id long, title string, place string, price double, note string"


def words(title):
    out = "".join(c if c.isalnum() else " " for c in (title or "").lower()).split()
    return set(out)


def near(a, b):
    if not words(a[1]) or not words(b[1]):
        return False
    most = max(len(words(a[1])), len(words(b[1])))
    if most - len(words(a[1]) & words(b[1])) > min(3, most // 8):
        return False
    if " ".join((a[2] or "\0").lower().split()) != " ".join((b[2] or "\0").lower().split()):
        return False
    if a[3] is not None and b[3] is not None and a[3] > 0 and b[3] > 0:
        return abs(log(a[3]) - log(b[3])) <= log(1.05) + 1e-9
    return a[3] == b[3]


def plain(rows):
    return {r[0] for r in rows if not any(o[0] < r[0] and near(o, r) for o in rows)}


def run(spark, rows, **options):
    df = staged(spark.createDataFrame([(*r, "n") for r in rows], SCHEMA))
    out = similar.drop_similar(df, "id", "title", "place", "price", ["id"], **options)
    assert out.columns == df.columns
    got = [r.id for r in out.collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_one_changed_word_in_eight(spark):
    title = "sunny condo near the park with two balconies"
    rows = [(1, title, "Ari", 100.0), (2, title.replace("sunny", "bright"), "ari", 104.0), (3, title.upper() + "!", "Ari", 105.0),
            (4, title.replace("sunny", "bright").replace("park", "river"), "Ari", 100.0), (5, title, "Silom", 100.0),
            (6, title, "Ari", 111.0), (7, "condo near the park", "Ari", 100.0), (8, "condo near a park", "Ari", 100.0)]
    assert run(spark, rows) == plain(rows) == {1, 5, 6, 7, 8}


def test_against_all_pairs(spark):
    rng = random.Random(8)
    pool = [f"w{i}" for i in range(40)]
    bases = [rng.sample(pool, rng.choice([3, 7, 8, 9, 15, 16, 17, 24, 26])) for _ in range(25)]
    rows = []
    for i in range(500):
        title = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 4])):
            kind = rng.random()
            if kind < 0.5:
                title[rng.randrange(len(title))] = rng.choice(pool)
            elif kind < 0.75 and len(title) > 1:
                title.pop(rng.randrange(len(title)))
            else:
                title.append(rng.choice(pool))
        rng.shuffle(title)
        rows.append((i, " ".join(title), rng.choice(["a", "A ", None]), rng.choice([None, -1.0, 0.0, *[100 * 1.0125 ** k for k in range(12)], 1e-3, 1e15])))
    want = plain(rows)
    assert run(spark, rows) == want and 50 < len(want) < 450
    assert run(spark, rows, max_sent=0) == want


def test_missing_titles_are_similar_to_none(spark):
    rows = [(1, None, "a", 1.0), (2, None, "a", 1.0), (3, " !", "a", 1.0), (4, " !", "a", 1.0)]
    assert run(spark, rows) == {1, 2, 3, 4} == plain(rows)
    assert run(spark, rows[:0]) == set()


def test_a_hot_title_needs_no_pairs(spark):
    """Most rows differ in one word only, and all of them meet in one set of the others."""
    rows = staged(spark.range(60_000).select(
        F.col("id"), F.concat(F.lit("new house in the quiet old garden town "), F.col("id").cast("string")).alias("title"),
        F.lit("Ari").alias("place"), (F.lit(1000.0) + F.col("id") % 40).alias("price"), F.lit("n").alias("note")))
    kept = similar.drop_similar(rows, "id", "title", "place", "price", ["id"])
    assert [r.id for r in kept.collect()] == [0]


@pytest.mark.parametrize("size, gone", [(7, 0), (8, 1), (16, 2), (24, 3), (40, 3)])
def test_word_sets(spark, size, gone):
    from math import comb
    df = spark.createDataFrame([([f"w{i}" for i in range(size)],)], "words array<string>")
    sets = df.select(F.explode(similar.word_sets(F.col("words"))).alias("s")).select("s.*").collect()
    assert len(sets) == len(set(sets)) == sum(comb(size, k) for k in range(gone + 1))


def test_windows_are_dealt_by_their_rows(spark, monkeypatch):
    """Each part of the windows has a bounded number of rows, however many there are, with the same rows kept."""
    table = spark.range(400).selectExpr("id AS pos", "concat('a b c d e f g lot', id % 90) AS title", "concat('p', id % 3) AS place", "100.0 + id % 37 AS price").localCheckpoint()
    want = {r.pos for r in similar.drop_similar(table, "pos", "title", "place", "price", ["pos"]).collect()}
    monkeypatch.setattr(similar, "WINDOW_ROWS", 100)
    kept = similar.kept_positions(table, "pos", "title", "place", "price", ["pos"], 0.05)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and len(want) < 400
    counts = [int(n) for n in re.findall(r"in#\d+L?, (\d+)\), REPARTITION_BY_NUM", plan)]
    assert counts and 10 < max(counts) <= 3 * 9 * 400 // 100
    assert {r.pos for r in kept.collect()} == want
