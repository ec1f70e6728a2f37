import random
import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from plotwise.llm import mixing


def brute_cost(patterns, sizes, quotas, repeats):
    """Cheapest full flow of tiny instances, by trying all integer amounts."""
    best = (-1, 0)

    def cost(i, amount):
        return sum(k * k * max(0, min(sizes[i], amount - k * sizes[i])) for k in range(repeats))

    def go(i, left, flow, paid):
        nonlocal best
        if i == len(patterns):
            if (flow, -paid) > (best[0], -best[1]):
                best = (flow, paid)
            return
        members = [s for s in patterns[i] if s in left]

        def split(j, rest, left, used):
            if j == len(members):
                go(i + 1, left, flow + used, paid + cost(i, used))
                return
            for a in range(min(rest, left[members[j]]) + 1):
                split(j + 1, rest - a, left | {members[j]: left[members[j]] - a}, used + a)
        split(0, repeats * sizes[i], left, 0)

    go(0, dict(quotas), 0, 0)
    return best


def test_flow_is_largest_and_cheapest():
    rng = random.Random(4)
    for _ in range(40):
        patterns = [tuple(rng.sample("abc", rng.randint(1, 2))) for _ in range(3)]
        sizes = [rng.randint(0, 3) for _ in patterns]
        quotas = {s: rng.randint(0, 4) for s in "abc"}
        given = mixing.route(patterns, sizes, quotas, repeats=2)
        paid = sum(k * k * max(0, min(n, g - k * n)) for g, n in zip(given, sizes) for k in range(2))
        assert (sum(given), paid) == brute_cost(patterns, sizes, quotas, 2)


def test_share_stops_at_the_most_and_shares_again():
    parts = mixing.share([10, 100, 100], [5, 2, 1], Fraction(180))
    assert parts == [20, Fraction(320, 3), Fraction(160, 3)]
    assert mixing.share([0, 4], [5, 2], Fraction(6)) == [0, 6]
    assert mixing.share([], [], Fraction(0)) == []


def test_fill_comes_near():
    assert mixing.fill([5, 3, 0, 9], [2, 1, 4, 1], 8) == [1, 1, 0, 0]
    assert mixing.fill([5, 3, 0, 9], [2, 1, 4, 1], 12) == [2, 1, 0, 0]
    assert mixing.fill([9], [1], 3) == [0] and mixing.fill([], [], 3) == []
    rng = random.Random(6)
    sizes, counts = [rng.randint(1, 400) for _ in range(200)], [1] * 200
    for want in (0, 1, 700, 9999):
        assert abs(sum(s * n for s, n in zip(sizes, mixing.fill(sizes, counts, want))) - want) <= 5


def expected(rows):
    sizes = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    return sizes, mixing.weighted_quotas(sizes)


def test_mixed_rows(odd, odd_rows):
    got = mixing.mixed_rows(odd).collect()
    sizes, targets = expected(odd_rows)
    assert len(got) == len(odd_rows)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(float(targets[r["source"]]))
        assert r["taken"] in (0, r["size"], 2 * r["size"])
    assert sorted((r["doc_id"] or 0, r["size"]) for r in got) == sorted(
        (i or 0, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t, _, _ in odd_rows)


def test_targets_are_met_and_reruns_agree(make, spark):
    rng = random.Random(7)
    rows = [(i, "w " * rng.randint(1, 200), "en", rng.choice("aaaaabcdef")) for i in range(3000)]
    docs = make(rows)
    got = mixing.mixed_rows(docs)
    per = got.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    for r in per:
        assert abs(r["taken"] - r["target"]) <= 5
    other = mixing.mixed_rows(docs.repartition(5))
    assert got.exceptAll(other).isEmpty() and other.exceptAll(got).isEmpty()


def test_small_buckets_select_as_much(make):
    docs = make([(i, "w " * (1 + i % 50), "en", "ab"[i % 2]) for i in range(500)])
    decisions = mixing.mix(docs, F.array("source"), mixing.words(F.col("text")), lambda _: {"a": 1000, "b": 4000}, bucket_rows=8)
    per = {r["s"]: r["n"] for r in decisions.groupBy(F.col("members")[0].alias("s")).agg(
        F.sum(F.col("size") * (F.col("copies") * F.col("rows") + F.col("extra"))).alias("n")).collect()}
    assert abs(per["a"] - 1000) <= 10 and abs(per["b"] - 4000) <= 10


def test_documents_of_two_sources_serve_both(make):
    docs = make([(i, "w " * 10, "en", "x") for i in range(30)])
    both = F.when(F.col("doc_id") < 10, F.array(F.lit("a"))).when(F.col("doc_id") < 20, F.array(F.lit("b"), F.lit("a"))).otherwise(F.array(F.lit("b")))
    rows = mixing.mix(docs, both, mixing.words(F.col("text")), lambda _: {"a": 200, "b": 100}).collect()
    taken = sum(r["size"] * (r["copies"] * r["rows"] + r["extra"]) for r in rows)
    assert taken == 300
    assert all(r["copies"] * r["rows"] + r["extra"] == r["rows"] for r in rows)  # nothing twice, as all words are needed once


def test_mixed_documents_keep_their_columns(odd, empty):
    out = mixing.mixed_documents(odd)
    assert out.schema.simpleString() == odd.schema.simpleString()
    assert all(r["text"].split() for r in out.collect())
    assert mixing.mixed_documents(empty).collect() == [] and mixing.mixed_rows(empty).collect() == []


def test_many_rows_alike_are_made_in_parts(make, monkeypatch):
    rows = [(1, "one two", "en", "a")] * 700 + [(i, "w " * i, "en", "b") for i in range(2, 30)]
    want = sorted(mixing.mixed_rows(make(rows)).collect(), key=str)
    monkeypatch.setattr(mixing, "ALIKE_ROWS", 50)
    assert sorted(mixing.mixed_rows(make(rows)).collect(), key=str) == want and len(want) == len(rows)
