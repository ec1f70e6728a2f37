import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from plotwise.llm import quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(inside))


@pytest.fixture(scope="module")
def texts(odd_rows):
    rng = random.Random(51)
    parts = ["a", "b", "A", "é", "#", "x|y", "\n", "\r\n", "\t", " ", "\x0b", "\x1c", "\xa0", "\x85", "  "]
    return [t for _, t, _, _ in odd_rows] + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 80))) for _ in range(500)]


def test_counts_equal_brute_force(texts):
    counts = quality.base_counts(pa.array(texts))
    for i, t in enumerate(texts):
        assert tuple(int(counts[c][i]) for c in quality.COUNTS) == brute(t), repr((t or "")[:80])


def test_counts_of_nothing():
    assert all(len(v) == 0 for v in quality.base_counts(pa.array([], pa.string())).values())
    assert all(v.tolist() == [0, 0] for v in quality.base_counts(pa.array([None, ""], pa.string())).values())


def test_bucket_counts_cover_all_documents(make, texts):
    docs = make([(i, t, "en", "a") for i, t in enumerate(texts)])
    total = quality.bucket_counts(docs.select("text"))
    assert total.sum() == sum(max(0, len(t or "") - n + 1) for t in texts for n in quality.ORDERS)
    assert (total == quality.bucket_counts(docs.select("text").repartition(7))).all()


@pytest.fixture(scope="module")
def judged(make, spark):
    rng = random.Random(52)
    words = ["".join(rng.choices("aeioulnrst", k=rng.randint(2, 8))) for _ in range(500)]
    clean = [(i, " ".join(rng.choices(words, k=120)), "en", "a") for i in range(400)]
    junk = [(1000 + i, " ".join(w.upper() + "!!%%" for w in rng.choices(words, k=120)), "en", "a") for i in range(60)]
    rows = clean + junk + [(2000, "too short", "en", "a"), (2001, None, None, None), (2002, "same " * 100, "en", "a"), (None, clean[0][1], "en", "a")]
    docs = make(rows)
    trusted = spark.createDataFrame([(i,) for i in [*range(0, 400, 2), None, 9999]], "doc_id long")
    return docs, trusted, {r["doc_id"]: r for r in quality.judge(docs, quality.learn(docs, trusted)).collect()}, rows


def test_clean_rows_are_kept_and_junk_goes(judged):
    _, _, got, rows = judged
    assert len(got) == len(rows)
    assert all(got[i]["kept"] for i in [*range(400), None])
    assert not any(got[1000 + i]["kept"] or got[1000 + i]["base_failed"] for i in range(60))
    for i in (2000, 2001, 2002):
        assert got[i]["base_failed"] and not got[i]["kept"]


def test_scores_equal_the_formula(judged):
    docs, trusted, got, rows = judged
    texts = {i: t for i, t, _, _ in rows}
    raw = quality.bucket_counts(docs.select("text"))
    good = quality.bucket_counts(docs.join(trusted, "doc_id").select("text"))
    ratio = quality.log_ratio(good, raw)
    assert got[3]["score"] == pytest.approx(float(quality.mean_ratio(pa.array([texts[3]]), ratio)[0]), abs=1e-6)
    assert np.exp(np.log((good + 1) / (good.sum() + len(raw)))).sum() == pytest.approx(1)


def test_without_trusted_rows_or_rows(judged, make, empty):
    docs, trusted, _, rows = judged
    none = trusted.filter("doc_id = -1")
    got = quality.judge(docs, quality.learn(docs, none)).collect()
    assert all(r["kept"] != r["base_failed"] and r["score"] == 0 for r in got)
    assert quality.judge(empty, quality.learn(empty, none)).collect() == []


def test_copies_count_like_repeated_rows(spark):
    texts = ["abc de", "xyz", "", "a"]
    some = spark.createDataFrame([(t, n) for t, n in zip(texts, (3, 1, 2, 4))], "text string, copies long")
    rows = spark.createDataFrame([(t,) for t, n in zip(texts, (3, 1, 2, 4)) for _ in range(n)], "text string")
    assert (quality.bucket_counts(some) == quality.bucket_counts(rows)).all()
    values, copies = np.array([3.0, 1.0, 2.0]), np.array([2, 5, 1])
    for part in (0, 0.002, 0.3, 0.8, 1):
        assert quality.quantile(values, copies, part) == pytest.approx(np.quantile(np.repeat(values, copies), part))


def test_every_trusted_text_counts(spark):
    """With all documents trusted both multinomials are the same, however many there are; and ids sent or shuffled give one result."""
    docs = spark.range(20_600).selectExpr("id AS doc_id", "concat('w', id, ' x', id % 977, repeat(' line', CAST(id % 60 AS INT))) AS text")
    by = quality.learn(docs, docs.select("doc_id"))
    assert not by.ratio.any() and by.threshold == pytest.approx(-quality.SLACK)
    some = docs.select("doc_id").filter("doc_id % 3 = 0")
    sent, shuffled = quality.learn(docs, some), quality.learn(docs, some, max_sent=0)
    assert (sent.ratio == shuffled.ratio).all() and sent.threshold == pytest.approx(shuffled.threshold)
    long = docs.join(some, "doc_id").filter("length(text) >= 200").toArrow().column("text").combine_chunks()
    assert sent.threshold == pytest.approx(np.quantile(quality.mean_ratio(long, sent.ratio), quality.TRUSTED_LOSS) - quality.SLACK, abs=1e-6)
