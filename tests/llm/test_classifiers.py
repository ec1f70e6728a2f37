import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plotwise.llm import langid, learning, ngrams, toxicity
from plotwise.llm.common import remainder

WORDS = {"en": ["the", "and", "house", "with", "thing", "water"], "de": ["und", "der", "haus", "schön", "wasser", "nicht"], "fr": ["le", "être", "maison", "avec", "leçon", "eau"]}


def test_ngrams_equal_the_plain_ones():
    texts = ["Héllo  Wörld!", "", None, "a", "ab 12 cd", "x" * 50, "日本 語"]
    offsets, codes = ngrams.words_of(*ngrams.code_points(pa.array(texts)))
    plain = []
    for t in texts:
        out = ""
        for i, c in enumerate(t or ""):
            if c.isalpha():
                out += c.lower()
            elif i == 0 or t[i - 1].isalpha():
                out += " "
        plain.append(out)
    assert ["".join(map(chr, codes[a:b])) for a, b in zip(offsets[:-1], offsets[1:])] == plain
    bucket = dict(ngrams.hashes(codes, (1, 2, 3), 20))
    seen = {}
    for n in (1, 2, 3):
        owner = ngrams.owners(offsets, n, len(bucket[n]))
        found = [[b for b, o in zip(bucket[n], owner) if o == k] for k in range(len(texts))]
        for p, f in zip(plain, found):
            grams = [p[i:i + n] for i in range(len(p) - n + 1)]
            assert len(grams) == len(f)
            for g, b in zip(grams, f):
                assert seen.setdefault(g, b) == b
        first, end = ngrams.places(offsets, n)
        assert ngrams.within(np.ones(len(bucket[n])), first, end).tolist() == [max(0, len(p) - n + 1) for p in plain]


@pytest.fixture(scope="module")
def labelled(make, spark):
    rng = random.Random(21)
    rows, labels = [], []
    for i in range(600):
        lang = rng.choice(list(WORDS))
        toxic = int(rng.random() < 0.3)
        words = rng.choices(WORDS[lang], k=rng.randint(5, 60)) + ["idiot"] * toxic
        rng.shuffle(words)
        rows.append((i, " ".join(words), lang, "a"))
        labels.append((i, toxic))
    rows += [(1000, None, "en", "a"), (1001, "", None, "a"), (1002, "123 !?", "de", "a"), (None, "the house", None, None), (5, "the house", "en", "a")]
    labels += [(2000, 1), (None, 1), (3, None)]
    return make(rows), spark.createDataFrame(labels, "doc_id long, toxic int"), rows, dict(labels[:600])


def test_toxicity_on_held_out_rows(labelled):
    docs, labels, rows, truth = labelled
    model = toxicity.learn(docs, labels, learnable=remainder(F.col("doc_id")) != 2)
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["doc_id"] in truth and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert np.mean([(r["score"] >= 0.3) == truth[r["doc_id"]] for r in held]) > 0.97
    again = toxicity.score(docs, toxicity.learn(docs, labels, learnable=remainder(F.col("doc_id")) != 2)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_toxic_word_in_a_long_text(labelled):
    docs, labels, *_ = labelled
    model = toxicity.learn(docs, labels)
    rng = random.Random(1)
    clean = " ".join(rng.choices(sum(WORDS.values(), []), k=20_000))
    scores = model.scores(pa.array([clean, clean[:60_000] + " idiot " + clean[60_000:], None, ""]))
    assert scores[1] > 0.9 > 0.5 > scores[0] and scores[2] == scores[3]


def test_toxicity_without_labels(labelled, empty):
    docs, labels, *_ = labelled
    none = labels.filter("toxic = 5")
    assert max(r["score"] for r in toxicity.score(docs, toxicity.learn(docs, none)).collect()) < 1e-6
    assert min(r["score"] for r in toxicity.score(docs, toxicity.learn(docs, labels.filter("toxic = 1"))).collect()) > 0.99
    assert toxicity.score(empty, toxicity.learn(empty, labels)).collect() == []


def test_log_ratios():
    ratio, sure = toxicity.log_ratios(np.array([[9, 0], [0, 9]]), np.array([10, 10]))
    assert ratio.tolist() == [pytest.approx(-np.log(10)), pytest.approx(np.log(10))] and sure[0] == pytest.approx(sure[1])


def test_language_on_held_out_rows(labelled):
    docs, _, rows, truth = labelled
    model = langid.learn(docs, learnable=remainder(F.col("doc_id")) != 2)
    assert model.languages == ["de", "en", "fr"]
    got = langid.identify(docs, model).collect()
    lang = {i: x for i, _, x, _ in rows}
    held = [r for r in got if r["doc_id"] in truth and r["doc_id"] != 5 and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.97
    for r in got:
        if r["doc_id"] in (1000, 1001, 1002):
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
        else:
            assert r["lang_pred"] in WORDS and 0 <= r["score"] <= 1


def test_folded_scores_equal_the_two_layers(labelled):
    docs, *_ = labelled
    rng = np.random.default_rng(3)
    vectors, weights = rng.normal(size=(1 << langid.BITS, 4)), rng.normal(size=(4, 2))
    model = langid.Model(["x", "y"], np.ascontiguousarray((vectors @ weights).T), np.zeros(2))
    texts = pa.array(["the house is red", "x", "ab"])
    mean, count = model.averages(texts)
    for k in range(3):
        ids = np.concatenate([b[f[k]:e[k]][u[f[k]:e[k]]] for b, u, f, e in langid.subwords(texts)])
        assert count[k] == len(ids) and np.allclose(mean[k], vectors[ids].mean(axis=0) @ weights)


def test_subwords_stay_within_words():
    for bucket, use, first, end in langid.subwords(pa.array(["ab cd"])):
        assert ngrams.within(use, first, end).sum() in {4, 4, 2, 0, 3}


def test_calibration():
    rng = np.random.default_rng(5)
    labels = rng.integers(0, 2, 4000)
    honest = np.where(rng.random(4000) < 0.8, labels, 1 - labels)
    logits = np.zeros((4000, 2))
    logits[np.arange(4000), honest] = 8 * np.log(4)  # far too sure: 80 % are right
    t, least = langid.calibrate(logits, labels)
    assert t == pytest.approx(8, rel=0.2) and 0.3 < least <= 0.5


def test_accepted_keeps_clean_rows_and_columns(labelled, odd, empty):
    docs, _, rows, _ = labelled
    model = langid.learn(docs)
    out = langid.accepted(docs, model)
    assert out.schema.simpleString() == docs.schema.simpleString()
    assert {r["doc_id"] for r in out.collect()} >= set(range(600)) and out.filter("doc_id in (1000, 1001, 1002)").isEmpty()
    assert langid.accepted(empty, model).collect() == []
    nothing = langid.learn(empty)
    assert {r["lang_pred"] for r in langid.identify(odd, nothing).collect()} == {"und"}


def test_unlearned_languages_and_gibberish_are_rejected(labelled):
    docs, _, rows, truth = labelled
    rng = random.Random(4)
    foreign = [" ".join("".join(rng.choices(letters, k=rng.randint(3, 9))) for _ in range(rng.randint(5, 60)))
               for letters in ("абвгдежзиклмноп", "的一是不了人我在有他这", "αβγδεζηθικλμ", "bcdfghjklmnpqrstvwxz") for _ in range(50)]
    for some in (["en", "de", "fr"], ["en", "fr"], ["de"]):
        learned = docs.filter(F.col("lang").isin(some))
        model = langid.learn(learned, learnable=remainder(F.col("doc_id")) != 2)
        assert model.languages == sorted(some) and model.predict(pa.array(foreign))[2].all()
        clean = [t for i, t, lang, _ in rows if i in truth and lang in some and zlib.crc32(str(i).encode()) % 4 == 2]
        assert not model.predict(pa.array(clean))[2].any()
    unlearned = [t for i, t, lang, _ in rows if i in truth and lang in ("en", "fr")]
    assert model.predict(pa.array(unlearned))[2].all()


def test_no_floor_without_held_out_texts(make):
    model = langid.learn(make([(i, "the house", "en", "a") for i in range(5)]))
    assert model.floors is None and model.predict(pa.array(["the house", None]))[2].tolist() == [False, True]


def test_samples_are_bounded_in_rows(make, spark):
    rows = [(1, "same", "en", "a")] * 3000 + [(2, f"text {i}", "en", "a") for i in range(300)] + [(i, f"own {i}", "en", "a") for i in range(3, 40)]
    chosen = spark.createDataFrame([(i, 1) for i in range(1, 40)], "doc_id long, label int")
    got = learning.sample_texts(make(rows), chosen, F.col("text"), "few", "label", 50, 3).collect()
    assert len(got) == 50 and {r["doc_id"] for r in got} == set(range(1, 40))
    assert [r["copies"] for r in got if r["doc_id"] == 1] == [3000] and sum(r["copies"] for r in got if r["doc_id"] == 2) == 300
    whole = learning.sample_texts(make(rows), chosen, F.col("text"), "all", "label", 5000, 3).collect()
    assert len(whole) == 338 and sum(r["copies"] for r in whole) == len(rows)


def test_document_counts_above_two_bytes(spark):
    sample = spark.createDataFrame([("abc abc", 1, 70_000), ("abc", 1, 2), ("abc", 0, 5)], "text string, label int, copies long")
    counts = toxicity.document_counts(sample)
    assert counts[1].max() == 70_002 and counts[0].max() == 5


def test_repeated_rows_count_as_often_as_they_occur(labelled, make):
    docs, labels, rows, _ = labelled
    once = toxicity.learn(docs, labels)
    twice = toxicity.learn(docs.unionAll(docs), labels)
    texts = pa.array([t for _, t, _, _ in rows[:50]])
    assert np.allclose(once.scores(texts), twice.scores(texts), atol=0.05)


def test_no_task_ranks_a_whole_label(spark):
    """Rows that reach a ranking: the bound and those with the last one's first bits, above Spark's own limit for rank filters too."""
    rows = spark.range(200_000).select(F.col("id").alias("doc_id"), (F.col("id") % 50 == 0).cast("int").alias("label"), F.xxhash64("id").alias("hash"))
    for bound in (300, 5_000, 20_000):
        few = learning.least(rows, ["label"], "hash", bound).groupBy("label").count().collect()
        assert all(min(bound, 4_000 if r["label"] else 196_000) <= r["count"] <= bound + 5 for r in few)
        picked = learning.pick(rows.drop("hash"), "label", bound, 3)
        got = {(r["label"], r["doc_id"]) for r in picked.collect()}
        order = F.xxhash64(F.lit(3), "doc_id")
        keyed = [(r["label"], r["o"] % (1 << 64), r["doc_id"]) for r in rows.withColumn("o", order).select("label", "o", "doc_id").collect()]
        want = {(label, i) for label in (0, 1) for _, _, i in sorted(k for k in keyed if k[0] == label)[:bound]}
        assert got == want


def test_equal_hashes_stay_together(spark):
    rows = spark.createDataFrame([("a", h) for h in [5] * 40 + [-1] * 10 + [1 << 50]] + [("b", 7)], "label string, hash long")
    assert learning.least(rows, ["label"], "hash", 10).groupBy("label").count().collect() in ([("a", 40), ("b", 1)], [("b", 1), ("a", 40)])


def test_an_id_under_two_languages_teaches_each_its_own_text(make):
    docs = make([(1, "the house", "en", "a"), (1, "das haus", "de", "a"), (2, "the water", "en", "a"), (2, "ohne", None, "a")])
    chosen = docs.select("doc_id", F.col("lang").alias("label")).filter("label is not null").distinct()
    got = learning.sample_texts(docs.select("doc_id", "text", "lang"), chosen, F.col("text"), "two", "label", 10, 3, own=F.col("lang")).collect()
    assert sorted((r["doc_id"], r["label"], r["text"]) for r in got) == [(1, "de", "das haus"), (1, "en", "the house"), (2, "en", "the water")]


@pytest.mark.parametrize("size, least", [("sf0.001", 0.9), ("sf0.01", 0.97)])
def test_languages_of_real_texts(spark, size, least):
    docs = spark.read.parquet(f"/root/testdata/{size}/documents.parquet")
    model = langid.learn(docs, learnable=remainder(F.col("doc_id")) != 2)
    got = langid.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").withColumn("held", remainder(F.col("doc_id")) == 2).collect()
    held = [r for r in got if r["held"] and r["lang"] is not None]
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) >= least
    for lang in {r["lang"] for r in got if r["lang"] is not None}:
        own = [r for r in got if r["lang"] == lang]
        assert sum(r["rejected"] for r in own) <= max(1, 0.01 * len(own))


def test_one_pass_sums_equal_plain_sums():
    rng = np.random.default_rng(8)
    model = langid.Model(["x", "y"], rng.normal(size=(2, 1 << langid.BITS)).astype(np.float32), np.zeros(2), usual=rng.normal(size=(2, 1 << langid.BITS)).astype(np.float32))
    texts = pa.array(["the house is red", "", None, "x", "12", "ab cd", "日本 語", "a" * 40])
    language = np.array([0, 1, 0, 1, 0, 1, 0, 1])
    mean, count = model.averages(texts)
    usual, _ = model.familiarity(texts, language)
    for k in range(len(texts)):
        ids = np.concatenate([b[f[k]:e[k]][u[f[k]:e[k]]] for b, u, f, e in langid.subwords(texts)])
        assert count[k] == len(ids)
        if len(ids):
            assert np.allclose(mean[k], model.logits[:, ids].mean(axis=1)) and np.isclose(usual[k], model.usual[language[k], ids].mean())


def test_a_step_follows_the_gradient():
    """The batch step of the softmax: the loss's slope by differences."""
    rng = np.random.default_rng(2)
    vectors, weights, constant = rng.normal(size=(9, 3)), rng.normal(size=(3, 4)), rng.normal(size=4)
    ids, labels = rng.integers(0, 9, (5, 6)), rng.integers(0, 4, 5)

    def loss(w):
        return -np.log(langid.softmax(vectors[ids].mean(axis=1) @ w + constant)[np.arange(5), labels]).sum()

    wrong = langid.softmax(vectors[ids].mean(axis=1) @ weights + constant)
    wrong[np.arange(5), labels] -= 1
    slope = vectors[ids].mean(axis=1).T @ wrong
    for at in np.ndindex(3, 4):
        step = np.zeros((3, 4))
        step[at] = 1e-6
        assert (loss(weights + step) - loss(weights - step)) / 2e-6 == pytest.approx(slope[at], abs=1e-4)


def test_toxicity_equals_a_plain_model(make, spark):
    """Counts, ratios, chosen features, fit and score, each done again by dictionaries and plain gradient steps."""
    rng = random.Random(12)
    rows = []
    for i in range(80):
        bad = i % 4 == 0
        rows.append((i, " ".join(rng.choices(["good", "mild", "calm", "tree"], k=8) + ["nasty", "vile"] * bad), "en", "a"))
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(80)], "doc_id long, toxic int")
    model = toxicity.learn(make(rows), labels)

    def grams(text):
        padded = "".join(c if c.isalpha() else " " for c in text)
        return {padded[i:i + n] for n in toxicity.ORDERS for i in range(len(padded) - n + 1)}

    def bucket(gram):
        codes = np.array([ord(c) for c in gram], np.uint32)
        return int(dict(ngrams.hashes(codes, (len(gram),), toxicity.BITS))[len(gram)][0])

    sets = [{bucket(g) for g in grams(t)} for _, t, _, _ in rows]
    y = np.array([i % 4 == 0 for i in range(80)], float)
    ratio = {}
    for b in set().union(*sets):
        n = [sum(b in s for s, v in zip(sets, y) if v == k) for k in (0, 1)]
        ratio[b] = np.log((n[1] + 1) / (20 + 2)) - np.log((n[0] + 1) / (60 + 2))
    used = sorted(b for b in ratio if model.feature[b] >= 0)
    # The surest ones are features; n-grams that are nowhere count as seen once.
    assert len(used) > 50 and {b for b, r in ratio.items() if abs(r) > 1} <= set(used)
    x = np.array([[ratio[b] * (b in s) for b in used] for s in sets])
    w, c = np.zeros(len(used)), float(np.log(0.25 / 0.75))
    step = 1 / (0.5 * np.linalg.norm(x.T @ x / 80, 2) + toxicity.PENALTY + 0.5)
    for _ in range(20_000):
        p = 1 / (1 + np.exp(-(x @ w + c)))
        w, c = w - step * (x.T @ (p - y) / 80 + toxicity.PENALTY * w), c - step * (p - y).mean()
    want = 1 / (1 + np.exp(-(x @ w + c)))
    assert np.allclose(model.scores(pa.array([t for _, t, _, _ in rows])), want, atol=0.03)


def test_toxicity_of_odd_rows(odd, odd_rows, labelled):
    _, labels, *_ = labelled
    got = toxicity.score(odd, toxicity.learn(odd, labels)).collect()
    assert len(got) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in got)


def test_language_of_odd_rows(odd, odd_rows):
    model = langid.learn(odd)
    got = langid.identify(odd, model).collect()
    assert len(got) == len(odd_rows)
    letters = {i: any(c.isalpha() for c in t or "") for i, t, _, _ in odd_rows if i is not None}
    assert all((r["lang_pred"] == "und") == (not letters[r["doc_id"]]) for r in got if r["doc_id"] is not None)
