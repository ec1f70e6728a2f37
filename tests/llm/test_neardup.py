import random

import numpy as np
import pyarrow as pa
import pytest

from plotwise.llm import neardup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, size):
    w = (text or "").translate(LOWER).encode().split()
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def expected(rows, size, percent):
    """(set size, smallest id of the component) per row, comparing all pairs."""
    sets = [shingle_set(t, size) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(r[0], least.get(find(i), r[0]))
    return [(len(sets[i]), least.get(find(i))) for i in range(len(rows))]


def check(docs, rows, size, percent):
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["n_shingles"], r["component_id"] or 0, r["kept"])
                  for r in neardup.near_duplicates(docs, size, percent).collect()))
    want = sorted((r[0] is None, r[0] or 0, n, c or 0, r[0] is not None and r[0] == c)
                  for r, (n, c) in zip(rows, expected(rows, size, percent), strict=True))
    assert got == want


@pytest.fixture(scope="module")
def families():
    """Chains of edits, exact copies, and texts near the threshold on both sides."""
    rng = random.Random(11)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(12):
        base = rng.choices(words, k=rng.randint(20, 90))
        text = list(base)
        for _ in range(rng.randint(1, 14)):
            text = list(text if rng.random() < 0.5 else base)
            for _ in range(rng.randint(0, 4)):
                text[rng.randrange(len(text))] = rng.choice(words)
            out = " ".join(text)
            rows += [out if rng.random() < 0.7 else out.upper()] * (1 + (rng.random() < 0.2))
    rows += ["", None, " \n", "one", "ONE", "one two", "one  two", "two one", "é É"]
    rng.shuffle(rows)
    ids = rng.sample(range(-50, 2000), len(rows))
    return [(i, t, "en", "a") for i, t in zip(ids, rows, strict=True)]


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_components_equal_all_pairs(make, families, size, percent):
    check(make(families), families, size, percent)


def test_odd_rows(odd, odd_rows):
    check(odd, odd_rows, 3, 85)


def test_small_blocks_find_the_same(make, families, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 3)
    check(make(families), families, 3, 85)


def test_sketch_agreement_is_concentrated_around_the_similarity():
    rng = np.random.default_rng(12)
    for similarity in (0.3, 0.6, 0.9):
        found = []
        for _ in range(30):
            n = 200
            common = rng.integers(0, 1 << 50, int(n * 2 * similarity / (1 + similarity)), dtype=np.uint64)
            pair = [np.unique(np.concatenate([common, rng.integers(0, 1 << 50, n - len(common), dtype=np.uint64)])) for _ in range(2)]
            keys = np.concatenate([pair[0], pair[1] | np.uint64(1 << neardup.KEY_BITS)])
            marks = neardup.sketches(np.array([0, len(pair[0]), len(keys)]), keys, 120)
            found.append((marks[0] == marks[1]).mean())
        assert abs(np.mean(found) - similarity) < 0.03


def test_every_coordinate_fills_for_any_size():
    for n in (1, 2, 5, 119, 120, 3000):
        keys = np.unique(np.random.default_rng(n).integers(0, 1 << 50, n, dtype=np.uint64))
        whole = neardup.sketches(np.array([0, len(keys)]), keys, 120)
        empty = neardup.sketches(np.array([0, 0]), keys[:0], 120)
        assert whole.shape == (1, 120) and whole.any() and not empty.any()
        if n > 1:  # a subset agrees wherever it holds the smallest value
            part = neardup.sketches(np.array([0, len(keys) - 1]), keys[:-1], 120)
            assert (part == whole).mean() > 0.3


def test_bands():
    for percent in (80, 85, 95):
        b = neardup.bands_for(percent)
        assert (1 - (percent / 100) ** neardup.BAND_ROWS) ** b <= neardup.MISS < (1 - (percent / 100) ** neardup.BAND_ROWS) ** (b - 1)


def test_shingle_keys_are_whole_sets():
    texts = ["a b c d a b c", "A b", "", None, "x", "a\tb\x0bc\x0cd"]
    bounds, keys = neardup.shingles(pa.array(texts), 3)
    assert np.diff(bounds).tolist() == [len(shingle_set(t, 3)) for t in texts]
    assert (np.diff(keys.astype(np.float64)) > 0).all()


def test_components_of_chains(spark):
    rng = random.Random(13)
    links = [(i, i + 1) for i in range(200)] + [(1000 + i, 1000 + rng.randrange(i)) for i in range(1, 150)] + [(5000, 5001), (5001, 5000), (7, 7)]
    links = [x if rng.random() < 0.5 else x[::-1] for x in links]
    rng.shuffle(links)
    got = {r["node"]: r["root"] for r in neardup.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(150)}, 5000: 5000, 5001: 5000}
    assert got == want


def test_deduplicated_keeps_one_row_and_all_columns(make, odd, odd_rows, empty):
    out = neardup.deduplicated(odd, 5, 80)
    assert out.schema.simpleString() == odd.schema.simpleString()
    rows = out.collect()
    texts = [shingle_set(r["text"], 5) for r in rows if shingle_set(r["text"], 5)]
    assert len(texts) == len(set(texts)) and {5, 2, 3, 4}.issubset({r["doc_id"] for r in rows})
    assert neardup.deduplicated(empty).collect() == [] and neardup.near_duplicates(empty).collect() == []
