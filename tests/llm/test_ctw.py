import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from plotwise.llm import ctw
from plotwise.llm.common import remainder
from plotwise.llm.queries import QUERIES


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def symbols(text, order):
    raw = bytes([255] * order) + text.encode() + b"\xff"
    return [(raw[i:i + order], raw[i + order]) for i in range(len(raw) - order)]


class Plain:
    """A context tree by recursion over contexts, node by node."""

    def __init__(self, texts, order):
        self.order, self.counts, self.children = order, defaultdict(lambda: [0, 0]), defaultdict(set)
        for text in texts:
            for context, byte in symbols(text, order):
                for d in range(order + 1):
                    own = context[order - d:]
                    if d:
                        self.children[own[1:]].add(own)
                    for b in range(8):
                        self.counts[own, b, byte >> (8 - b)][(byte >> (7 - b)) & 1] += 1
        self.known = {}

    def kt(self, key):
        a, b = self.counts.get(key, (0, 0))
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weight(self, context, b, prefix):
        key = context, b, prefix
        if key not in self.counts:
            return 0.0
        if key not in self.known:
            own = self.kt(key)
            if len(context) < self.order:
                own = math.log(.5) + self.plus(own, self.below(*key))
            self.known[key] = own
        return self.known[key]

    def below(self, context, b, prefix):
        return sum(self.weight(c, b, prefix) for c in self.children[context])

    @staticmethod
    def plus(x, y):
        return max(x, y) + math.log1p(math.exp(-abs(x - y)))

    def chance(self, context, b, prefix, bit, depth=0):
        own = context[len(context) - depth:]
        n = self.counts.get((own, b, prefix), (0, 0))
        here = (n[bit] + .5) / (sum(n) + 1)
        if depth == self.order:
            return here
        stop = 1 / (1 + math.exp(min(700, self.below(own, b, prefix) - self.kt((own, b, prefix)))))
        return stop * here + (1 - stop) * self.chance(context, b, prefix, bit, depth + 1)

    def score(self, text):
        return sum(math.log10(self.chance(c, b, byte >> (8 - b), (byte >> (7 - b)) & 1)) for c, byte in symbols(text, self.order) for b in range(8))


def learned(doc_id):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 7 != 2


def check(docs, rows, order, **options):
    rows = [(i, lowered(t)) for i, t in rows]
    train = [t for i, t in rows if learned(i)]
    model = Plain(train, order)
    counts = Counter(w for t in train for w in [*words(t), None])
    total, kinds = sum(counts.values()), len(counts)
    want = []
    for i, t in rows:
        tokens = [*words(t), None]
        base = sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in tokens)
        want.append((i is None, i or 0, len(tokens), sum(counts[w] > 0 for w in tokens), total, base, model.score(t)))
    got = ctw.score(docs, remainder(F.col("doc_id"), 7) != 2, order=order, **options).collect()
    got = [(r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got]
    for g, w in zip(sorted(got), sorted(want), strict=True):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-4, abs=1e-6)


def test_against_recursion(make, odd_rows):
    rows = [(i, t[:3000] if t else t, a, b) for i, t, a, b in odd_rows]
    check(make(rows), [r[:2] for r in rows], 4, block_bytes=2000)


@pytest.mark.parametrize("order", [0, 1, 3])
def test_other_orders(make, order):
    rows = [(i, f"The {'cat' if i % 3 else 'Dog'} sat on mat {i}\n", "en", "a") for i in range(30)]
    check(make(rows), [r[:2] for r in rows], order, block_bytes=100)


def test_whole_long_text(odd, odd_rows):
    got = {(r["doc_id"], r["n_tokens"]) for r in ctw.score(odd, F.lit(True)).collect()}
    assert got == {(i, len(words(t or "")) + 1) for i, t, _, _ in odd_rows}


def test_empty_and_nothing_learned(make, empty):
    assert ctw.score(empty, F.lit(True)).collect() == []
    r = ctw.score(make([(1, "ab", "en", "a")]), F.lit(False)).first()
    assert (r["n_known"], r["train_tokens"], r["base_score"]) == (0, 0, 0.0)
    assert r["bits_per_byte"] == pytest.approx(8)


def test_probabilities_of_a_byte_sum_to_one(make):
    model = Plain(["abcabcabd", "abx"], 2)
    assert sum(math.prod(model.chance(b"ab", b, x >> (8 - b), (x >> (7 - b)) & 1) for b in range(8)) for x in range(256)) == pytest.approx(1)


def test_query_learns_the_text(spark):
    rows = QUERIES["op13_lm_scores"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 1000 and sum(r["held_out"] for r in rows) > 100
    rate = {h: sum(r["bits_per_byte"] for r in rows if r["held_out"] == h) / sum(r["held_out"] == h for r in rows) for h in (True, False)}
    assert rate[False] < rate[True] < 3
