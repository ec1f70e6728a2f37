import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from plotwise.llm import queries, secrets

WANT = [(r.kind, re.compile(r.pattern), r.least) for r in secrets.RULES]


def expected(text):
    spans = []
    for order, (kind, pattern, least) in enumerate(WANT):
        spans += [(m.start(), order, m.end(), kind) for m in pattern.finditer(text or "") if len(m[2]) >= least]
    return sorted(spans)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    parts = ["token", "=", " ", ":", "'", '"', "secret", "PassWord", "api_key", "apikey", "a1b2c3d4e5f6", "0123456789abcdef" * 2, "AKIA", "ABCDEFGHIJKLMNOP",
             "short", "é", "\n", "\x01", "\x02", "\x03", "ghp_", "A" * 40, "xoxb-", "1234-abcd-5678", "AIza", "x" * 36, "eyJabc.eyJdef." + "z" * 40,
             "-----BEGIN RSA PRIVATE KEY-----", "ſecret=abcdefgh", "toKen=abcdefgh", "secret=token:abcdefgh", "$1", "\\"]
    out = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(400)]
    return out + [None, "", "token = abcde", "x" * 50_000 + " password: abcdef", " ".join(["0123456789abcdef01234567"] * 300)]


def test_spans_equal_the_expressions(make, texts):
    docs = make([(i, t, "en", "a") for i, t in enumerate(texts)])
    for block_rows in (4096, 16):
        got = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in secrets.scan(docs, block_rows=block_rows).collect()}
        for i, t in enumerate(texts):
            assert got[i] == expected(t), (t or "")[:200]


def test_rows_that_share_an_id(make):
    docs = make([(1, "token=abcdefgh", "en", "a"), (1, "nothing", "en", "a"), (None, "secret: hijklmno", "en", "a"), (None, None, None, None)] * 3)
    got = sorted((str(r["doc_id"]), len(r["spans"])) for r in secrets.scan(docs).collect())
    assert got == sorted([("1", 1), ("1", 0), ("None", 1), ("None", 0)] * 3)


def test_queries_of_trigrams():
    q = secrets.trigram_query
    assert q("AKIA[A-Z0-9]+") == [[frozenset({"aki", "kia"})]]
    assert q("[0-9a-f]+") == [] and q("ab") == [] and q("a.*b") == []
    assert q("abc.*def") == [[frozenset({"abc"})], [frozenset({"def"})]]
    assert {frozenset({"abc", "bcd"}), frozenset({"abd"})} == set(q("ab(c?)d")[0])
    assert set(q("(foo|bar)x")[0]) == {frozenset({"foo", "oox"}), frozenset({"bar", "arx"})}
    assert q("(abc|d.*)e") == [] and q("(?:abcd)+")[0] == [frozenset({"abc", "bcd"})]


def test_queries_are_necessary(texts):
    for rule in secrets.RULES:
        query = secrets.trigram_query(rule.pattern)
        for t in texts:
            for m in re.finditer(rule.pattern, t or ""):
                low = m[0].lower()
                assert all(any(all(g in low for g in all_) for all_ in any_) for any_ in query)


def test_index_narrows_candidates(make):
    docs = make([(i, "plain words only" if i % 10 else "my token = abcdefgh", "en", "a") for i in range(100)])
    rows, wanted = secrets.with_candidates(docs, secrets.RULES, "doc_id", "text", 16)
    assert rows.filter(wanted[0]).count() == 10 and rows.filter(wanted[2]).count() == 100


def test_redaction(make, texts, odd, empty):
    docs = make([(i, t, "en", "a") for i, t in enumerate(texts)])
    out = secrets.redacted(docs)
    assert out.schema.simpleString() == docs.schema.simpleString()
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    for i, t in enumerate(texts):
        if t is None:
            assert got[i] is None
            continue
        hidden = [False] * len(t)
        for _, pattern, least in WANT:
            for m in pattern.finditer(t):
                if len(m[2]) >= least:
                    hidden[m.start(2):m.end(2)] = [True] * len(m[2])
        assert "".join(c for c, h in zip(t, hidden) if not h) == got[i].replace("[REDACTED]", "")
        assert ("[REDACTED]" in got[i]) == any(hidden)
    assert secrets.redacted(odd).exceptAll(odd).isEmpty()
    assert secrets.redacted(empty).collect() == [] and secrets.scan(empty).collect() == []


def test_query_columns(make, texts, tmp_path, spark):
    make([(i, t, "en", "a") for i, t in enumerate(texts)]).write.parquet(f"{tmp_path}/documents.parquet")
    for r in queries.QUERIES["op2_secrets"](spark, str(tmp_path)).collect():
        spans = expected(texts[r["doc_id"]])
        base = ",".join(f"{k}:{a}:{b}" for a, o, b, k in spans if o < 3)
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(o == k for _, o, _, _ in spans) for k in range(3)]
        assert r["spans"] == ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)


def test_no_python_in_the_plan(make, capsys):
    secrets.scan(make([(1, "token=abcdefgh", "en", "a")])).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan
