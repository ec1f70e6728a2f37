import hashlib
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from plotwise.llm import merkle
from plotwise.llm.queries import QUERIES

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i:i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def path(levels, i):
    out = []
    for level in levels[:-1]:
        run = i // 3 * 3
        out.append((i - run, [x for j, x in enumerate(level[run:run + 3]) if j != i - run]))
        i //= 3
    return out


def plain(rows):
    """Proofs by trees built whole."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[name] = climb([leaf(r) for r in groups[name]])
    top = climb([trees[name][-1][0] for name in names])
    out = []
    for k, name in enumerate(names):
        for i, r in enumerate(groups[name]):
            steps = path(trees[name], i) + path(top, k)
            even = zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 2 == 0
            text = r[4].replace("\n", "") if even and r[4] is not None else r[4]
            value = leaf((*r[:4], text))
            for at, others in steps:
                value = h("".join([*others[:at], value, *others[at:]]))
            proof = h("".join(x for _, others in steps for x in others))
            out.append((r[0], leaf(r), trees[name][-1][0], top[-1][0], proof, value, value == top[-1][0]))
    return Counter(out)


def run(docs):
    touched = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 2 == 0
    found = {"text": F.when(touched, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))}
    rows = merkle.manifest(docs, FIELDS, found=found).collect()
    return Counter((r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"], r["verified"]) for r in rows)


def rows_of(docs):
    return [tuple(r) for r in docs.select(*FIELDS).collect()]


def test_odd_rows(odd):
    assert run(odd) == plain(rows_of(odd))


def test_empty_table(empty):
    assert run(empty) == Counter()


def test_one_row_and_one_group(make):
    one = make([(5, "a\nb", "en", None)])
    assert run(one) == plain(rows_of(one))
    many = make([(i, f"text {i}\n", "en", "a") for i in range(28)])
    assert run(many) == plain(rows_of(many))


def test_far_ids_and_many_groups(make):
    ids = [-(1 << 63), -5000, -1, 0, 1, 63, 64, 4095, 4096, 1 << 24, 1 << 40, (1 << 63) - 1]
    docs = make([(i, f"t{i}\nx", "en", s) for i in ids for s in (None, "", "é", "z", "\U0001f600", *map(str, range(7)))])
    assert run(docs) == plain(rows_of(docs))


def test_repeats_longer_than_a_block(make):
    rows = [(7, "same\ntext", "en", "a")] * 7000 + [(7, f"other {i}", "en", "a") for i in range(300)] + [(i, "x\n", "en", "b") for i in range(50)]
    docs = make(rows)
    assert run(docs) == plain(rows_of(docs))


def test_more_than_one_step(make):
    docs = make([(3 * i, f"t\n{i}", None, "a") for i in range(7000)] + [(i, "y", None, "b") for i in range(10)])
    assert run(docs) == plain(rows_of(docs))


def test_query_on_whole_table(spark):
    got = QUERIES["op12_merkle"](spark, "/root/testdata/sf0.01")
    want = plain(rows_of(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")))
    assert Counter(tuple(r) for r in got.collect()) == want
