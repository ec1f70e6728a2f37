import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from plotwise.llm import alignment, tokens
from plotwise.llm.queries import QUERIES

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_file(BYTE)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=PIECE)


def spell(both, text):
    """Ids and bytes of a text by both libraries; nothing if they do not spell the text."""
    if not text:
        return None
    a, b = both
    letters = {chr(v): k for k, v in tokens.byte_letters().items()}
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    want = (" " + text).encode()
    return (ids_a, bytes_a, ids_b, bytes_b) if b"".join(bytes_a) == want == b"".join(bytes_b) else None


def spans(ids, parts):
    at, out = 0, []
    for i, p in zip(ids, parts, strict=True):
        out.append((i, at, at + len(p)))
        at += len(p)
    return out


def plain(both, rows):
    found, counts = [], Counter()
    for doc_id, text in rows:
        got = spell(both, text)
        if got is None:
            found.append((doc_id, None, None, [], []))
            continue
        a, b = spans(*got[:2]), spans(*got[2:])
        ends = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, start = [], 0
        for end in ends:
            groups.append(",".join(str(i) for i, _, e in a if start < e <= end) + "|" + ",".join(str(i) for i, _, e in b if start < e <= end))
            start = end
        links = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e]
        counts.update(set(links))
        found.append((doc_id, a, b, groups, links))
    best = defaultdict(int)
    for (i, _), n in counts.items():
        best[i] = max(best[i], n)
    return Counter((doc_id, len(a or ()), len(b or ()), len(groups), len(links), sum(counts[x] == best[x[0]] for x in links),
                    sum(counts[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "")
                   for doc_id, a, b, groups, links in found), counts


def run(docs, **options):
    rows = alignment.alignment(docs, BYTE, PIECE, **options).collect()
    return Counter((r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"]) for r in rows)


TEXTS = ["hello  world\n\n it's", "▁odd", " leading", "trailing ", "<|endoftext|> and <s> </s> <unk>", "　wide  blanks​", "éﬁ\U0001f600 \U0001f468‍\U0001f469",
         "\t\ttabs\r\nand\x0blines", "\x00null", "a" * 500, "日本語のテキスト", "Ünïcödé wörds änd möre"]


def test_against_pairs_of_spans(make, both, odd_rows):
    rows = [(i, t[:2000] if t else t, lang, source) for i, t, lang, source in odd_rows] + [(100 + i, t, "en", "a") for i, t in enumerate(TEXTS)]
    want, counts = plain(both, [r[:2] for r in rows])
    docs = make(rows).coalesce(2)
    assert run(docs, block_bytes=1500) == want
    assert run(docs) == want
    got = {(r["a"], r["b"]): r["documents"] for r in alignment.pair_counts(docs, BYTE, PIECE, block_bytes=1500).collect()}
    assert got == counts


def test_groups(make, both):
    rows = [(i, t, "en", "a") for i, t in enumerate(TEXTS)] + [(90, None, "en", "a"), (91, "", "en", "a")]
    got = defaultdict(list)
    for r in sorted(alignment.groups(make(rows), BYTE, PIECE).collect(), key=lambda r: (r["doc_id"], r["number"])):
        got[r["doc_id"]].append(r)
    for i, text in enumerate(TEXTS):
        parts = spell(both, text)
        if parts is None:
            assert i not in got
            continue
        raw = (" " + text).encode()
        assert [x for r in got[i] for x in r["a"]] == parts[0] and [x for r in got[i] for x in r["b"]] == parts[2]
        assert [r["start"] for r in got[i]] == [0, *[r["end"] for r in got[i][:-1]]] and got[i][-1]["end"] == len(raw)
    assert 90 not in got and 91 not in got


def test_empty_and_long(empty, odd):
    assert run(empty) == Counter()
    assert sum(run(odd).values()) == odd.count()


def test_encoders_equal_the_libraries(both):
    rng = random.Random(3)
    alphabet = ["a", "B", "the", " ", " ", "  ", "\n", "\t", "é", "́", " ", "　", "<s>", "<|endoftext|>", "1", "23", "'s", ".", "▁", "\x00", "日", "\U0001f600", "\r"]
    texts = [" " + "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    for encoder, want in ((tokens.Encoder(BYTE, special=False), lambda t: both[0].encode(t, add_special_tokens=False).ids),
                          (tokens.PieceEncoder(PIECE), lambda t: both[1].encode(t[1:]))):
        bounds, ids = encoder.encode(pa.array(texts))
        for i, text in enumerate(texts):
            assert ids[bounds[i]:bounds[i + 1]].tolist() == want(text), text


def test_query_on_whole_table(spark, both):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want, _ = plain(both, [tuple(r) for r in rows if len(r["text"] or "") < 3000])
    got = Counter(tuple(r) for r in QUERIES["op11_alignment"](spark, "/root/testdata/sf0.001").collect())
    assert sum(got.values()) == len(rows)
    # Counts are of the whole corpus; what a text has by itself is compared for texts short enough for all pairs.
    assert not Counter((*r[:5], r[7]) for r in want.elements()) - Counter((*r[:5], r[7]) for r in got.elements())
