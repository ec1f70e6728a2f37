import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from plotwise.llm import idcoder, idfile, tokens

WORD = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("ids", [[0], [5, 5, 5], [131071, 0, 1], list(range(5000)), [7] * 9000,
                                 np.random.default_rng(1).integers(0, 50_000, 3000), np.random.default_rng(2).zipf(1.3, 70_001) % 49_000])
@pytest.mark.parametrize("lanes", [1, 64, 4096])
def test_blocks_come_back(ids, lanes):
    ids = np.array(ids, np.uint32)
    block = idcoder.encode_block(ids, lanes)
    assert idcoder.block_size(block[:idcoder.HEAD.size]) == len(block)
    assert (idcoder.decode_block(block) == ids).all()


def test_prediction_shortens_repeated_ids():
    ids = np.tile(np.random.default_rng(3).integers(0, 40_000, 50), 2000).astype(np.uint32)
    assert len(idcoder.encode_block(ids)) < len(ids) / 2


def test_damage_is_noticed():
    block = bytearray(idcoder.encode_block(np.arange(1000, dtype=np.uint32)))
    for at in (60, len(block) - 5):
        bad = block.copy()
        bad[at] ^= 1
        with pytest.raises(ValueError):
            idcoder.decode_block(bytes(bad))
    bad = block.copy()
    bad[20] ^= 1  # the checksum of the ids
    with pytest.raises(ValueError):
        idcoder.decode_block(bytes(bad))


def test_ids_above_the_limit_are_refused():
    with pytest.raises(ValueError):
        idcoder.encode_block(np.array([1 << 17], np.uint32))


def expected(rows):
    plain = Tokenizer.from_file(WORD)
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((i, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out, start


@pytest.mark.parametrize("block_ids", [1 << 20, 1000, 7])
def test_round_trip(odd, odd_rows, block_ids):
    rows = [r for r in odd_rows if block_ids > 7 or len(r[1] or "") < 1000]
    docs = odd if block_ids > 7 else odd.filter("length(coalesce(text, '')) < 1000")
    got = sorted(idfile.round_trip(docs, WORD, 2, block_ids=block_ids, lanes=8).collect(), key=lambda r: r["start"])
    want, total = expected([(i, t) for i, t, _, _ in rows])
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    assert at == total
    order = [r["doc_id"] for r in got]
    assert order == [i for i, _, _ in want]
    key = lambda x: (x[0] is not None, *[v or 0 for v in x])
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got), key=key) == sorted(want, key=key)


def test_empty(empty):
    assert idfile.round_trip(empty, WORD, 2).collect() == []


BITS = ["a", "B", "the", "'", "'s", "'RE", "'ll", "'t", "''", "'d1", "'v", " ", "  ", "\n", "\t", "\r\n", "\x0b", "\x1c", "\x00", "\x7f", "\x85",
        "\xa0", "\xad", "\u3000", "é", "É", "Ÿ", "ß", "İ", "ı", "ſ", "ŉ", "ª", "²", "¼", "µ", "1", "23", "...", "-", "<|endoftext|>", "<|end", "e\u0301",
        "\u0301", "I\u0307", "—", "’s", "漢字", "Ω", "😀", "K", "×", "À"]


@pytest.mark.parametrize("special", [True, False])
def test_words_are_those_of_the_library(special):
    rng, plain, encoder = random.Random(7), Tokenizer.from_file(WORD), tokens.encoder(WORD, special)
    plain.encode_special_tokens = not special
    texts = ["x", None, "", *("".join(rng.choice(BITS) for _ in range(rng.randrange(14))) for _ in range(20_000))]
    bounds, ids = encoder.encode(pa.array(texts).slice(1))
    for k, text in enumerate(texts[1:]):
        assert ids[bounds[k]:bounds[k + 1]].tolist() == plain.encode(text or "", add_special_tokens=False).ids, text


def test_a_word_goes_through_the_model_once():
    encoder, seen = tokens.Encoder(WORD), []
    model, encoder.model = encoder.model, lambda word: (seen.append(word), model(word))[1]
    texts = pa.array(["The tree, the TREE. (tree)  Él\n\ntree's", "a tree; él"])
    first, again = encoder.encode(texts), encoder.encode(texts)
    assert len(seen) == len(set(seen)) == 10 and (first[1] == again[1]).all()


def test_quotients_are_whole():
    rng = np.random.default_rng(6)
    b = rng.integers(1, 1 << 20, 200_000).astype(np.uint64)
    q = rng.integers(0, 1 << 28, len(b)).astype(np.uint64)
    for rest in (np.zeros_like(b), b - np.uint64(1), rng.integers(0, b).astype(np.uint64)):
        assert (idcoder.quotient(q * b + rest, b) == q.astype(np.int64)).all()
