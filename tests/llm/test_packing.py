import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from plotwise.llm import packing, tokens

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_cached_ids_equal_the_tokenizers(path):
    rng = random.Random(1)
    letters = " \n\t'sSdéĞĲİabı,.½0\xa0　ΣςА1|<>\x00\x01"
    texts = ["", None, "a  b\n\n c", "it's 'tis\n'll", "<|endoftext|> x <|startoftext|>", " lead", "trail ", "\n", "ΑΣ ΑΣ.", "a ́b"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    plain = Tokenizer.from_file(path)
    encoder = tokens.Encoder(path)
    for _ in range(2):  # unknown and known parts
        bounds, ids = encoder.encode(pa.array(texts))
        for i, t in enumerate(texts):
            assert ids[bounds[i]:bounds[i + 1]].tolist() == plain.encode(t or "", add_special_tokens=False).ids, t


def test_forgetting_parts_changes_nothing(monkeypatch):
    texts = [f"word{i} common text{i % 7}" for i in range(300)]
    encoder = tokens.Encoder(BYTE)
    want = encoder.encode(pa.array(texts))[1].tolist()
    monkeypatch.setattr(tokens, "MEMORY", 10_000)
    small = tokens.Encoder(BYTE)
    got = [small.encode(pa.array(texts[i:i + 20]))[1] for i in range(0, 300, 20)]
    assert np.concatenate(got).tolist() == want


def test_first_fit_decreasing_equals_the_plain_search():
    rng = random.Random(2)
    for _ in range(50):
        lengths = [rng.randint(1, 100) for _ in range(rng.randint(1, 60))]
        bins, offsets, fill = packing.first_fit_decreasing(lengths, 100)
        room = []
        for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
            at = next((b for b, r in enumerate(room) if r >= lengths[i]), len(room))
            if at == len(room):
                room.append(100)
            assert (bins[i], offsets[i]) == (at, 100 - room[at])
            room[at] -= lengths[i]
        assert fill == [100 - r for r in room]


def check_pieces(rows, texts, size=1024):
    plain = Tokenizer.from_file(BYTE)
    by_row, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_row[r["row_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert len(by_row) == len(texts)
    want = sorted(((i is None, i or 0), [*plain.encode(t or "", add_special_tokens=False).ids, 0]) for i, t in texts)
    got = []
    for parts in by_row.values():
        parts.sort(key=lambda r: r["start"])
        at = 0
        for r in parts:
            assert r["start"] == at and 1 <= r["length"] <= size
            at += r["length"]
        assert at == parts[0]["doc_tokens"]
        got.append(((parts[0]["doc_id"] is None, parts[0]["doc_id"] or 0), parts))
    # Rows of one id and as many ids may come in any order: each must be one of the texts that are left.
    left = defaultdict(list)
    for i, ids in want:
        left[i, len(ids)].append(np.array(ids, "<u4"))
    for i, parts in got:
        texts_of = left[i, parts[0]["doc_tokens"]]
        fits = [all(zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes()) == r["ids_crc32"] for r in parts) for ids in texts_of]
        assert any(fits)
        texts_of.pop(fits.index(True))
    assert not any(left.values())
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= size and {r["sequence_tokens"] for r in parts} == {at}


def test_pack_documents(odd, odd_rows):
    rows = packing.pack_documents(odd, BYTE, group_rows=16).collect()
    check_pieces(rows, [(i, t) for i, t, _, _ in odd_rows])


def test_one_document_with_most_rows(make):
    rows = [(7, f"a text of some words, number {i % 3}", "en", "a") for i in range(300)]
    check_pieces(packing.pack_documents(make(rows), BYTE, group_rows=64).collect(), [(i, t) for i, t, _, _ in rows])


def test_sequences_hold_their_pieces(make):
    docs = make([(i, "some words here " * (i % 9), "en", "a") for i in range(40)])
    placed = packing.pack(packing.pieces(docs, BYTE, size=64, with_ids=True).cache(), size=64)
    placed.cache()
    pieces = placed.collect()
    for r in packing.sequences(placed, pad_id=9, size=64).collect():
        fill = r["sequence_tokens"]
        assert len(r["ids"]) == (fill if fill & (fill - 1) == 0 else 64)
        for p in pieces:
            if p["sequence_id"] == r["sequence_id"]:
                assert r["ids"][p["offset"]:p["offset"] + p["length"]] == p["ids"]


def test_empty(empty):
    assert packing.pack_documents(empty, BYTE).collect() == []
