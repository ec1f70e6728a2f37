"""Token ids of whole texts, by the tokenizers library.

Vocabularies of this kind never merge across the blank before a word or around a line
break. So a text is cut there, each distinct part goes through the tokenizer once per
worker, and the ids of a text are put together from its parts. Where the cut could
differ from the tokenizer's own (two white spaces side by side, or the text of a special
token), the whole text goes through the tokenizer.

A vocabulary that folds case and drops white space needs no such cut: its words are found
by tables of characters in all bytes of many texts at once, and each distinct word goes
through the vocabulary's model. Runs with a character outside the tables go through the tokenizer.
"""

from __future__ import annotations

import functools
import json
import os
import re
from array import array
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from plotwise.llm.common import buffers

#: Bytes that an encoder may remember, by estimate (of words twice that); then it starts anew. A part's text, number and ids; a word's text and list.
MEMORY, PART_BYTES, WORD_BYTES = 64 << 20, 180, 220

#: Bytes of text to encode at once.
ENCODED_BYTES = 1 << 20

_LOADED: dict[tuple, "Parts"] = {}

CUT, BLANK = "\x00", "\u0120"
#: Found in no text.
NEVER = r"$."
#: White space next to white space, or a character that marks cuts.
UNSAFE = r"[\s\x0b\x1c-\x1f\x{85}\pZ][\s\x0b\x1c-\x1f\x{85}\pZ]|\x00"

# How the two kinds of vocabulary file normalise and split, as the files state it, and
# the same splitting for the code points below U+0180 (without U+0130), where letters and digits are these.
LETTER, DIGIT, SPACE = "A-Za-zªµºÀ-ÖØ-öø-ſ", "0-9²³¹¼½¾", "\\t-\\r \x85\xa0"
ALIEN = re.compile("[^\\x00-ſ]|İ")
FOREIGN = re.compile("[^\\t-\\r -~¡-ſ]|İ|[\\x0b\\x0c]")  # what the tables of words leave out
ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
WORD_LEVEL = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": ENDINGS + r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    BYTE_LEVEL | {"use_regex": False}]}
FOLDED = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLITS = {
    json.dumps([None, BYTE_LEVEL], sort_keys=True): re.compile(
        f"{ENDINGS}| ?[{LETTER}]+| ?[{DIGIT}]+| ?[^{SPACE}{LETTER}{DIGIT}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+").findall,
}
FOLDING = json.dumps([FOLDED, WORD_LEVEL], sort_keys=True)

# Kinds of characters.
BLANKS, LETTERS, DIGITS, OTHERS, FOREIGNERS = range(5)


@functools.cache
def word_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Kind and lower case of each byte, and of the two bytes (as one number) of each character up to U+017F."""
    kind, low = np.full(256, FOREIGNERS, np.uint8), np.arange(256, dtype=np.uint8)
    kind2, low2 = np.full(1 << 16, FOREIGNERS, np.uint8), np.arange(1 << 16, dtype=np.uint16)
    letter, digit = re.compile(f"[{LETTER}]").match, re.compile(f"[{DIGIT}]").match
    for c in map(chr, range(0x180)):
        of = BLANKS if c in "\t\n\r " else FOREIGNERS if FOREIGN.match(c) else LETTERS if letter(c) else DIGITS if digit(c) else OTHERS
        code = int.from_bytes(c.encode())
        if of == FOREIGNERS:
            continue
        (kind if c.isascii() else kind2)[code] = of
        (low if c.isascii() else low2)[code] = int.from_bytes(c.lower().encode())
    return kind, low, kind2, low2


def folded_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Offsets of each text's words, and the words of all texts in lower case, as ``WORD_LEVEL`` splits them.

    Characters outside the tables are not split from what stands beside them, nor put in lower case.
    """
    at, raw = buffers(texts)
    kinds, lows, kinds2, lows2 = word_tables()
    kind, low = kinds[raw], lows[raw]
    second = np.flatnonzero(raw >= 0x80)
    if len(second):
        first = second[(raw[second] >= 0xC2) & (raw[second] <= 0xC5)]
        code = raw[first].astype(np.uint16) << 8 | raw[first + 1]
        kind[first] = kind[first + 1] = kinds2[code]
        folded = lows2[code]
        low[first], low[first + 1] = folded >> 8, folded & 0xFF
        second = first + 1
    before = np.concatenate([[np.uint8(BLANKS)], kind[:-1]])
    before[at[:-1][at[:-1] < len(raw)]] = BLANKS
    real = kind != BLANKS
    begin = real & ((kind != before) | (kind == DIGITS))
    begin[second] = False
    split_endings(begin, low, at)
    if (kind == FOREIGNERS).any():  # runs between blanks that hold such a character are words as they are
        run = real & (before == BLANKS)
        number = np.cumsum(run)
        odd = np.zeros(int(number[-1]) + 1, bool)
        odd[number[kind == FOREIGNERS]] = True
        inside = odd[number] & real
        begin[inside], low[inside] = run[inside], raw[inside]
    starts = np.flatnonzero(begin)
    place = np.cumsum(real, dtype=np.int32)
    ends = np.append(place[starts] - 1, place[-1] if len(place) else 0).astype(np.int32)
    words = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(low[real])])
    return np.searchsorted(starts, at), words


def split_endings(begin: np.ndarray, low: np.ndarray, at: np.ndarray) -> None:
    """Where an apostrophe begins a word and 's or the like follows, the word is that."""
    quote = np.flatnonzero((low == ord("'")) & begin)
    if not len(quote):
        return
    end = at[np.searchsorted(at, quote, side="right")]  # of the text
    next_ = np.concatenate([low, np.zeros(2, np.uint8)])
    a, b = next_[quote + 1], next_[quote + 2]
    for size in (2, 3):
        fits = np.zeros(len(quote), bool)
        for ending in ENDINGS.split("|"):
            if len(ending) == size:
                fits |= (a == ord(ending[1])) & (True if size == 2 else b == ord(ending[2]))
        fits &= quote + size <= end
        begin[quote[fits] + 1] = False
        rest = quote[fits & (quote + size < end)] + size
        begin[rest] = ~np.isin(low[rest], list(b"\t\n\r "))


def byte_letters() -> dict[int, int]:
    """Byte-level vocabularies write a byte as its Latin-1 character if that prints, else from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = (b for b in range(256) if b not in set(plain))
    return dict(zip(plain, plain, strict=True)) | {b: 256 + i for i, b in enumerate(rest)}


def encoder(path: str, special: bool = True) -> "Encoder":
    """The worker's encoder of a vocabulary file; ``special`` tells whether a text may hold special tokens."""
    if (path, special) not in _LOADED:
        _LOADED[path, special] = Encoder(path, special)
    return _LOADED[path, special]


def piece_encoder(path: str) -> "PieceEncoder":
    """The worker's encoder of a sentencepiece model."""
    if (path,) not in _LOADED:
        _LOADED[path,] = PieceEncoder(path)
    return _LOADED[path,]


class Parts:
    """Ids of texts, put together from parts that are encoded once. Used in a ``with`` block, it forgets them at its end."""

    unsafe, memory = UNSAFE, MEMORY

    def __enter__(self):
        return self

    def __exit__(self, *_) -> None:
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.starts = np.zeros(1024, np.int64)
        self.sizes = np.zeros(1024, np.int32)
        self.ids = np.zeros(4096, np.uint32)
        self.used = self.cost = 0

    def plain(self, texts: list[str]) -> list[list[int]]:
        """Ids of whole texts, by the library alone."""
        raise NotImplementedError

    def ids_of(self, parts: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def sizes_and_ids(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.ids_of(parts)
        sizes = np.fromiter(map(len, found), np.int32, len(found))
        return sizes, np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum()))

    def learn(self, parts: list[str]) -> None:
        sizes, ids = self.sizes_and_ids(parts)
        first = len(self.known)
        while first + len(parts) > len(self.starts):
            self.starts, self.sizes = (np.concatenate([a, np.zeros_like(a)]) for a in (self.starts, self.sizes))
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.starts[first:first + len(parts)] = self.used + np.cumsum(sizes) - sizes
        self.sizes[first:first + len(parts)] = sizes
        self.ids[self.used:self.used + len(ids)] = ids
        self.used += len(ids)
        self.known.update(zip(parts, range(first, first + len(parts)), strict=True))
        self.cost += PART_BYTES * len(parts) + sum(map(len, parts)) + 4 * len(ids)

    def by_parts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        cut = pc.replace_substring(texts, " ", CUT + " ")
        cut = pc.replace_substring(cut, "\n", CUT + "\n" + CUT)
        parts = pc.split_pattern(cut, CUT)
        bounds = np.asarray(parts.offsets, dtype=np.int64)
        return self.put_together(bounds - bounds[0], parts.flatten())

    def put_together(self, bounds: np.ndarray, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Offsets of each text's ids, and all ids, from the texts' parts."""
        coded = parts.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.known.get, distinct))
        new = [p for p, at in zip(distinct, found, strict=True) if at is None]
        if new:
            if self.cost > self.memory:
                self.forget()
                new = distinct
            self.learn(new)
            first = len(self.known) - len(new)
            late = iter(range(first, len(self.known)))
            found = list(late) if new is distinct else [next(late) if at is None else at for at in found]
        places = np.array(found, np.int64)
        part = places[np.asarray(coded.indices)]
        sizes = self.sizes[part].astype(np.int64)
        ends = np.cumsum(sizes)
        ids = self.ids[np.repeat(self.starts[part] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]
        ends = np.concatenate([[0], ends])
        return ends[bounds], ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Offsets of each text's ids, and all ids (uint32); null texts have none."""
        texts = texts.cast(pa.string()).fill_null("")
        whole = np.asarray(pc.match_substring_regex(texts, self.unsafe))
        if not whole.any():
            return self.by_parts(texts)
        rare = [np.array(x, np.uint32) for x in self.plain(texts.filter(pa.array(whole)).to_pylist())]
        bounds, ids = self.by_parts(texts.filter(pa.array(~whole)))
        rest = iter(np.split(ids, bounds[1:-1]))
        rare = iter(rare)
        each = [next(rare) if w else next(rest) for w in whole]
        return np.concatenate([[0], np.cumsum([len(x) for x in each])]).astype(np.int64), np.concatenate(each)


class Encoder(Parts):
    """A vocabulary of the tokenizers library."""

    def __init__(self, path: str, special: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        kind = json.loads(self.tokenizer.to_str())
        kind = json.dumps([kind["normalizer"], kind["pre_tokenizer"]], sort_keys=True)
        self.words, self.folds = SPLITS.get(kind), kind == FOLDING
        self.memory = 2 * MEMORY if self.folds else MEMORY
        self.byte, self.model = byte_letters(), self.tokenizer.model.tokenize
        if special:
            names = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
            self.unsafe = "|".join([NEVER if self.folds else UNSAFE, *("\\Q" + s + "\\E" for s in names)])
        else:
            self.tokenizer.encode_special_tokens = True
            self.unsafe = NEVER if self.folds else UNSAFE
        self.forget()

    def forget(self) -> None:
        super().forget()
        self.known_words: dict[str, list[int]] = {}

    def token_bytes(self) -> list[bytes]:
        """The bytes that each id stands for, in a byte-level vocabulary."""
        letters = {chr(letter): byte for byte, letter in self.byte.items()}
        names = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        return [bytes(letters[c] for c in name) if all(c in letters for c in name) else name.encode() for name in names]

    def plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def ids_of(self, parts: list[str]) -> list[list[int]]:
        """Ids of parts. Where the vocabulary's own splitting is known, only its model runs, once per word."""
        if self.words is None:
            return self.plain(parts)
        out: list[list[int]] = []
        late: list[tuple[int, str]] = []
        add, known, alien, one = out.append, self.known_words, ALIEN.search, self.one
        for part in parts:
            plain = part.isascii()
            if not plain and alien(part):
                late.append((len(out), part))
                add([])
                continue
            if (part[1:] if part[:1] == " " else part).isalpha():  # a word by itself
                add(known.get(part) or one(part, plain))
                continue
            ids: list[int] = []
            for word in self.words(part):
                got = known.get(word)
                if got is None:
                    got = known[word] = one(word, plain)
                    self.cost += WORD_BYTES + len(word)
                ids += got
            add(ids)
        for (place, _), ids in zip(late, self.plain([p for _, p in late]) if late else [], strict=True):
            out[place] = ids
        return out

    def by_parts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return self.put_together(*folded_words(texts)) if self.folds else super().by_parts(texts)

    def sizes_and_ids(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Of words that are in lower case, or hold a foreign character."""
        if not self.folds:
            return super().sizes_and_ids(parts)
        model, foreign, byte, id_of = self.model, FOREIGN.search, self.byte, attrgetter("id")
        odd = [w for w in parts if not (w.isascii() and w.isprintable()) and foreign(w)]
        late = dict(zip(odd, self.plain(odd) if odd else [], strict=True))
        sizes, out = array("i"), array("I")
        for word in parts:
            if word.isascii() and word.isprintable():
                got = model(word)
            elif word in late:
                sizes.append(len(late[word]))
                out.extend(late[word])
                continue
            else:
                got = model(word.encode().decode("latin-1").translate(byte))
            sizes.append(len(got))
            out.extend(map(id_of, got))
        return np.array(sizes, np.int32), np.array(out, np.uint32)

    def one(self, word: str, plain: bool) -> list[int]:
        """Ids of one word, as the vocabulary's model sees it."""
        if plain and word.isprintable():
            word = word.replace(" ", BLANK)
        else:
            word = word.encode().decode("latin-1").translate(self.byte)
        return [t.id for t in self.model(word)]


class PieceEncoder(Parts):
    """A sentencepiece model that adds a blank before a text and keeps all white space.

    No piece goes on over a blank or holds a line break, so parts can be encoded by themselves:
    behind a line break, where no blank is added. Other models encode whole texts.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        self.model = SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.head, self.unsafe = self.model.encode("\n", num_threads=1), UNSAFE + "|\u2581"  # a blank by its other name
        if len(self.head) != 2 or any("\u2581" in p.lstrip("\u2581") or "\n" in p for p in pieces):
            self.unsafe = ""  # found in every text
        self.forget()

    def token_bytes(self) -> list[bytes]:
        model = self.model
        names = [(i, model.id_to_piece(i)) for i in range(model.get_piece_size())]
        return [bytes([int(name[3:5], 16)]) if model.is_byte(i) else name.replace("\u2581", " ").encode() for i, name in names]

    def plain(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts that begin with the blank which the model itself adds."""
        return self.model.encode([t[1:] if t[:1] == " " else t for t in texts], num_threads=1)

    def ids_of(self, parts: list[str]) -> list[list[int]]:
        skip = len(self.head)
        return [ids[skip:] for ids in self.model.encode(["\n" + p for p in parts], num_threads=1)]
