"""Hashed character n-grams of whole batches of texts, as arrays."""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLANK = 32


@functools.cache
def letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


@functools.cache
def lower() -> np.ndarray:
    """The lower-case code point of each, where that is a single one."""
    out = np.arange(sys.maxunicode + 1, dtype=np.uint32)
    for c in range(sys.maxunicode + 1):
        small = chr(c).lower()
        if len(small) == 1:
            out[c] = ord(small)
    return out


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of each text, and the code points of all texts; null texts are empty."""
    texts = texts.fill_null("")
    sizes = np.asarray(pc.utf8_length(texts)).astype(np.int64)
    joined = "".join(texts.to_numpy(zero_copy_only=False).tolist())
    return np.concatenate([[0], np.cumsum(sizes)]), np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")


def words_of(offsets: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters, with one blank for each run of other characters."""
    letter = letters()[codes]
    codes = np.where(letter, lower()[codes], BLANK).astype(np.uint32)
    keep = letter.copy()
    keep[:1] = True
    keep[1:] |= letter[:-1]
    keep[offsets[:-1][np.diff(offsets) > 0]] = True  # runs end with their text
    kept = np.concatenate([[0], np.cumsum(keep)])
    return kept[offsets], codes[keep]


def hashes(codes: np.ndarray, orders: tuple[int, ...], bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each order, the bucket of the n-gram that begins at each place (as far as one fits)."""
    rolling = np.zeros(len(codes), np.uint32)
    for n in range(1, max(orders) + 1):
        rolling = rolling[:len(codes) - n + 1] * np.uint32(0x01000193) + codes[n - 1:]
        if n in orders:
            mixed = (rolling ^ (rolling >> np.uint32(15))) * np.uint32(0x2C1B3C6D) + np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)
            mixed ^= mixed >> np.uint32(12)
            yield n, (mixed * np.uint32(0x297A2D39)) >> np.uint32(32 - bits)


def places(offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First and end of each text's n-grams among the places of ``hashes``."""
    return offsets[:-1], np.maximum(offsets[:-1], offsets[1:] - n + 1)


def within(values: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between two places of each text."""
    total = np.zeros(len(values) + 1, np.float64)
    np.cumsum(values, out=total[1:])
    return total[np.minimum(end, len(values))] - total[np.minimum(first, len(values))]


def owners(offsets: np.ndarray, n: int, count: int) -> np.ndarray:
    """The text of each place, -1 where an n-gram would run into the next text."""
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:count]
    _, end = places(offsets, n)
    return np.where(np.arange(count) < end[row], row, -1)
