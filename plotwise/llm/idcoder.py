"""A range coder of ids with adaptive context mixing, for blocks that stand on their own.

A block's ids are laid out in lanes that are coded in lockstep: in each step, every lane
codes its next id with the model that all earlier steps of the block have trained. So both
directions work on whole arrays, and the decoder repeats the coder's model exactly.

The model: order 2 (a hash of the two ids before) and order 1 (the id before) each predict
one id, with a confidence that grows when it was right; order 0 is a distribution over all
ids seen in the block. The three are mixed by weights that are learned for each pair of
confidences: weight 2 on the order-2 id, weight 1 on the order-1 id, the rest times the
order-0 distribution. An id is coded in the first of the three that holds it.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

#: Ids of a block, and its lanes at most; blocks reset everything.
BLOCK_IDS = 1 << 20
LANES = 4096

STATE = np.uint64((1 << 48) - 1)   # the coder's state has 48 bits
SETTLED = np.uint64(1 << 32)       # below this difference the top 16 bits are final
LEAST = np.uint64(1 << 31)         # range below which bits are forced out
MIX_BITS, ID_BITS = 10, 18         # precision of the mixing weights and of order 0
BITS = MIX_BITS + ID_BITS
HASH_BITS = 20
TOP_CONFIDENCE = 15
HEAD = struct.Struct("<4sIIIIII")  # mark, ids, lanes, alphabet, words, crc of the ids, crc of the rest
MARK = b"IDB1"

#: What is added to a confidence, by 16 * hit + confidence.
CHANGE = np.array([-((c + 1) >> 1) for c in range(TOP_CONFIDENCE + 1)] + [1] * TOP_CONFIDENCE + [0], np.int32)


class Model:
    """Predictions of all lanes for their next ids. ``grid`` holds the ids of the steps so far."""

    def __init__(self, alphabet: int, grid: np.ndarray):
        self.alphabet, self.grid = alphabet, grid
        self.step = self.counted = 0
        self.seen = np.zeros(alphabet, np.int64)
        # A predicted id and its confidence share a number: id * 16 + confidence.
        self.table1 = np.zeros(alphabet, np.int32)
        self.table2 = np.zeros(1 << HASH_BITS, np.int32)
        self.votes = np.ones((TOP_CONFIDENCE + 1) ** 2 * 3, np.int64)
        # Ids are at hand as places too, as arrays are read faster by those.
        self.last = self.before = np.zeros(grid.shape[1], np.int32)
        self.last_at = np.zeros(grid.shape[1], np.intp)
        self.refresh_ids()
        self.refresh_mix()

    def refresh_ids(self) -> None:
        """Order 0: every id keeps one slot, the others follow the counts."""
        self.seen += np.bincount(self.grid[self.counted:self.step].ravel(), minlength=self.alphabet)
        self.counted = self.step
        free = (1 << ID_BITS) - self.alphabet
        size = 1 + self.seen * free // max(1, int(self.seen.sum()))
        size[0] += (1 << ID_BITS) - int(size.sum())
        self.size0 = size.astype(np.uint64)
        self.start0 = np.cumsum(self.size0) - self.size0
        self.slots = None

    def id_at(self, slot: np.ndarray) -> np.ndarray:
        if self.slots is None:
            self.slots = np.repeat(np.arange(self.alphabet, dtype=np.int32), self.size0.astype(np.int64))
        return self.slots.take(slot)

    def refresh_mix(self) -> None:
        votes = self.votes.reshape(-1, 3)
        sizes = 1 + votes * ((1 << MIX_BITS) - 3) // votes.sum(axis=1, keepdims=True)
        sizes[:, 2] += (1 << MIX_BITS) - sizes.sum(axis=1)
        self.weight = sizes.ravel().astype(np.uint64)
        self.start = (np.cumsum(sizes, axis=1) - sizes).ravel().astype(np.uint64) << np.uint64(ID_BITS)
        self.size = self.weight << np.uint64(ID_BITS)
        self.first = self.start.view(np.int64)

    def predict(self) -> None:
        self.at2 = ((self.before.view(np.uint32) * np.uint32(0x9E3779B1) ^ self.last.view(np.uint32) * np.uint32(0x85EBCA6B))
                    >> np.uint32(32 - HASH_BITS)).astype(np.intp)
        self.had2, self.had1 = self.table2.take(self.at2), self.table1.take(self.last_at)
        self.id2, self.id1 = self.had2 >> 4, self.had1 >> 4
        self.sure2, self.sure1 = self.had2 & 15, self.had1 & 15
        self.context = (((self.sure2 << 4) + self.sure1) * 3).astype(np.intp)

    def learn(self, ids: np.ndarray, ids_at: np.ndarray, at: np.ndarray) -> None:
        """The ids of this step, and the places of their votes."""
        fresh = ids << 4 | 1
        for table, where, had, id_, sure in ((self.table2, self.at2, self.had2, self.id2, self.sure2),
                                             (self.table1, self.last_at, self.had1, self.id1, self.sure1)):
            case = sure + ((id_ == ids).view(np.int8) << np.int8(4))
            had += CHANGE.take(case)
            np.copyto(had, fresh, where=case == 0)
            table[where] = had
        self.votes += 4 * np.bincount(at, minlength=len(self.votes))
        self.before, self.last, self.last_at = self.last, ids, ids_at
        self.grid[self.step] = ids
        self.step += 1
        if self.step < 8 or self.step % 4 == 0:
            self.refresh_mix()
        if self.step & (self.step - 1) == 0 or self.step % 32 == 0:
            self.refresh_ids()


def layout(n: int, lanes: int) -> tuple[int, int]:
    """Lanes and steps of a block; short blocks have fewer lanes, so that the model gets to learn."""
    lanes = max(1, min(lanes, n // 64))
    return lanes, -(-n // lanes)


def quotient(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whole quotients by floating point: exact below 2^28 for ``a`` below 2^48 and ``b`` from 1 to 2^20, as others are 2^-20 off a whole number."""
    return (a.view(np.int64) / b.view(np.int64)).astype(np.int64)


class Coder:
    """The state of all lanes."""

    def __init__(self, lanes: int):
        self.low, self.range = np.zeros(lanes, np.uint64), np.full(lanes, STATE)

    def narrow(self, unit: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        low, width = self.low, self.range
        start *= unit
        low += start
        np.multiply(unit, size, out=width)
        rows, part, wide = None, low, width
        while True:
            settled = part + wide
            settled ^= part
            settled = settled < SETTLED
            pick = np.flatnonzero(settled | (wide < LEAST))
            if not len(pick):
                return
            rows = pick if rows is None else rows.take(pick)
            settled, part, wide = settled.take(pick), part.take(pick), wide.take(pick)
            self.shift(rows, part)
            wide = np.where(settled, wide, -part & (LEAST - np.uint64(1))) << np.uint64(16)
            part = (part << np.uint64(16)) & STATE
            width[rows], low[rows] = wide, part


class Encoder(Coder):
    def __init__(self, lanes: int):
        super().__init__(lanes)
        self.words: list[np.ndarray] = []
        self.owners: list[np.ndarray] = []

    def shift(self, pick: np.ndarray, low: np.ndarray) -> None:
        self.words.append((low >> np.uint64(32)).astype("<u2"))
        self.owners.append(pick.astype(np.uint16))

    def finish(self) -> tuple[np.ndarray, np.ndarray]:
        """The lanes' words one lane after another, and how many each has."""
        every = np.arange(len(self.low))
        for by in (32, 16, 0):
            self.words.append(((self.low >> np.uint64(by)) & np.uint64(0xFFFF)).astype("<u2"))
            self.owners.append(every.astype(np.uint16))
        words, owners = np.concatenate(self.words), np.concatenate(self.owners)
        return words[np.argsort(owners, kind="stable")], np.bincount(owners, minlength=len(every))


class Decoder(Coder):
    def __init__(self, words: np.ndarray, counts: np.ndarray):
        super().__init__(len(counts))
        self.words = words.astype(np.uint64)
        at = np.cumsum(counts) - counts
        self.value = (self.words[at] << np.uint64(32)) | (self.words[at + 1] << np.uint64(16)) | self.words[at + 2]
        self.next = at + 3

    def shift(self, pick: np.ndarray, low: np.ndarray) -> None:
        at = self.next.take(pick)
        self.value[pick] = ((self.value.take(pick) << np.uint64(16)) & STATE) | self.words.take(at)
        self.next[pick] = at + 1

    def slot(self) -> tuple[np.ndarray, np.ndarray]:
        unit = self.range >> np.uint64(BITS)
        return unit, np.minimum(quotient(self.value - self.low, unit), (1 << BITS) - 1)


def encode_block(ids: np.ndarray, lanes: int = LANES) -> bytes:
    """One block: head, words per lane, words. Ids are below 2^17."""
    n, alphabet = len(ids), int(ids.max()) + 1
    if alphabet > 1 << (ID_BITS - 1):
        raise ValueError(f"ids must be below {1 << (ID_BITS - 1)}")
    lanes, steps = layout(n, lanes)
    flat = np.zeros(lanes * steps, np.int32)
    flat[:n] = ids
    rows = np.ascontiguousarray(flat.reshape(lanes, steps).T)
    model, coder = Model(alphabet, np.empty_like(rows)), Encoder(lanes)
    for row in rows:
        model.predict()
        row_at, missed = row.astype(np.intp), row != model.id2
        new = missed & (row != model.id1)
        at = model.context + missed
        at += new
        start, size = model.start.take(at), model.size.take(at)
        rest = np.flatnonzero(new)
        weight, ids_at = model.weight.take(at.take(rest)), row_at.take(rest)
        start[rest] += weight * model.start0.take(ids_at)
        size[rest] = weight * model.size0.take(ids_at)
        coder.narrow(coder.range >> np.uint64(BITS), start, size)
        model.learn(row, row_at, at)
    words, counts = coder.finish()
    body = counts.astype("<u4").tobytes() + words.tobytes()
    return HEAD.pack(MARK, n, lanes, alphabet, len(words), zlib.crc32(ids.astype("<u4").tobytes()), zlib.crc32(body)) + body


def block_size(head: bytes) -> int:
    """Bytes of the block that begins with this head."""
    mark, _, lanes, _, words, _, _ = HEAD.unpack(head)
    if mark != MARK:
        raise ValueError("not a block of ids")
    return HEAD.size + 4 * lanes + 2 * words


def decode_block(block: bytes) -> np.ndarray:
    """The ids of a block; raises ValueError if either checksum differs."""
    _, n, lanes, alphabet, _, crc_ids, crc_body = HEAD.unpack_from(block)
    if zlib.crc32(block[HEAD.size:]) != crc_body:
        raise ValueError("a block is damaged")
    counts = np.frombuffer(block, "<u4", lanes, HEAD.size).astype(np.int64)
    words = np.frombuffer(block, "<u2", -1, HEAD.size + 4 * lanes)
    steps = -(-n // lanes)
    grid = np.zeros((steps, lanes), np.int32)
    model, coder = Model(alphabet, grid), Decoder(words, counts)
    for _ in range(steps):
        model.predict()
        unit, value = coder.slot()
        missed = value >= model.first.take(model.context + 1)
        new = value >= model.first.take(model.context + 2)
        at = model.context + missed
        at += new
        start, size = model.start.take(at), model.size.take(at)
        row = np.where(missed, model.id1, model.id2)
        rest = np.flatnonzero(new)
        at_rest = at.take(rest)
        weight = model.weight.take(at_rest)
        found = model.id_at(quotient(value.take(rest) - model.first.take(at_rest), weight))
        row[rest] = found
        start[rest] += weight * model.start0.take(found)
        size[rest] = weight * model.size0.take(found)
        coder.narrow(unit, start, size)
        model.learn(row, row.astype(np.intp), at)
    ids = np.ascontiguousarray(grid.T).ravel()[:n].astype(np.uint32)
    if zlib.crc32(ids.astype("<u4").tobytes()) != crc_ids:
        raise ValueError("a block's ids differ from its checksum")
    return ids
