"""Packing of documents into training sequences.

Documents are turned into ids and cut into pieces of at most ``size``; the pieces are dealt
at random into groups of about ``group_rows``, and each group is packed on its own by
first-fit decreasing. A tournament tree over the bins' free room finds the first bin that
a piece fits into in logarithmic time.

Null texts count as empty: such a document is its end id alone. Rows that repeat are packed
as often as they occur; a null id stays null. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotwise.llm import tokens
from plotwise.llm.common import columns, records, ship, slices
from plotwise.session import staged

#: Rows that a group has on average; groups grow in number, not in size.
GROUP_ROWS = 8192

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, row_id long"
PLACED = PIECE + ", sequence_id long, offset long, sequence_tokens long"


def pieces(docs: DataFrame, vocabulary: str, end_id: int = 0, size: int = 1024, with_ids: bool = False,
           id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Ids of each document and its end id, cut every ``size`` ids.

    ``row_id`` tells rows apart that share an id. With ``with_ids`` the ids come along as ``ids``.
    """
    ship(docs.sparkSession)
    layout = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "row_id")]
                       + [("ids", pa.list_(pa.int64()))] * with_ids)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tokens.encoder(vocabulary) as encoder:
            for batch in slices(batches, limit=tokens.ENCODED_BYTES):
                bounds, ids = encoder.encode(batch.column("text"))
                ids = np.insert(ids, bounds[1:], end_id).astype("<u4")
                bounds = bounds + np.arange(len(bounds))
                counts = np.diff(bounds)
                per = -(-counts // size)
                row = np.repeat(np.arange(len(per)), per)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per)) * size
                length = np.minimum(size, counts[row] - start)
                first = bounds[row] + start
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(first.tolist(), (first + length).tolist(), strict=True)]
                out = {"doc_id": batch.column("doc_id").take(pa.array(row)), "start": start, "length": length, "ids_crc32": crc,
                       "doc_tokens": counts[row], "row_id": batch.column("row_id").take(pa.array(row))}
                if with_ids:
                    out["ids"] = pa.ListArray.from_arrays(np.append(first, len(ids)).astype(np.int32), ids.astype(np.int64))
                yield records(out, layout)

    rows = columns(docs, doc_id=docs[id_column].cast("long"), text=docs[text_column].cast("string"),
                   row_id=F.monotonically_increasing_id())
    return rows.mapInArrow(cut, PIECE + ", ids array<long>" * with_ids)


class Room:
    """Free room of bins in a tournament tree: each inner place holds the larger of its two children."""

    def __init__(self, bins: int, size: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.most = [size] * (2 * self.leaves)

    def first(self, need: int) -> int:
        """The first bin with that much room."""
        most, at = self.most, 1
        while at < self.leaves:
            at *= 2
            at += most[at] < need
        return at - self.leaves

    def take(self, which: int, need: int) -> int:
        """Fill a bin; returns the room that it had."""
        most, at = self.most, which + self.leaves
        had = most[at]
        most[at] = had - need
        while at > 1:
            at //= 2
            best = max(most[2 * at], most[2 * at + 1])
            if most[at] == best:
                break
            most[at] = best
        return had


def first_fit_decreasing(lengths: list[int], size: int) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each item (longest first, ties in the given order), and each bin's fill."""
    room = Room(len(lengths), size)
    bins, offsets = [0] * len(lengths), [0] * len(lengths)
    used = 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        b = room.first(lengths[i])
        bins[i], offsets[i] = b, size - room.take(b, lengths[i])
        used = max(used, b + 1)
    return bins, offsets, [size - r for r in room.most[room.leaves:room.leaves + used]]


def pack(cut: DataFrame, size: int = 1024, group_rows: int = GROUP_ROWS, seed: int = 7) -> DataFrame:
    """Place pieces into sequences of at most ``size`` ids.

    ``cut`` has ``row_id``, ``start`` and ``length``, and is read twice (see ``staged``). Adds ``sequence_id``,
    ``offset`` and ``sequence_tokens``.
    """
    ship(cut.sparkSession)
    groups = max(1, -(-cut.count() // group_rows))

    def place(key: tuple, table: pa.Table) -> pa.Table:
        table = table.drop_columns("pack_group").sort_by([("row_id", "ascending"), ("start", "ascending")])
        bins, offsets, fill = first_fit_decreasing(table.column("length").to_pylist(), size)
        bins = np.array(bins, np.int64)
        table = table.append_column("sequence_id", pa.array((key[0].as_py() << 32) + bins))
        table = table.append_column("offset", pa.array(offsets, pa.int64()))
        return table.append_column("sequence_tokens", pa.array(np.array(fill, np.int64)[bins]))

    group = F.pmod(F.xxhash64("row_id", "start", F.lit(seed)), F.lit(groups))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)
    return (cut.withColumn("pack_group", group).groupBy("pack_group")
            .applyInArrow(place, f"{schema}, sequence_id long, offset long, sequence_tokens long"))


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int = 0, size: int = 1024, with_ids: bool = False,
                   group_rows: int = GROUP_ROWS, seed: int = 7, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Pieces of all documents with their places in sequences."""
    cut = pieces(docs, vocabulary, end_id, size, with_ids, id_column, text_column)
    return pack(staged(cut, "pieces"), size, group_rows, seed)


def sequences(placed: DataFrame, pad_id: int = 0, size: int = 1024) -> DataFrame:
    """One row per sequence with its ids, padded to ``size`` unless its fill is a power of two.

    ``placed`` carries ``ids``. A sequence has at most ``size`` pieces.
    """
    parts = F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])
    fill = F.first("sequence_tokens")
    pad = F.when(F.expr("(first(sequence_tokens) & (first(sequence_tokens) - 1)) = 0"), 0).otherwise(F.lit(size) - fill)
    return placed.groupBy("sequence_id").agg(
        F.concat(F.flatten(parts), F.array_repeat(F.lit(pad_id).cast("long"), pad.cast("int"))).alias("ids"),
        fill.alias("sequence_tokens"))
