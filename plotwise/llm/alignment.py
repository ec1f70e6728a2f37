"""Alignment of two tokenizers' tokens over the same bytes, and corpus counts of aligned ids.

Both tokenizers see a blank and the text. Inside a task everything is Arrow: the lists of ids
are flattened with the row that each id belongs to, their byte ends are segmented cumulative
sums, and an Acero hash join on (document, end) brings both sides' ends together. In the order
of the ends, the tokens that cover an end are a link: so every pair of tokens whose bytes overlap is found
once. Ends of both sides close a group. ``Table.group_by`` counts a block's pairs of ids, in how
many of its documents each occurs, and Spark merges these partial counts.

Corpus counts come back by block: a block of about ``BLOCK_BYTES`` of text asks for its own pairs
only, and its documents name them by their place in the block. The largest count of each id of
the first tokenizer is a table with a row per id of its vocabulary, and is broadcast.

Null and empty texts, and those whose tokens' bytes are not the blank and the text, have no tokens:
zeros and an empty digest. Repeated rows are documents each. A text is never cut, so a task holds
the tokens of its longest text. An empty table has no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plotwise.llm import tokens
from plotwise.llm.common import columns, records, ship, slices
from plotwise.session import staged

BLOCK_BYTES, SLICE_BYTES = 8 << 20, 1 << 20
#: Documents' ends are keys of one number: the document, then this many bits of the end.
END_BITS = 40

ROWS = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                  ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("steps", pa.list_(pa.int32())), ("uses", pa.list_(pa.int32())),
                  ("place", pa.int32()), ("a", pa.int32()), ("b", pa.int32()), ("documents", pa.int64())])
SCHEMA = ("block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, steps array<int>, uses array<int>, "
          "place int, a int, b int, documents long")


class Side:
    """A tokenizer with its ids' bytes, and their numbers as texts with each separator behind."""

    def __init__(self, encoder: tokens.Parts, separators: tuple[str, ...]):
        names = encoder.token_bytes()
        self.encoder, self.bytes, self.size = encoder, pa.array(names, pa.binary()), len(names)
        self.lengths = pa.array([len(n) for n in names], pa.int64())
        self.names = [f"{i}{s}" for s in separators for i in range(len(names))]


class Pair:
    """Two tokenizers over the same texts."""

    def __init__(self, a: tokens.Parts, b: tokens.Parts):
        self.a, self.b = Side(a, (",", "|")), Side(b, (",", ";", ""))
        self.names = pa.array(self.a.names + self.b.names)

    def lists(self, spaced: pa.Array) -> tuple[np.ndarray, list[pa.ListArray]]:
        """Which texts both sides spell byte by byte, and both lists of ids of these."""
        found, same = [], np.ones(len(spaced), bool)
        for side in (self.a, self.b):
            bounds, ids = side.encoder.encode(spaced)
            offsets = pa.array(bounds, pa.int32())
            spelled = pc.binary_join(pa.ListArray.from_arrays(offsets, side.bytes.take(pa.array(ids))), b"")
            same &= np.asarray(pc.equal(spelled, spaced.cast(pa.binary())))
            found.append(pa.ListArray.from_arrays(offsets, pa.array(ids, pa.uint32())))
        return same, [x.filter(pa.array(same)) for x in found]

    def align(self, spaced: pa.Array) -> tuple[np.ndarray, "Links"]:
        same, lists = self.lists(spaced)
        return same, Links(self, lists)


class Links:
    """The ends of both sides' tokens in order, with the token of either side that covers each."""

    def __init__(self, pair: Pair, lists: list[pa.ListArray]):
        self.pair, self.count = pair, len(lists[0])
        self.ids = [np.asarray(x.flatten()) for x in lists]
        self.sizes = [np.asarray(pc.list_value_length(x)).astype(np.int64) for x in lists]
        tables = []
        for side, x, name in zip((pair.a, pair.b), lists, "ab", strict=True):
            parent = pc.list_parent_indices(x).cast(pa.int64())
            total = np.asarray(pc.cumulative_sum(side.lengths.take(x.flatten())))
            offsets = np.asarray(x.offsets, np.int64) - x.offsets[0].as_py()
            done = np.concatenate([[0], total])[offsets[:-1]]
            ends = total - done[np.asarray(parent)]
            key = np.asarray(parent) << END_BITS | ends
            tables.append(pa.table({"key": key, name: np.arange(len(key), dtype=np.int64)}))
        joined = tables[0].join(tables[1], "key", join_type="full outer", use_threads=False).sort_by("key")
        key = joined.column("key").to_numpy()
        a, b = joined.column("a").combine_chunks(), joined.column("b").combine_chunks()
        self.document, self.end = key >> END_BITS, key & ((1 << END_BITS) - 1)
        self.ends_a, self.ends_b = np.asarray(a.is_valid()), np.asarray(b.is_valid())
        self.both = self.ends_a & self.ends_b
        # A document's last end is one of both sides, so no fill crosses documents.
        self.a, self.b = (np.asarray(pc.fill_null_backward(x)).astype(np.int64) for x in (a, b))

    def per_document(self, flags: np.ndarray) -> np.ndarray:
        return np.bincount(self.document[flags], minlength=self.count)

    def digests(self) -> list[str]:
        """Digest of each document's groups, written out."""
        if not self.count:
            return []
        group = np.cumsum(self.both) - self.both
        group_a, group_b = group[self.ends_a], group[self.ends_b]
        groups = int(self.both.sum())
        a_before = np.concatenate([[0], np.cumsum(np.bincount(group_a, minlength=groups))])
        b_before = np.concatenate([[0], np.cumsum(np.bincount(group_b, minlength=groups))])
        last = np.zeros(len(self.ids[1]), bool)
        last[np.cumsum(self.sizes[1]) - 1] = True
        n_a, n_b = self.pair.a.size, self.pair.b.size
        name = np.zeros(len(self.ids[0]) + len(self.ids[1]), np.int64)
        name[np.arange(len(group_a)) + b_before[group_a]] = self.ids[0] + np.where(self.both[self.ends_a], n_a, 0)
        name[np.arange(len(group_b)) + a_before[group_b + 1]] = 2 * n_a + self.ids[1] + np.where(last, 2 * n_b, np.where(self.both[self.ends_b], n_b, 0))
        offsets = np.concatenate([[0], np.cumsum(self.sizes[0] + self.sizes[1])]).astype(np.int32)
        written = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), self.pair.names.take(pa.array(name))), "")
        return [hashlib.sha256(x.as_buffer()).hexdigest() for x in written]

    def pairs(self) -> pa.Table:
        """Rows (document, pair, links): the pairs of ids of each document, ``pair`` holding both."""
        pair = self.ids[0][self.a].astype(np.int64) * self.pair.b.size + self.ids[1][self.b]
        return pa.table({"document": self.document, "pair": pair}).group_by(["document", "pair"], use_threads=False).aggregate(
            [([], "count_all")]).rename_columns(["document", "pair", "links"])


class Block:
    """Aligned documents until about ``BLOCK_BYTES`` of text."""

    def __init__(self, number: int, pair: Pair):
        self.number, self.pair, self.bytes, self.rows = number, pair, 0, 0
        self.documents: list[dict[str, object]] = []
        self.pairs: list[pa.Table] = []

    def add(self, doc_ids: pa.Array, texts: pa.Array) -> None:
        spaced = pc.binary_join_element_wise(" ", texts, "")
        has = np.asarray(pc.not_equal(pc.binary_length(texts), 0))
        same, links = self.pair.align(spaced.filter(pa.array(has)))
        where = np.flatnonzero(has)[same]
        out = {name: np.zeros(len(texts), np.int64) for name in ("n_a", "n_b", "n_groups", "n_links")}
        out["n_a"][where], out["n_b"][where] = links.sizes
        out["n_groups"][where] = links.per_document(links.both)
        out["n_links"][where] = links.per_document(slice(None))
        digests = np.full(len(texts), "", object)
        digests[where] = links.digests()
        self.documents.append({"doc_id": doc_ids, "groups_sha256": digests, **out})
        found = links.pairs()
        self.pairs.append(found.set_column(0, "document", pa.array(where[found.column("document").to_numpy()] + self.rows)))
        self.rows += len(texts)
        self.bytes += spaced.nbytes

    def close(self) -> Iterator[pa.RecordBatch]:
        found = pa.concat_tables(self.pairs)
        counts = found.group_by("pair", use_threads=False).aggregate([([], "count_all")]).sort_by("pair")
        kinds = counts.column("pair").combine_chunks()
        place = pc.index_in(found.column("pair").combine_chunks(), value_set=kinds).to_numpy()
        document, links = found.column("document").to_numpy(), found.column("links").to_numpy()
        order = np.argsort(document * (len(kinds) + 1) + place)
        document, place, links = document[order], place[order].astype(np.int64), links[order]
        bounds = np.searchsorted(document, np.arange(self.rows + 1))
        steps = np.diff(place, prepend=0)
        starts = bounds[:-1][np.diff(bounds) > 0]
        steps[starts] = place[starts]
        at = 0
        for part in self.documents:
            count = len(part["doc_id"])
            own = bounds[at:at + count + 1]
            lists = [pa.ListArray.from_arrays(pa.array(own - own[0], pa.int32()), pa.array(x[own[0]:own[-1]], pa.int32())) for x in (steps, links)]
            yield rows(count, block=np.full(count, self.number), steps=lists[0], uses=lists[1], **part)
            at += count
        kinds = kinds.to_numpy()
        yield rows(len(kinds), block=np.full(len(kinds), self.number), place=np.arange(len(kinds)),
                   a=kinds // self.pair.b.size, b=kinds % self.pair.b.size, documents=counts.column("count_all"))


def rows(count: int, **known) -> pa.RecordBatch:
    return records({f.name: known.get(f.name, pa.nulls(count, f.type)) for f in ROWS}, ROWS)


_PAIRS: dict[tuple[str, str], Pair] = {}


def pair_of(vocabulary: str, model: str) -> Pair:
    """The worker's pair of tokenizers: a vocabulary file and a sentencepiece model."""
    if (vocabulary, model) not in _PAIRS:
        _PAIRS[vocabulary, model] = Pair(tokens.encoder(vocabulary, special=False), tokens.piece_encoder(model))
    return _PAIRS[vocabulary, model]


def source(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return columns(docs, doc_id=docs[id_column].cast("long"), text=F.coalesce(docs[text_column].cast("string"), F.lit("")))


def aligned(docs: DataFrame, vocabulary: str, model: str, block_bytes: int) -> DataFrame:
    """Documents with their pairs, and each block's pairs with its counts, written down."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_cpu_count(1)
        pair = pair_of(vocabulary, model)
        with pair.a.encoder, pair.b.encoder:
            block = Block(TaskContext.get().partitionId() << 32, pair)
            for batch in slices(batches, "text", min(SLICE_BYTES, block_bytes)):
                if block.bytes >= block_bytes:
                    yield from block.close()
                    block = Block(block.number + 1, pair)
                block.add(batch.column("doc_id"), batch.column("text").cast(pa.string()))
            if block.rows:
                yield from block.close()

    return staged(docs.mapInArrow(align, SCHEMA), "aligned", compression="zstd")


def pair_counts(docs: DataFrame, vocabulary: str, model: str, block_bytes: int = BLOCK_BYTES,
                id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (a, b, documents): linked ids of both tokenizers, and the number of documents that link them."""
    found = aligned(source(ship_docs(docs), id_column, text_column), vocabulary, model, block_bytes)
    return found.filter("a is not null").groupBy("a", "b").agg(F.sum("documents").alias("documents"))


def ship_docs(docs: DataFrame) -> DataFrame:
    ship(docs.sparkSession)
    return docs


def groups(docs: DataFrame, vocabulary: str, model: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (doc_id, number, start, end, a, b): the groups of each document, their bytes (the added blank counts) and ids."""
    layout = pa.schema([("doc_id", pa.int64()), ("number", pa.int64()), ("start", pa.int64()), ("end", pa.int64()),
                        ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))])

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_cpu_count(1)
        pair = pair_of(vocabulary, model)
        with pair.a.encoder, pair.b.encoder:
            for batch in slices(batches, "text", SLICE_BYTES):
                batch = batch.filter(pc.not_equal(pc.binary_length(batch.column("text")), 0))
                same, links = pair.align(pc.binary_join_element_wise(" ", batch.column("text").cast(pa.string()), ""))
                doc_ids = batch.column("doc_id").filter(pa.array(same))
                document, end = links.document[links.both], links.end[links.both]
                first = np.diff(document, prepend=-1) != 0
                lists = []
                for ids, ends in zip(links.ids, (links.ends_a, links.ends_b), strict=True):
                    bounds = np.concatenate([[0], np.cumsum(ends)[links.both]]).astype(np.int32)
                    lists.append(pa.ListArray.from_arrays(pa.array(bounds), pa.array(ids, pa.int32())))
                number = np.arange(len(end)) - np.maximum.accumulate(np.where(first, np.arange(len(end)), 0))
                yield records({"doc_id": doc_ids.take(pa.array(document)), "number": number, "start": np.where(first, 0, np.roll(end, 1)),
                               "end": end, "a": lists[0], "b": lists[1]}, layout)

    rows_in = source(ship_docs(docs), id_column, text_column)
    return rows_in.mapInArrow(spell, "doc_id long, number long, start long, end long, a array<int>, b array<int>")


def alignment(docs: DataFrame, vocabulary: str, model: str, block_bytes: int = BLOCK_BYTES,
              id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: tokens, groups and links, how many links are their first id's commonest, and the sum of the links' counts."""
    found = aligned(source(ship_docs(docs), id_column, text_column), vocabulary, model, block_bytes)
    asked = found.filter("a is not null").select("block", "place", "a", F.sum("documents").over(W.partitionBy("a", "b")).alias("count"))
    asked = staged(asked, "pairs", compression="zstd")
    best = asked.groupBy(F.col("a").alias("of")).agg(F.max("count").alias("most"))  # a row per id of the vocabulary
    asked = asked.join(F.broadcast(best), F.col("a") == F.col("of")).select("block", "place", "count", (F.col("count") == F.col("most")).alias("best"))
    layout = pa.schema([("doc_id", pa.int64()), *[(n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")],
                        ("groups_sha256", pa.string())])

    def total(key: tuple, documents: pa.Table, known: pa.Table) -> pa.Table:
        documents = documents.combine_chunks()
        place = known.column("place").to_numpy()
        count, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        count[place], best[place] = known.column("count").to_numpy(), known.column("best").to_numpy()
        steps, uses = documents.column("steps").combine_chunks(), documents.column("uses").combine_chunks()
        bounds = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(steps)))])
        sums = np.concatenate([[0], np.cumsum(np.asarray(steps.flatten()), dtype=np.int64)])
        at = sums[1:] - np.repeat(sums[bounds[:-1]], np.diff(bounds))
        links = np.asarray(uses.flatten()).astype(np.int64)
        out = {f.name: documents.column(f.name) for f in layout if f.name in documents.column_names}
        for name, values in (("n_best", best), ("count_sum", count)):
            done = np.concatenate([[0], np.cumsum(links * values[at])])
            out[name] = pa.array(done[bounds[1:]] - done[bounds[:-1]], pa.int64())
        return pa.table({f.name: out[f.name] for f in layout}, layout)

    documents = found.filter("n_a is not null").select(F.col("block").alias("of"), "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "steps", "uses")
    return documents.groupBy("of").cogroup(asked.groupBy("block")).applyInArrow(
        total, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
