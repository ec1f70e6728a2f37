"""Near-duplicates by word shingles: similarity sketches, banding, exact verification, components.

A document's sketch has ``t`` coordinates, filled in rounds: in each of the first t rounds,
every shingle is hashed to a random coordinate with a random value; in the t rounds after
that, all shingles go to coordinate 0, 1, ... in turn. A coordinate keeps its smallest
(round, value), and a document stops at the end of the round that fills its last one. So
every coordinate fills, two sketches agree in a coordinate with the probability of their
documents' similarity, and the share of agreeing coordinates is concentrated around it.

Documents with equal sets are one class. Classes that agree in all coordinates of a band
share a bucket, and links are confirmed on the full sets, in two passes:

1. In each bucket, every class is compared with one centre (the class in the fullest buckets).
2. Where a bucket still holds more than one component, the classes outside its largest
   component are compared with the rest of the bucket, by blocks within tasks: sketches
   say which pairs are likely enough, the full sets decide, and a class gives one link to
   each component that it is linked with.

So a large group of near copies costs a comparison per copy, and pairs are never listed for
a whole bucket. With bands for a chance of 1 in a million to miss a pair at the threshold,
and sketches five standard errors below it, no link is lost in practice; nothing is capped.

Null and empty texts have no shingle and link with nothing. A null id counts as the largest
and never is a component's id, unless all its ids are null. Repeated rows are copies of one
another. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plotwise.llm.common import columns, mixed, records, ship, slices, split_words
from plotwise.session import staged

#: Coordinates of a band, and the chance to miss a pair at the threshold.
BAND_ROWS, MISS = 5, 1e-6
#: Classes of a block when sketches are compared within a task.
BLOCK = 512
#: Bytes of text that are signed at once; their shingles take some twenty times as much.
SIGNED_BYTES = 1 << 20
#: Bits of a shingle's hash within its document; the others number the document of a batch.
KEY_BITS = 50
EMPTY = np.uint64((1 << 64) - 1)


def bands_for(percent: int) -> int:
    """Bands that a pair at the threshold misses with the chance ``MISS`` at most."""
    return math.ceil(math.log(MISS) / math.log1p(-((percent / 100) ** BAND_ROWS)))


def least_agreeing(percent: int, coordinates: int) -> int:
    """Agreeing coordinates that a pair at the threshold has, but for five standard errors."""
    s = percent / 100
    return max(0, math.floor(coordinates * s - 5 * math.sqrt(coordinates * s * (1 - s))))


# -- sets and sketches, by batches of texts

def shingles(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of each text's set, and the sets' keys in order: the text's place above ``KEY_BITS`` bits of hash.

    Words are compared with A-Z in lower case; a text of fewer words has them all as its one shingle.
    """
    bounds, words = split_words(pc.ascii_lower(texts.cast(pa.string()).fill_null("")))
    coded = words.dictionary_encode()
    distinct = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct), np.uint64, len(distinct))
    word = each[np.asarray(coded.indices)] if len(words) else np.zeros(0, np.uint64)
    counts = np.diff(bounds)
    owner = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
    windows = max(0, len(word) - size + 1)
    key = np.zeros(windows, np.uint64)
    for i in range(size):
        key = mixed(key + word[i:i + windows])
    inside = owner[:windows] == owner[len(owner) - windows:]
    keys, owners = [key[inside]], [owner[:windows][inside]]
    for n in range(1, size):
        short = np.flatnonzero(counts == n)
        if len(short):
            key = np.full(len(short), n, np.uint64)
            for i in range(n):
                key = mixed(key + word[bounds[short] + i])
            keys.append(key)
            owners.append(short.astype(np.uint64))
    keys, owners = np.concatenate(keys), np.concatenate(owners)
    keys = np.sort((owners << np.uint64(KEY_BITS)) | (keys >> np.uint64(64 - KEY_BITS)))
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    keys = keys[new]
    ends = np.searchsorted(keys >> np.uint64(KEY_BITS), np.arange(len(counts), dtype=np.uint64), side="right")
    return np.concatenate([[0], ends]).astype(np.int64), keys


def sketches(bounds: np.ndarray, keys: np.ndarray, t: int) -> np.ndarray:
    """The sketch of each set, as 16-bit marks of its coordinates; empty sets get zeros."""
    n = len(bounds) - 1
    keys = keys & np.uint64((1 << KEY_BITS) - 1)
    owner = np.repeat(np.arange(n), np.diff(bounds))
    best = np.full(n * t, EMPTY)
    low = np.uint64((1 << 40) - 1)
    for r in range(2 * t):
        if not len(keys):
            break
        y = mixed(keys + np.uint64((r + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        at = ((y >> np.uint64(40)) * np.uint64(t) >> np.uint64(24)).astype(np.int64) if r < t else r - t
        np.minimum.at(best, owner * t + at, (np.uint64(r) << np.uint64(40)) | (y & low))
        some = np.unique(owner)
        open_ = np.zeros(n, bool)
        open_[some[best.reshape(n, t)[some].max(axis=1) == EMPTY]] = True
        keep = open_[owner]
        keys, owner = keys[keep], owner[keep]
    marks = (mixed(best) >> np.uint64(48)).astype("<u2").reshape(n, t)
    marks[np.diff(bounds) == 0] = 0
    return marks


def agreeing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each row of ``a`` and of ``b``, in how many coordinates they agree."""
    out = np.zeros((len(a), len(b)), np.int16)
    for k in range(a.shape[1]):
        out += a[:, k, None] == b[None, :, k]
    return out


def sign(docs: DataFrame, size: int, coordinates: int, id_column: str, text_column: str) -> DataFrame:
    """Set size, digest of the set and sketch of every row, with the row itself; written to the shared folder."""
    extra = {f"own_{i}": c for i, c in enumerate(docs.columns)}
    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].cast("string").alias("text"),
                       F.monotonically_increasing_id().alias("row_id"),
                       *[docs[c].alias(name) for name, c in extra.items() if c not in (id_column, text_column)])

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=SIGNED_BYTES):
            bounds, keys = shingles(batch.column("text"), size)
            marks = sketches(bounds, keys, coordinates)
            raw = memoryview((keys & np.uint64((1 << KEY_BITS) - 1)).tobytes())
            digests = [hashlib.blake2b(raw[8 * a:8 * b], digest_size=16).digest() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            batch = batch.append_column("n", pa.array(np.diff(bounds)))
            batch = batch.append_column("digest", pa.array(digests, pa.binary()))
            yield batch.append_column("sketch", pa.array([m.tobytes() for m in marks], pa.binary()))

    schema = T.StructType(list(rows.schema.fields)).add("n", "long").add("digest", "binary").add("sketch", "binary")
    return staged(rows.mapInArrow(signed, schema), "signed")


# -- links

def confirmed(pairs: DataFrame, signed: DataFrame, size: int, percent: int) -> DataFrame:
    """Those pairs (a, b) of rows whose full sets are similar enough; written to the shared folder."""
    texts = signed.select("row_id", "text")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(iter([batch]), "text_a", rows=2048):
                bounds_a, keys_a = shingles(part.column("text_a"), size)
                bounds_b, keys_b = shingles(part.column("text_b"), size)
                common = np.intersect1d(keys_a, keys_b, assume_unique=True)
                both = np.bincount((common >> np.uint64(KEY_BITS)).astype(np.int64), minlength=part.num_rows)
                either = np.diff(bounds_a) + np.diff(bounds_b) - both
                good = (100 * both >= percent * either) & (either > 0)
                yield part.select(["a", "b"]).filter(pa.array(good))

    joined = pairs.join(texts.withColumnsRenamed({"row_id": "a", "text": "text_a"}), "a").join(
        texts.withColumnsRenamed({"row_id": "b", "text": "text_b"}), "b").select("a", "b", "text_a", "text_b")
    return staged(joined.mapInArrow(check, "a long, b long"), "links")


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every linked node, root being the smallest node of its component.

    Alternates two contractions, each of which ties a node's neighbours to the smallest one:
    first the larger neighbours, then the others. Every step is written down; the number of
    steps grows with the logarithm of the longest chain.
    """
    edges = staged(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = staged(large, "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = large.join(least, "u")
        small = staged(tied.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
                       .unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        # Done when all are stars: a node that is tied to another is tied to that one only, and has none tied to it.
        several = small.groupBy("u").agg(F.count("*").alias("ties")).filter("ties > 1").select("u")
        inner = small.join(small.select(F.col("v").alias("u")), "u", "left_semi").select("u")
        if several.unionByName(inner).isEmpty():
            return small.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                small.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        edges = small


def members_of(classes: DataFrame, bands: int) -> DataFrame:
    """(band, bucket, node, n, held) of every bucket with two classes or more; ``held`` is how many it has."""
    width = 2 * BAND_ROWS
    marks = [F.struct(F.lit(k).alias("band"), F.xxhash64(F.lit(k), F.substring("sketch", 1 + width * k, width)).alias("bucket")) for k in range(bands)]
    rows = classes.select("node", "n", F.explode(F.array(*marks)).alias("mark")).select("node", "n", "mark.band", "mark.bucket")
    held = rows.groupBy("bucket").agg(F.count("*").alias("held")).filter("held > 1")
    return staged(rows.join(held, "bucket"), "members")


def star_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Each class of a bucket with the bucket's centre, where their sizes allow a link."""
    weight = members.groupBy("node").agg(F.sum("held").alias("weight"))
    centre = members.join(weight, "node").groupBy("bucket").agg(F.max(F.struct("weight", -F.col("node"), "n")).alias("best"))
    centre = centre.select("bucket", (-F.col("best.col2")).alias("a"), F.col("best.n").alias("n_a"))
    near = 100 * F.least("n", "n_a") >= percent * F.greatest("n", "n_a")
    return members.join(centre, "bucket").filter(F.col("node") != F.col("a")).filter(near).select("a", F.col("node").alias("b")).distinct()


CELL = ["bucket", "rest_block", "all_block"]


class Cell:
    """Rows of one block of a bucket's outside classes (side 0) and one of all its classes (side 1)."""

    def __init__(self, table: pa.Table, percent: int, coordinates: int):
        self.side, self.node, self.n, self.root = (np.asarray(table.column(c)) for c in ("side", "node", "n", "root"))
        self.outside = np.asarray(table.column("outside").combine_chunks().cast(pa.uint8())).astype(bool)
        self.marks = np.frombuffer(b"".join(table.column("sketch").to_pylist()), "<u2").reshape(len(self.side), coordinates)
        self.band = table.column("band")[0].as_py()
        self.percent, self.least = percent, least_agreeing(percent, coordinates)

    def likely(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (row of side 0, row of side 1) of different components that are worth a look,
        in the first band that they share; pairs of two outside classes once."""
        x, y = np.flatnonzero(self.side == 0), np.flatnonzero(self.side == 1)
        for at in range(0, len(x), 64):
            some = x[at:at + 64]
            good = agreeing(self.marks[some], self.marks[y]) >= self.least
            good &= self.root[some][:, None] != self.root[y]
            good &= 100 * np.minimum(self.n[some][:, None], self.n[y]) >= self.percent * np.maximum(self.n[some][:, None], self.n[y])
            good &= ~self.outside[y] | (self.node[some][:, None] < self.node[y])
            i, j = np.nonzero(good)
            i, j = some[i], y[j]
            shared = (self.marks[i] == self.marks[j]).reshape(len(i), self.marks.shape[1] // BAND_ROWS, BAND_ROWS).all(axis=2)
            first = shared.argmax(axis=1) == self.band
            yield i[first], j[first]


def rest_links(members: DataFrame, roots: DataFrame, classes: DataFrame, signed: DataFrame, size: int, percent: int, coordinates: int) -> DataFrame:
    """Links between components in buckets that the first pass has left with several.

    Blocks of sketches say which classes have a likely partner; the texts of those come to
    the same blocks, where their full sets are compared. A class gives one link to each
    component that it is linked with, so neither likely pairs nor links are listed in full.
    """
    own = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    parts = own.groupBy("bucket", "root").agg(F.count("*").alias("size"))
    open_ = parts.groupBy("bucket").agg(F.max(F.struct("size", "root")).alias("largest"), F.count("*").alias("parts"), F.sum("size").alias("held"))
    open_ = open_.filter("parts > 1").select("bucket", F.col("largest.root").alias("main"), (F.col("held") - F.col("largest.size")).alias("rest"), F.col("held").alias("all"))
    rows = own.drop("held").join(open_, "bucket").join(classes.select("node", "sketch"), "node")
    rows = rows.withColumn("outside", F.col("root") != F.col("main"))
    all_blocks, rest_blocks = F.ceil(F.col("all") / BLOCK).cast("int"), F.ceil(F.col("rest") / BLOCK).cast("int")

    def dealt(side: int, own_blocks, other_blocks, own_name: str, other_name: str):
        at = F.pmod(F.xxhash64("node"), own_blocks).cast("int")
        return [F.lit(side).alias("side"), "band", "bucket", "node", "n", "root", "outside", "sketch", at.alias(own_name),
                F.explode(F.sequence(F.lit(0), other_blocks - 1)).alias(other_name)]

    left = rows.filter("outside").select(dealt(0, rest_blocks, all_blocks, "rest_block", "all_block"))
    right = rows.select(dealt(1, all_blocks, rest_blocks, "all_block", "rest_block"))
    both = left.unionByName(right)

    def involved(table: pa.Table) -> pa.Table:
        found = [np.concatenate(pair) for pair in Cell(table, percent, coordinates).likely()]
        return table.take(pa.array(np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)))

    def linked(table: pa.Table) -> pa.Table:
        cell = Cell(table, percent, coordinates)
        bounds, keys = shingles(table.column("text").combine_chunks(), size)
        keys &= np.uint64((1 << KEY_BITS) - 1)
        out: list[tuple[int, int]] = []
        for some, others in cell.likely():
            for i in np.unique(some):
                j = others[some == i]
                mine = keys[bounds[i]:bounds[i + 1]]
                theirs = np.concatenate([keys[bounds[k]:bounds[k + 1]] for k in j])
                at = np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)
                ends = np.cumsum(cell.n[j])
                common = np.concatenate([[0], np.cumsum(mine[at] == theirs)])
                common = common[ends] - common[ends - cell.n[j]]
                good = j[100 * common >= percent * (cell.n[i] + cell.n[j] - common)]
                _, one = np.unique(cell.root[good], return_index=True)
                out += [(int(cell.node[i]), int(cell.node[k])) for k in good[one]]
        return pa.Table.from_pylist([{"a": a, "b": b} for a, b in out], pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    likely = staged(both.groupBy(CELL).applyInArrow(involved, both.schema), "likely")
    texts = signed.select(F.col("row_id").alias("node"), "text")
    return staged(likely.join(texts, "node").groupBy(CELL).applyInArrow(linked, "a long, b long"), "links")


def resolve(docs: DataFrame, size: int, percent: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """All rows (``own_`` columns, ``doc_id``, ``text``, ``row_id``, ``n``) with ``first``: the id and row of their component."""
    ship(docs.sparkSession)
    bands = bands_for(percent)
    coordinates = bands * BAND_ROWS
    signed = sign(docs, size, coordinates, id_column, text_column)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_id"))
    classes = staged(signed.filter("n > 0").groupBy("digest").agg(
        F.min("row_id").alias("node"), first.alias("first"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.count("*").alias("rows")), "classes")
    members = members_of(classes, bands)
    links = confirmed(star_pairs(members, percent), signed, size, percent)
    roots = components(links)
    more = rest_links(members, roots, classes, signed, size, percent, coordinates)
    roots = staged(components(links.unionByName(more)), "roots")
    named = classes.select("digest", "node", "first", "rows").join(roots, "node", "left")
    tops = named.filter("root is not null").groupBy("root").agg(F.min("first").alias("top"))
    known = named.join(tops, "root", "left").filter("root is not null or rows > 1").select("digest", F.coalesce("top", "first").alias("top"))
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_id")
    # Empty sets share a digest but link with nothing.
    return signed.drop("sketch").join(known, "digest", "left").withColumn("first", F.coalesce("top", own)).drop("top", "digest")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: set size, smallest document id of its component, and whether that is its own."""
    rows = resolve(columns(docs, doc_id=id_column, text=text_column), size, percent)
    component = F.coalesce("first.doc_id", "doc_id")
    return rows.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                       F.coalesce(component == F.col("doc_id"), F.lit(False)).alias("kept"))


def deduplicated(docs: DataFrame, size: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The one row of each component with the smallest id, with the columns as they are."""
    rows = resolve(docs, size, percent, id_column, text_column).filter("first.row_id = row_id")
    back = {id_column: "doc_id", text_column: "text"}
    return rows.select(*[F.col(back.get(c, f"own_{i}")).cast(docs.schema[c].dataType).alias(c) for i, c in enumerate(docs.columns)])
