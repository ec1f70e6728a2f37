"""Merkle manifest of a dataset: a tree of digests per group, and one over the groups' roots.

Every row is a leaf: the digest of its fields, each written with its length. The leaves of a
group ascend by id; every ``FAN`` consecutive nodes become one until one is left. The groups'
roots, in the order of the groups (null first, then by UTF-8 bytes), are reduced likewise.

Places come from bitmaps and not from sorting. Ids are set in words of 64 bits; the non-empty
words of 4096 ids form a chunk with a bitmap of which words there are and a directory of the
counts before each word. Counts before a chunk are summed over a tree of chunks with 4096
children a node, so that no task sees all chunks of a group. A leaf's place is the count before
its chunk, the directory's entry and a popcount. Levels are then reduced ``STEP`` at a time, in arrays
of 3^8 slots that leaves are put into by their places.

Null ids come first in their group. Rows that repeat an id are ordered by their digests; equal
rows are leaves side by side and travel as one run with a number, so neither is ever gathered
in one task. Null fields are ``-``, empty texts have length 0. An empty table has no leaves and no root.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plotwise.llm.common import numbered, ship
from plotwise.session import staged

FAN, STEP = 3, 8
BLOCK = FAN ** STEP
#: A chunk has 2^12 ids, and a node of the tree over chunks 2^12 children.
BITS = 12
#: Chunk of the rows without an id, before all others.
NO_ID = (-(1 << 63) >> BITS) - 1


def written(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    """Digest of a row's fields."""
    return F.sha2(F.concat(*[written(v) for v in values]), 256)


def digest(parts: str) -> str:
    return hashlib.sha256(parts.encode()).hexdigest()


def leaves(docs: DataFrame, fields: list[str], id_column: str, group_column: str, found: dict[str, Column]) -> DataFrame:
    """Rows (doc_id, tree, leaf, now, copies): different leaves and how often each occurs.

    ``tree`` orders as the groups do. ``now`` is the digest of the row as it is found later.
    """
    rows = docs.select(docs[id_column].cast("long").alias("doc_id"),
                       F.coalesce(F.concat(F.lit("s"), docs[group_column].cast("string")), F.lit("")).alias("tree"),
                       leaf([docs[f] for f in fields]).alias("leaf"),
                       *[docs[f].alias(f"was_{i}") for i, f in enumerate(fields)],
                       *[found.get(f, docs[f]).alias(f"is_{i}") for i, f in enumerate(fields)])
    changed = [~F.col(f"was_{i}").eqNullSafe(F.col(f"is_{i}")) for i, f in enumerate(fields) if f in found]
    now = F.col("leaf")
    if changed:
        different = changed[0]
        for c in changed[1:]:
            different = different | c
        now = F.when(different, leaf([F.col(f"is_{i}") for i in range(len(fields))])).otherwise(F.col("leaf"))
    rows = rows.select("doc_id", "tree", "leaf", now.alias("now"), F.coalesce(F.shiftright("doc_id", BITS), F.lit(NO_ID)).alias("chunk"))
    return staged(rows.groupBy(*rows.columns).agg(F.count("*").alias("copies")), "leaves")


def below(bit: Column) -> Column:
    """A word with all bits below ``bit`` set."""
    return F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), bit.cast("int")))


def bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place.cast("int"))


def bitmaps(found: DataFrame) -> DataFrame:
    """Rows (tree, chunk, present, words, before, repeats, n): compressed bitmaps with their directories.

    ``repeats`` lists the ids of a chunk that occur more than once: id, rows and different leaves.
    """
    ids = found.groupBy("tree", "chunk", "doc_id").agg(F.sum("copies").alias("rows"), F.count("*").alias("kinds"))
    low = F.coalesce(F.col("doc_id"), F.lit(0)).bitwiseAND(F.lit((1 << BITS) - 1))
    more = F.when(F.col("rows") > 1, F.struct(low.alias("low"), "rows", "kinds"))
    words = ids.groupBy("tree", "chunk", F.shiftright(low, 6).alias("word")).agg(
        F.bit_or(bit(low.bitwiseAND(F.lit(63)))).alias("bits"), F.sum("rows").alias("n"), F.collect_list(more).alias("repeats"))
    each = F.array_sort(F.collect_list(F.struct("word", "bits", "n", "repeats")))
    chunks = words.groupBy("tree", "chunk").agg(each.alias("each"), F.bit_or(bit(F.col("word"))).alias("present"), F.sum("n").alias("n"))
    counts = F.aggregate("each", F.array(F.lit(0).cast("long")), lambda done, w: F.concat(done, F.array(F.element_at(done, -1) + w["n"])))
    return staged(chunks.select("tree", "chunk", "present", F.transform("each", lambda w: w["bits"]).alias("words"), counts.alias("before"),
                                F.flatten(F.transform("each", lambda w: w["repeats"])).alias("repeats"), "n"), "bitmaps")


def counts_before(chunks: DataFrame) -> DataFrame:
    """Rows (tree, node, base): for every chunk, the rows of its tree in all earlier chunks."""
    level = chunks.select("tree", F.col("chunk").alias("node"), "n")
    first, last = level.agg(F.min("node"), F.max("node")).first()
    levels = [level]
    while first is not None and last - first >= 1 << BITS:
        first, last = first >> BITS, last >> BITS
        levels.append(levels[-1].groupBy("tree", F.shiftright("node", BITS).alias("node")).agg(F.sum("n").alias("n")))

    def own(level: DataFrame, within: list) -> DataFrame:
        w = W.partitionBy("tree", *within).orderBy("node").rowsBetween(W.unboundedPreceding, -1)
        return level.select("tree", "node", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("base"))

    base = own(levels[-1], [])  # at most 4096 nodes and one more a tree
    for level in levels[-2::-1]:
        up = base.select("tree", F.col("node").alias("up"), F.col("base").alias("more"))
        nodes = own(level, [F.shiftright("node", BITS)]).withColumn("up", F.shiftright("node", BITS))
        base = nodes.join(up, ["tree", "up"]).select("tree", "node", (F.col("base") + F.col("more")).alias("base"))
    return base


def placed(found: DataFrame, chunks: DataFrame) -> DataFrame:
    """Runs of equal leaves with the first of their slots, by rank queries on the bitmaps."""
    base = counts_before(chunks).withColumnRenamed("node", "chunk")
    low = F.coalesce(F.col("doc_id"), F.lit(0)).bitwiseAND(F.lit((1 << BITS) - 1))
    word, place = F.shiftright("low", 6), F.col("low").bitwiseAND(F.lit(63))
    at = F.bit_count(F.col("present").bitwiseAND(below(word)))
    inside = F.bit_count(F.element_at("words", at + 1).bitwiseAND(below(place)))
    earlier = F.filter("repeats", lambda r: (r["low"] < F.col("low")) & (F.shiftright(r["low"], 6) == word))
    more = F.aggregate(earlier, F.lit(0).cast("long"), lambda s, r: s + r["rows"] - 1)
    kinds = F.filter("repeats", lambda r: (r["low"] == F.col("low")) & (r["kinds"] > 1))
    joined = found.withColumn("low", low).join(chunks.join(base, ["tree", "chunk"]).drop("n"), ["tree", "chunk"])
    runs = staged(joined.select("doc_id", "tree", "leaf", "now", "copies", (F.size(kinds) > 0).alias("tied"),
                                (F.col("base") + F.element_at("before", at + 1) + inside + more).alias("slot")), "runs")
    # Different rows of one id: in the order of their digests, whose first digits spread them over 4096 buckets.
    tied = runs.filter("tied").withColumn("bucket", F.substring("leaf", 1, 3))
    sizes = tied.groupBy("tree", "doc_id", "bucket").agg(F.sum("copies").alias("n"))
    up_to = W.partitionBy("tree", "doc_id").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select("tree", F.col("doc_id").alias("of"), F.col("bucket").alias("in"), F.coalesce(F.sum("n").over(up_to), F.lit(0)).alias("skip"))
    within = W.partitionBy("tree", "doc_id", "bucket").orderBy("leaf", "now").rowsBetween(W.unboundedPreceding, -1)
    ordered = tied.withColumn("here", F.coalesce(F.sum("copies").over(within), F.lit(0))).alias("t").join(
        sizes.alias("s"), (F.col("t.tree") == F.col("s.tree")) & F.col("t.doc_id").eqNullSafe(F.col("s.of")) & (F.col("t.bucket") == F.col("s.in")))
    ordered = ordered.select("t.doc_id", "t.tree", "t.leaf", "t.now", "t.copies", (F.col("slot") + F.col("here") + F.col("skip")).alias("slot"))
    return runs.filter("not tied").drop("tied").unionByName(ordered)


def levels_of(n: Column) -> Column:
    """How often ``n`` nodes are reduced until one is left."""
    return F.size(F.filter(F.array(*[F.lit(FAN ** k) for k in range(40)]), lambda p: p < n))


def in_blocks(nodes: DataFrame, sizes: DataFrame) -> DataFrame:
    """Nodes with the blocks that their runs lie in, and their tree's size and open levels."""
    last = F.col("slot") + F.col("copies") - 1
    blocks = F.sequence(F.floor(F.col("slot") / BLOCK), F.floor(last / BLOCK))
    return nodes.join(sizes, "tree").withColumn("block", F.explode(blocks))


def slots(table: pa.Table, column: str) -> tuple[int, list]:
    """First slot of a block and its nodes' values, by slot; runs are written out as far as they lie in the block."""
    first = table.column("block")[0].as_py() * BLOCK
    out: list = [None] * BLOCK
    for at, copies, value in zip(*(table.column(c).to_pylist() for c in ("slot", "copies", column)), strict=True):
        for i in range(max(at, first), min(at + copies, first + BLOCK)):
            out[i - first] = value
    while out and out[-1] is None:
        out.pop()
    return first, out


def reduced(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes and each level over them."""
    out = [nodes]
    for _ in range(levels):
        below = out[-1]
        out.append([digest("".join(below[i:i + FAN])) for i in range(0, len(below), FAN)])
    return out


def siblings(level: list[str], i: int) -> str:
    run = i // FAN * FAN
    return "".join(level[j] for j in range(run, min(run + FAN, len(level))) if j != i)


def fold(value: str, path: str, slot: int, n: int) -> tuple[str, str]:
    """The top over a leaf from its siblings, and the part of the path that is left."""
    while n > 1:
        run = slot // FAN * FAN
        size = min(FAN, n - run)
        own, path = path[:64 * (size - 1)], path[64 * (size - 1):]
        value = digest(own[:64 * (slot - run)] + value + own[64 * (slot - run):])
        slot, n = slot // FAN, -(-n // FAN)
    return value, path


def reduce(nodes: DataFrame, sizes: DataFrame, levels: int) -> list[DataFrame]:
    """The nodes' levels, ``STEP`` apart, up to one node for each tree."""

    def block(key: tuple, table: pa.Table) -> pa.Table:
        _, values = slots(table, "digest")
        top = reduced(values, min(STEP, table.column("open")[0].as_py()))[-1]
        return pa.table({"tree": [key[0].as_py()], "slot": [key[1].as_py()], "copies": [1], "digest": top})

    out, done = [nodes], 0
    while done < levels:
        here = sizes.select("tree", F.greatest(F.col("open") - done, F.lit(0)).alias("open"))
        blocks = in_blocks(out[-1], here).select("tree", "block", "open", "slot", "copies", "digest")
        out.append(staged(blocks.groupBy("tree", "block").applyInArrow(block, "tree string, slot long, copies long, digest string"), "nodes"))
        done += STEP
    return out


def paths(levels: list[DataFrame], sizes: DataFrame, top: DataFrame, stop: int = 0) -> DataFrame:
    """Rows (tree, slot, path) of the nodes of a level: their siblings up to their tree's root and on to what ``top`` names."""
    for depth in range(len(levels) - 2, stop - 1, -1):
        here = sizes.select("tree", F.greatest(F.col("open") - depth * STEP, F.lit(0)).alias("open"))
        blocks = in_blocks(levels[depth], here).select("tree", "block", "open", "slot", "copies", "digest")
        above = top.select("tree", F.col("slot").alias("block"), "path")

        def block(key: tuple, table: pa.Table, up: pa.Table) -> pa.Table:
            first, values = slots(table, "digest")
            known = reduced(values, min(STEP, table.column("open")[0].as_py()))
            rest = up.column("path")[0].as_py()
            own = ["".join(siblings(level, i // FAN ** k) for k, level in enumerate(known[:-1])) + rest for i in range(len(values))]
            return pa.table({"tree": [key[0].as_py()] * len(own), "slot": list(range(first, first + len(own))), "path": own})

        top = blocks.groupBy("tree", "block").cogroup(above.groupBy("tree", "block")).applyInArrow(block, "tree string, slot long, path string")
    return top


def sized(counts: DataFrame) -> DataFrame:
    return counts.withColumn("open", levels_of(F.col("n")))


def manifest(docs: DataFrame, fields: list[str], id_column: str = "doc_id", group_column: str = "source",
             found: dict[str, Column] | None = None) -> DataFrame:
    """Per row: its leaf, the root of its group and of all, a digest of its proof, and whether it verifies as found.

    ``found`` gives the fields that may have changed since, as columns of ``docs``; the others are as they were.
    """
    ship(docs.sparkSession)
    every = leaves(docs, fields, id_column, group_column, found or {})
    chunks = bitmaps(every)
    runs = staged(placed(every, chunks).withColumnRenamed("leaf", "digest"), "placed")
    sizes = staged(sized(chunks.groupBy("tree").agg(F.sum("n").alias("n"))), "sizes")
    most = sizes.agg(F.max("open")).first()[0] or 0
    nodes = reduce(runs.select("tree", "slot", "copies", "digest"), sizes, max(most, 1))

    groups = staged(numbered(nodes[-1].select(F.col("tree").alias("of"), "digest"), "of"), "groups")
    subroots = staged(groups.select(F.lit("").alias("tree"), F.col("number").alias("slot"), F.lit(1).cast("long").alias("copies"), "digest"), "subroots")
    total = groups.count()
    over = staged(sized(subroots.groupBy("tree").agg(F.count("*").alias("n"))), "sizes")
    roots = reduce(subroots, over, max((over.first() or [0, 0, 0])[2], 1))
    root = roots[-1].first()
    root = root["digest"] if root is not None else None
    outer = paths(roots, over, roots[-1].select("tree", "slot", F.lit("").alias("path"))).withColumnRenamed("tree", "over")
    named = groups.withColumnRenamed("digest", "subroot").join(outer, F.col("number") == F.col("slot"))
    tops = staged(named.select(F.col("of").alias("tree"), F.lit(0).cast("long").alias("slot"), "path", "subroot", "number"), "tops")

    upper = paths(nodes, sizes, tops.select("tree", "slot", "path"), stop=1)
    upper = upper.join(tops.select("tree", "subroot", "number"), "tree").withColumnRenamed("slot", "block")
    blocks = in_blocks(runs, sizes).select("tree", "block", "open", "n", "slot", "copies", F.struct("doc_id", "digest", "now").alias("row"))

    def prove(key: tuple, table: pa.Table, up: pa.Table) -> pa.Table:
        first, rows = slots(table, "row")
        open_levels, n = table.column("open")[0].as_py(), table.column("n")[0].as_py()
        known = reduced([r["digest"] for r in rows], min(STEP, open_levels))
        rest, subroot, number = (up.column(c)[0].as_py() for c in ("path", "subroot", "number"))
        proofs, folded = [], []
        for i, r in enumerate(rows):
            path = "".join(siblings(level, i // FAN ** k) for k, level in enumerate(known[:-1])) + rest
            proofs.append(digest(path))
            top, left = fold(r["now"], path, first + i, n)
            folded.append(fold(top, left, number, total)[0])
        return pa.table({"doc_id": pa.array([r["doc_id"] for r in rows], pa.int64()), "leaf": [r["digest"] for r in rows],
                         "subroot": [subroot] * len(rows), "proof_sha256": proofs, "folded_root": folded})

    out = blocks.groupBy("tree", "block").cogroup(upper.groupBy("tree", "block")).applyInArrow(
        prove, "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string")
    return out.withColumn("root", F.lit(root).cast("string")).withColumn("verified", F.col("folded_root") == F.col("root"))
