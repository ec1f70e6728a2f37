"""Mixing of overlapping sources to target sizes, by min-cost flow.

Documents are aggregated by their membership pattern (the set of sources that hold them).
A pattern offers its words once at no cost, a second time at a cost, a third time at a
higher one, and so on up to ``repeats``; sources ask for their quotas. The cheapest flow
from patterns to quotas says how many words each pattern gives, and documents are then
selected in a seeded order until that many words are reached: every document of a pattern
is taken equally often, but for those that are taken once more.

The order is a hash of a document's id, source and size, so it depends on neither files nor
partitions. The driver holds one row per pattern. A pattern's documents are dealt into
buckets of about ``BUCKET_ROWS`` by that hash; only sums per bucket are ordered, and only
the one bucket in which the quota ends is looked into row by row.

Null texts have size 0, a null source is a source of its own, and repeated rows count as
often as they occur. Documents of size 0 are never taken. An empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import heapq
from collections.abc import Sequence
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plotwise.llm.common import columns, ship
from plotwise.operators.sizes import join_fitted
from plotwise.session import staged

#: Different documents that a bucket has on average.
BUCKET_ROWS = 4096

#: Rows alike in id, source and size that one task makes again.
ALIKE_ROWS = 1 << 16

#: Patterns that the driver accepts.
MAX_PATTERNS = 1_000_000


def words(text: Column) -> Column:
    """Number of words, null as 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def share(sizes: Sequence[int], weights: Sequence[int], total: Fraction, most: int = 2) -> list[Fraction]:
    """Split ``total`` by weight; no part is above ``most`` times its size, and what is left over is split again."""
    parts = [Fraction(0)] * len(sizes)
    open_ = [i for i, s in enumerate(sizes) if s > 0]
    rest = Fraction(total)
    while open_ and rest > 0:
        weight = sum(weights[i] for i in open_)
        full = [i for i in open_ if Fraction(weights[i]) * rest > most * sizes[i] * weight]
        if not full:
            for i in open_:
                parts[i] = weights[i] * rest / weight
            break
        for i in full:
            parts[i] = Fraction(most * sizes[i])
        rest -= sum(parts[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return parts


class Network:
    """Min-cost flow by successive shortest paths; costs are not negative."""

    def __init__(self, nodes: int):
        self.out: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []

    def arc(self, a: int, b: int, room: int, cost: int = 0) -> int:
        for start, end, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.out[start].append(len(self.to))
            self.to.append(end)
            self.room.append(r)
            self.cost.append(c)
        return len(self.to) - 2

    def run(self, source: int, sink: int) -> None:
        """A flow of the largest amount and the least cost.

        Shortest distances are found once for each cost of a path, of which there are few; all paths of that cost are
        then filled together, so the time hardly grows faster than the number of arcs.
        """
        far = 1 << 60
        self.height = [0] * len(self.out)
        while True:
            best = [far] * len(self.out)
            best[source] = 0
            heap = [(0, source)]
            while heap:
                d, a = heapq.heappop(heap)
                if d > best[a]:
                    continue
                for e in self.out[a]:
                    b, new = self.to[e], d + self.cost[e] + self.height[a] - self.height[self.to[e]]
                    if self.room[e] and new < best[b]:
                        best[b] = new
                        heapq.heappush(heap, (new, b))
            if best[sink] >= far:
                return
            self.height = [h + min(d, best[sink]) for h, d in zip(self.height, best, strict=True)]
            while (level := self.levels(source))[sink] >= 0:
                self.fill(source, sink, level)

    def levels(self, source: int) -> list[int]:
        """Arcs from the source to each node over arcs that lie on shortest paths, -1 where there is no way."""
        level = [-1] * len(self.out)
        level[source] = 0
        found = [source]
        for a in found:
            for e in self.out[a]:
                b = self.to[e]
                if self.room[e] and level[b] < 0 and self.cost[e] + self.height[a] == self.height[b]:
                    level[b] = level[a] + 1
                    found.append(b)
        return level

    def fill(self, source: int, sink: int, level: list[int]) -> None:
        """Send along such arcs, each a level further, until no way is left."""
        at = [0] * len(self.out)
        path: list[int] = []
        node = source
        while True:
            if node == sink:
                amount = min(self.room[e] for e in path)
                for e in path:
                    self.room[e] -= amount
                    self.room[e ^ 1] += amount
                # Go on from before the first arc that is full now.
                first = next(k for k, e in enumerate(path) if not self.room[e])
                node = self.to[path[first] ^ 1]
                del path[first:]
                continue
            arcs = self.out[node]
            while at[node] < len(arcs):
                e = arcs[at[node]]
                b = self.to[e]
                if self.room[e] and level[b] == level[node] + 1 and self.cost[e] + self.height[node] == self.height[b]:
                    break
                at[node] += 1
            else:
                if node == source:
                    return
                node = self.to[path.pop() ^ 1]
                at[node] += 1
                continue
            path.append(e)
            node = b


def route(patterns: Sequence[tuple], sizes: Sequence[int], quotas: dict, repeats: int = 2) -> list[int]:
    """Words that each pattern gives, when ``quotas`` maps a source to the words that it asks for.

    The k-th repeat of a word costs k squared, so repeats are spread before they pile up.
    """
    names = list(quotas)
    place = {s: 1 + len(patterns) + i for i, s in enumerate(names)}
    net = Network(2 + len(patterns) + len(names))
    sink = len(net.out) - 1
    offers = []
    for i, (members, size) in enumerate(zip(patterns, sizes, strict=True)):
        offers.append([net.arc(0, 1 + i, size, k * k) for k in range(repeats)])
        for s in members:
            if s in place:
                net.arc(1 + i, place[s], repeats * size)
    for s in names:
        net.arc(place[s], sink, quotas[s])
    net.run(0, sink)
    return [sum(net.room[e ^ 1] for e in es) for es in offers]


def fill(sizes: list[int], counts: list[int], want: int) -> list[int]:
    """How many of each item's rows are taken once more.

    In the given order while they fit; then one more item goes in, or takes the place of
    one that is in, if the sum comes nearer to ``want`` by that.
    """
    out = []
    for size, count in zip(sizes, counts, strict=True):
        n = min(count, want // size) if size else 0
        want -= n * size
        out.append(n)
    within = sorted([(0, -1)] + [(sizes[i], i) for i, n in enumerate(out) if n])
    best, change = want, None
    for i, size in enumerate(sizes):
        if size and out[i] < counts[i]:
            at = bisect.bisect_left(within, (size - want, -1))
            for gone, j in within[max(0, at - 1):at + 1]:
                if j != i and abs(want - size + gone) < best:
                    best, change = abs(want - size + gone), (i, j)
    if change:
        out[change[0]] += 1
        if change[1] >= 0:
            out[change[1]] -= 1
    return out


def mix(docs: DataFrame, members: Column, size: Column, quotas, repeats: int = 2, seed: int = 11,
        id_column: str = "doc_id", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Select documents so that sources meet their quotas.

    ``members`` is an array of the sources that hold a document; ``quotas`` gets the words of
    each source (a dictionary) and returns the words that each asks for. Returns a row per
    different (doc_id, members, size): ``rows`` (how many rows are alike), ``copies`` (how
    often each is taken), ``extra`` (how many of them are taken once more).
    """
    ship(docs.sparkSession)
    keyed = columns(docs, doc_id=docs[id_column], members=F.array_sort(F.array_distinct(members)), size=size.cast("long"))
    keyed = keyed.groupBy("doc_id", "members", "size").agg(F.count("*").alias("rows"))
    keyed = staged(keyed.withColumn("order", F.xxhash64(F.lit(seed), "doc_id", "members", "size")), "sized")
    stats = keyed.groupBy("members").agg(F.sum(F.col("size") * F.col("rows")).alias("words"), F.count("*").alias("n"))
    found = stats.limit(MAX_PATTERNS + 1).collect()
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    found.sort(key=lambda r: [(m is None, m or "") for m in r["members"] or []])
    of_source: dict = {}
    for r in found:
        for s in r["members"] or []:
            of_source[s] = of_source.get(s, 0) + r["words"]
    given = route([r["members"] or [] for r in found], [r["words"] for r in found], quotas(of_source), repeats)
    plan = []
    for r, words_ in zip(found, given, strict=True):
        copies = words_ // r["words"] if r["words"] else 0
        plan.append((r["members"], copies, words_ - copies * r["words"], max(1, -(-r["n"] // bucket_rows))))
    plan = docs.sparkSession.createDataFrame(
        plan, keyed.select("members").schema.add("copies", "long").add("want", "long").add("buckets", "long"))
    # Null elements compare as equal within arrays, and the key itself is never null here.
    keyed = join_fitted(keyed, plan, ["members"]).withColumn("bucket", F.pmod("order", "buckets"))
    sums = keyed.groupBy("members", "bucket").agg(F.sum(F.col("size") * F.col("rows")).alias("held"), F.first("want").alias("want"))
    before = F.coalesce(F.sum("held").over(W.partitionBy("members").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    cut = (sums.withColumn("before", before).filter("before <= want and want < before + held")
           .select("members", F.col("bucket").alias("cut"), (F.col("want") - F.col("before")).alias("left")))
    keyed = join_fitted(keyed, cut, ["members"])
    result = ["doc_id", "members", "size", "rows", "copies", "extra"]
    # Without a cut, the want is 0 or all is taken once more; the second needs no cut as copies counts it.
    whole = keyed.filter("cut is null or bucket <> cut").withColumn(
        "extra", F.when(F.col("bucket") < F.col("cut"), F.col("rows")).otherwise(0).cast("long")).select(result)

    def take(table: pa.Table) -> pa.Table:
        table = table.sort_by([("order", "ascending"), ("doc_id", "ascending"), ("size", "ascending")])
        extra = fill(table.column("size").to_pylist(), table.column("rows").to_pylist(), table.column("left")[0].as_py())
        return table.append_column("extra", pa.array(np.array(extra, np.int64))).select(result)

    schema = whole.schema
    last = keyed.filter("bucket = cut").select("doc_id", "members", "size", "rows", "copies", "order", "left")
    return whole.unionByName(last.groupBy("members").applyInArrow(take, schema))


def weighted_quotas(of_source: dict, weights: Sequence[int] = (5, 2, 1), part: Fraction = Fraction(3, 2), most: int = 2) -> dict:
    """Targets of sources by code point (null last) that weigh 5, 2, 1, 5, ... and share 150 % of all words."""
    names = sorted(of_source, key=lambda s: (s is None, s or ""))
    sizes = [of_source[s] for s in names]
    parts = share(sizes, [weights[i % len(weights)] for i in range(len(names))], part * sum(sizes), most)
    return dict(zip(names, parts, strict=True))


def mix_sources(docs: DataFrame, source_column: str = "source", text_column: str = "text", id_column: str = "doc_id",
                seed: int = 11) -> tuple[DataFrame, dict, dict]:
    """Mix documents that each belong to one source; returns the decisions, sources' sizes and targets."""
    kept: dict = {}

    def quotas(of_source: dict) -> dict:
        kept["sizes"], kept["targets"] = of_source, weighted_quotas(of_source)
        return {s: round(t) for s, t in kept["targets"].items()}

    source = docs[source_column].cast("string")
    decisions = mix(docs, F.array(source), words(docs[text_column].cast("string")), quotas, seed=seed, id_column=id_column)
    return decisions.withColumn("source", F.col("members")[0]).drop("members"), kept["sizes"], kept["targets"]


def mixed_rows(docs: DataFrame, seed: int = 11) -> DataFrame:
    """Per document: size, its source's size and target, and the words that the mix takes from it."""
    decisions, sizes, targets = mix_sources(docs, seed=seed)
    table = docs.sparkSession.createDataFrame(
        [(s, sizes[s], float(targets[s])) for s in sizes], "of string, source_size long, target double")
    keyed = decisions.join(F.broadcast(table) if len(sizes) <= 20_000 else table, F.col("source").eqNullSafe(F.col("of")))
    # Rows that are alike came as one; a great many of them are dealt to several tasks before they are made again.
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("rows") - 1) / ALIKE_ROWS)))
    many = keyed.filter(F.col("rows") > ALIKE_ROWS).withColumn("part", part).repartition("doc_id", "source", "size", "part")
    parts = keyed.filter(F.col("rows") <= ALIKE_ROWS).withColumn("part", F.lit(0).cast("long")).unionByName(many)
    each = F.explode(F.sequence(F.col("part") * ALIKE_ROWS + 1, F.least(F.col("rows"), (F.col("part") + 1) * ALIKE_ROWS)))
    return parts.select("*", each.alias("nth")).select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * (F.col("copies") + (F.col("nth") <= F.col("extra")).cast("long"))).alias("taken"), "source")


def mixed_documents(docs: DataFrame, source_column: str = "source", text_column: str = "text", id_column: str = "doc_id",
                    seed: int = 11) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with their columns as they are.

    Of rows that are alike in id, source and size, all are taken once more or none.
    """
    decisions, _, _ = mix_sources(docs, source_column, text_column, id_column, seed)
    decisions = decisions.select(F.col("doc_id").alias("d_id"), F.col("source").alias("d_source"), F.col("size").alias("d_size"),
                                 (F.col("copies") + (2 * F.col("extra") >= F.col("rows")).cast("long")).alias("d_times")).filter("d_times > 0 and d_size > 0")
    rows = columns(docs, **{f"own_{i}": c for i, c in enumerate(docs.columns)}, r_id=id_column,
                   r_source=docs[source_column].cast("string"), r_size=words(docs[text_column].cast("string")))
    same = F.col("r_id").eqNullSafe(F.col("d_id")) & F.col("r_source").eqNullSafe(F.col("d_source")) & (F.col("r_size") == F.col("d_size"))
    taken = rows.join(decisions, same).withColumn("d_nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("d_times"))))
    return taken.select(*[F.col(f"own_{i}").alias(c) for i, c in enumerate(docs.columns)])
