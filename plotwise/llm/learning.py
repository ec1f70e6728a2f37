"""Bounded samples of labelled rows, the same way for all classifiers.

A sample has at most a fixed number of rows of each label, however often rows or ids repeat.
The rows with the least hashes are found without ranking a whole label: counts of the hashes' first
bits, then of the next, give a limit for each label, and only rows below it are ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plotwise.operators.sizes import join_fitted
from plotwise.session import staged

#: Parts that a sample's texts are written in; each gives the driver one message of fixed size.
PARTS = 8
#: Bits of a hash that are counted at a time, twice.
BITS = 12


def least(rows: DataFrame, group: list[str], hash_column: str, bound: int) -> DataFrame:
    """Rows with the ``bound`` least hashes of each group, and some with the same first 24 bits as the last of them.

    ``rows`` is read several times (see ``staged``); hashes are spread over all long numbers. No task sees
    more of a group than its counts.
    """
    first = F.shiftrightunsigned(hash_column, 64 - BITS)
    both = F.shiftrightunsigned(hash_column, 64 - 2 * BITS)
    large = rows.groupBy(*group).agg(F.count("*").alias("n")).filter(F.col("n") > bound).select(*group)
    up_to = W.partitionBy(*group).orderBy("bits").rowsBetween(W.unboundedPreceding, 0)

    def crossing(counts: DataFrame, before: Column) -> DataFrame:
        """Of at most 4096 counts of a group, the one where the bound is reached, with what lies before it."""
        counts = counts.withColumn("done", before + F.sum("n").over(up_to))
        return counts.filter((F.col("done") >= bound) & (F.col("done") - F.col("n") < bound)).select(*group, "bits", (F.col("done") - F.col("n")).alias("before"))

    inside = join_fitted(rows, large, group, "inner")
    coarse = crossing(inside.groupBy(*group, first.alias("bits")).agg(F.count("*").alias("n")), F.lit(0))
    fine = join_fitted(inside, coarse.withColumnRenamed("bits", "coarse"), group, "inner").filter(first == F.col("coarse"))
    fine = fine.groupBy(*group, both.alias("bits")).agg(F.count("*").alias("n"), F.first("before").alias("before"))
    limits = crossing(fine, F.col("before")).select(*group, F.col("bits").alias("limit"))
    return join_fitted(rows, limits, group).filter(F.col("limit").isNull() | (both <= F.col("limit"))).drop("limit")


def unsigned(hash_column: str) -> list[Column]:
    """The order of hashes by their bits."""
    return [F.shiftrightunsigned(hash_column, 64 - 2 * BITS), F.col(hash_column)]


def pick(rows: DataFrame, label: str, per_label: int, seed: int) -> DataFrame:
    """At most ``per_label`` rows of each label, by a hash of their id."""
    columns = rows.columns
    rows = staged(rows.withColumn("order", F.xxhash64(F.lit(seed), "doc_id")), "labelled")
    few = least(rows, [label], "order", per_label)
    ranked = few.withColumn("place", F.row_number().over(W.partitionBy(label).orderBy(*unsigned("order"), "doc_id")))
    return ranked.filter(F.col("place") <= per_label).select(*columns)


def sample_texts(docs: DataFrame, chosen: DataFrame, text: Column, name: str, label: str, rows: int, seed: int,
                 own: Column | None = None) -> DataFrame:
    """Different texts of the chosen ids with the columns of ``chosen`` and ``copies``, written down in a few parts.

    At most ``rows`` of each label: first one text of each id, then a second of those that have
    one, and so on, by hashes. ``copies`` says for how many rows a text stands; texts that find
    no room are stood for by the others of their id, in equal parts of what these have.
    ``own`` is the rows' own label where they have one: an id chosen for a label gives the texts of that label only.
    ``chosen`` has a bounded number of rows, so it is broadcast.
    """
    keys = [c for c in chosen.columns if c != "doc_id"]
    texts = docs.select(F.col("doc_id").alias("doc_id"), text.alias("text"), *([] if own is None else [own.alias(label)])).filter("text is not null")
    on = ["doc_id"] if own is None else ["doc_id", label]
    found = texts.join(F.broadcast(chosen), on).withColumn("sha", F.sha2("text", 256)).groupBy("doc_id", *keys, "sha").agg(F.count("*").alias("copies"))
    # Which texts, decided by their hashes alone.
    found = staged(found.withColumn("hash", F.xxhash64("sha")), name)
    turns = least(found, ["doc_id", label], "hash", rows)
    turns = turns.withColumn("turn", F.row_number().over(W.partitionBy("doc_id", label).orderBy(*unsigned("hash"), "sha"))).filter(F.col("turn") <= rows)
    turns = staged(turns, name)
    before = F.coalesce(F.sum("n").over(W.partitionBy(label).orderBy("turn").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    last = turns.groupBy(label, "turn").agg(F.count("*").alias("n")).withColumn("before", before)  # at most ``rows`` turns
    last = last.filter(F.col("before") < rows).groupBy(label).agg(F.max("turn").alias("last"))
    few = join_fitted(turns, last, [label], "inner").filter(F.col("turn") <= F.col("last"))  # a turn has a row of each id at most
    order = F.xxhash64(F.lit(seed), "doc_id")
    few = few.withColumn("place", F.row_number().over(W.partitionBy(label).orderBy("turn", order, "doc_id"))).filter(F.col("place") <= rows)
    few = staged(few.select("doc_id", *keys, "sha", "copies"), name)
    # What the kept texts stand for: all rows of their id.
    every = found.groupBy("doc_id", label).agg(F.sum("copies").alias("all"))
    some = few.groupBy("doc_id", label).agg(F.sum("copies").alias("some"))
    share = staged(every.join(F.broadcast(some), ["doc_id", label]).filter(F.col("all") > F.col("some")), name)
    scaled = few.join(F.broadcast(share), ["doc_id", label], "left")
    copies = F.coalesce(F.round(F.col("copies") * F.col("all") / F.col("some")).cast("long"), "copies")
    scaled = scaled.select("doc_id", *keys, "sha", copies.alias("copies"))
    # The texts of the rows that are kept.
    ids = few.select("doc_id").distinct()
    held = texts.join(F.broadcast(ids), "doc_id", "leftsemi").withColumn("sha", F.sha2("text", 256)).join(F.broadcast(scaled), [*on, "sha"])
    held = held.groupBy("doc_id", *keys, "sha", "copies").agg(F.first("text").alias("text"))
    return staged(held.select("doc_id", *keys, "text", "copies").repartition(PARTS), name)
