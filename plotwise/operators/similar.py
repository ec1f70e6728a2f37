"""Listings whose titles differ by a few words, at one place, for a similar price.

Two titles are similar if, of the words of the longer one, at most one in ``ONE_IN`` (and never more than
``MOST``) is missing in the other. So both hold a common set of words that each reaches by leaving out as many
words as it may. Every title lists these sets, as fingerprints, and titles meet by equality: all titles that list one
set are similar to each other. So a set needs no pairs of titles, only the earliest row of each of its prices,
which combines on the map side, however many rows share the set.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plotwise.operators.dedup import MAX_SENT, fingerprint, keep_first, spelling_key, without
from plotwise.session import staged

ONE_IN, MOST = 8, 3
# Prices are compared by their logarithms, where equal distances may differ by rounding.
SLACK = 1e-9
SET = ["place", "size", "a", "b"]
# Rows that one task sorts for its windows, about.
WINDOW_ROWS = 400_000


def words_of(title: Column) -> Column:
    return F.array_distinct(F.filter(F.split(spelling_key(title), " "), lambda w: w != ""))


def word_sets(words: Column) -> Column:
    """Fingerprints (size, a, b) of what is left of the words when up to the allowed number of them goes."""
    marks = F.transform(words, lambda w, i: F.struct(F.xxhash64(F.lit(1), w).alias("a"), F.xxhash64(F.lit(2), w).alias("b"), i.alias("i")))

    def without_one_more(sets: Column) -> Column:
        return F.flatten(F.transform(sets, lambda s: F.transform(
            F.filter(marks, lambda m: m["i"] >= s["next"]),
            lambda m: F.struct((s["size"] - 1).alias("size"), s["a"].bitwiseXOR(m["a"]).alias("a"), s["b"].bitwiseXOR(m["b"]).alias("b"), (m["i"] + 1).alias("next")))))

    def all_of(part: str) -> Column:
        return F.aggregate(marks, F.lit(0).cast("bigint"), lambda x, m: x.bitwiseXOR(m[part]))

    last = F.array(F.struct(F.size(words).alias("size"), all_of("a").alias("a"), all_of("b").alias("b"), F.lit(0).alias("next")))
    found, none = [last], F.filter(last, lambda s: F.lit(False))
    for gone in range(1, MOST + 1):
        last = F.when(F.size(words) >= gone * ONE_IN, without_one_more(last)).otherwise(none)
        found.append(last)
    return F.transform(F.concat(*found), lambda s: s.dropFields("next"))


def earliest_near(firsts: DataFrame, tolerance: float, parts: int) -> DataFrame:
    """For each price of a set, the earliest row among the set's prices within the tolerance.

    ``firsts`` has ``SET``, ``price``, and ``first``. Prices lie in bands as wide as the tolerance on a
    logarithmic scale: all of a price's own band are near, and of the two beside it those up to
    one place, which a running minimum answers. A band is one window, of different prices only. The bands
    are dealt into ``parts``, so that what a task sorts does not grow with the table.
    """
    near = math.log(1 + tolerance)
    width, reach = near + 2 * SLACK, near + SLACK
    at = F.log("price")
    priced = firsts.filter("price > 0 and price < double('infinity')").withColumns({"at": at, "band": F.floor(at / width)})
    asked = F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("band").alias("in"), F.col("at").alias("x"), F.col("first").alias("entry")),
        F.struct(F.lit(1).alias("side"), (F.col("band") - 1).alias("in"), (F.col("at") - reach).alias("x"), F.lit(None).cast(firsts.schema["first"].dataType).alias("entry")),
        F.struct(F.lit(2).alias("side"), (F.col("band") + 1).alias("in"), (F.col("at") + reach).alias("x"), F.lit(None).cast(firsts.schema["first"].dataType).alias("entry"))))
    rows = priced.select(*SET, "price", asked.alias("q")).select(*SET, "price", "q.*").repartition(parts, *SET, "in")
    band = Window.partitionBy(*SET, "in")
    up = band.orderBy(F.col("x").asc(), "side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    down = band.orderBy(F.col("x").desc(), "side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = rows.select(*SET, "price", F.when(F.col("side") == 0, F.min("entry").over(band)).when(F.col("side") == 1, F.min("entry").over(down))
                        .otherwise(F.min("entry").over(up)).alias("earliest"))
    others = firsts.filter("not coalesce(price > 0 and price < double('infinity'), false)").select(*SET, "price", F.col("first").alias("earliest"))
    return found.groupBy(*SET, "price").agg(F.min("earliest").alias("earliest")).unionByName(others)


def kept_positions(rows: DataFrame, position: str, title: str, place: str, price: str, order: Sequence[str], tolerance: float) -> DataFrame:
    """Positions of the rows without a similar row before them."""
    spot = fingerprint([spelling_key(F.col(place))])
    listed = rows.select(F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], F.col(position).alias("position")).alias("at"),
                         F.col(price).cast("double").alias("price"), spot.alias("place"), words_of(F.col(title)).alias("words"))
    plain = F.coalesce(F.size("words") == 0, F.lit(True))
    # Of rows that are equal in words, place and price, only the first can stay.
    titled = keep_first(listed.filter(~plain), ["place", F.array_sort("words"), "price"], ["at"])
    entries = staged(titled.select("at", "price", "place", F.explode(word_sets(F.col("words"))).alias("s")).select("at", "price", "place", "s.*"), "word-sets")
    firsts = entries.groupBy(*SET, "price").agg(F.min("at").alias("first"))
    near = earliest_near(firsts, tolerance, -(-3 * entries.count() // WINDOW_ROWS) or 1)
    e, n = entries.alias("e"), near.alias("n")
    same = F.col("e.price").eqNullSafe(F.col("n.price"))
    for c in SET:
        same = same & (F.col(f"e.{c}") == F.col(f"n.{c}"))
    earliest = e.join(n, same).groupBy("e.at").agg(F.min("n.earliest").alias("earliest"))
    alone = listed.filter(plain).select(F.col("at.position").alias(position))
    return earliest.filter(F.col("earliest") == F.col("at")).select(F.col("at.position").alias(position)).unionByName(alone)


def drop_similar(rows: DataFrame, position: str, title: str, place: str, price: str, order: Sequence[str],
                 tolerance: float = 0.05, max_sent: int = MAX_SENT) -> DataFrame:
    """``rows`` without those that have a similar row before them, whether that one stays or not.

    Similar means: similar titles, equal places but for case and punctuation, and prices at most
    ``tolerance`` apart. Prices that are missing or not positive are similar to equal ones, titles without
    a word to none. ``rows`` is a written table with a unique ``position``; ties in the order go by it.
    """
    kept = kept_positions(rows, position, title, place, price, order, tolerance)
    return without(rows, position, rows.select(position).join(kept, position, "left_anti"), max_sent)
