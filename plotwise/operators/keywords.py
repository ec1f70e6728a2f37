"""First keyword of a large dictionary that occurs in a text.

A keyword can only occur where all its runs of four characters do. Each keyword is filed under one of them, the one
that the fewest texts hold; texts list their runs and meet the keywords by equality, and the pairs that meet
are verified. Shorter keywords are filed under themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plotwise.operators.sizes import join_fitted
from plotwise.session import staged

GRAM = 4
# Keywords that every task may hold; more are met by a shuffled join.
MAX_KEYWORDS = 200_000


def grams(text: Column, size: int) -> Column:
    """Different runs of ``size`` characters."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(text) - size + 1, F.lit(1)))
    cut = F.transform(starts, lambda i: F.substr(text, i, F.lit(size)))
    return F.array_distinct(F.filter(cut, lambda g: F.length(g) == size))


def with_first_keyword(df: DataFrame, text: str, keywords: DataFrame, keyword: str = "keyword", rank: str = "rank",
                       output: str = "found", max_keywords: int = MAX_KEYWORDS) -> DataFrame:
    """``df`` with the keyword of the smallest rank that occurs in ``text``, regardless of case; NULL without one.

    An empty keyword occurs in every text that is not NULL; of equal ranks the first keyword in order counts.
    """
    words = keywords.select(F.col(keyword).alias("keyword"), F.col(rank).alias("rank"), F.lower(keyword).alias("low")).dropna()
    # Of keywords that are equal but for case only the first can be found. A place in the order of all of them is one number,
    # so the least one of a text takes no sort of what its parts meet.
    firsts = words.groupBy("low").agg(F.min(F.struct("rank", "keyword")).alias("best")).select("low", "best.*")
    placed = firsts.repartitionByRange("rank", "keyword").sortWithinPartitions("rank", "keyword")
    words = staged(placed.select("keyword", "low", F.monotonically_increasing_id().alias("place")), "keywords")
    texts = df.select(F.col(text).alias("text")).dropna().distinct().withColumn("text_low", F.lower("text"))
    sizes = [r["n"] for r in words.select(F.least(F.length("low"), F.lit(GRAM)).alias("n")).distinct().collect()]  # at most 5 rows
    listed = texts.select("text", "text_low", F.explode(F.concat(F.array().cast("array<string>"), *[
        F.array(F.lit("")) if n == 0 else grams(F.col("text_low"), n) for n in sizes])).alias("gram"))

    own = F.when(F.length("low") == 0, F.array(F.lit(""))).otherwise(F.coalesce(*[F.when(F.length("low") >= n, grams(F.col("low"), n)) for n in range(GRAM, 0, -1)]))
    parts = words.withColumn("gram", F.explode(own))
    frequency = join_fitted(listed, parts.select("gram").distinct(), ["gram"], "left_semi", max_keywords)
    frequency = frequency.groupBy("gram").agg(F.count(F.lit(1)).alias("texts"))
    # A keyword with a part that no text holds occurs nowhere.
    rarest = Window.partitionBy("place").orderBy("texts", "gram")
    counted = parts.join(frequency, "gram", "left").fillna({"texts": 0})
    filed = counted.withColumn("n", F.row_number().over(rarest)).filter("n = 1 and texts > 0").select("gram", "low", "place")
    met = join_fitted(listed, staged(filed, "filed"), ["gram"], "inner", max_keywords).filter(F.contains("text_low", "low"))
    first = join_fitted(met.groupBy("text").agg(F.min("place").alias("place")), words.select("place", "keyword"), ["place"], "inner", max_keywords)
    first = first.select(F.col("text").alias("_text"), F.col("keyword").alias(output))
    return df.join(first, F.col(text) == F.col("_text"), "left").drop("_text")
