"""Language-model scores by context-tree weighting, beside a unigram base.

A text is coded byte by byte, each byte as 8 binary decisions, in the context of the ``ORDER``
bytes before it. A node is a context of 0 to ``ORDER`` bytes with the bits of the byte so far, and holds
how often a 0 and a 1 followed in the learned texts. Its Krichevsky-Trofimov estimate is weighed
against the product of its children (one byte more of context), half and half a priori; what
the learned texts say for either side gives the weights with which the estimates of all depths
are mixed. Nothing is cut: the model has every context of the learned texts, as a table.

A text's bytes are lower-cased (A-Z), end with the byte FF, which UTF-8 never holds, and follow
``ORDER`` such bytes. So the scores are probabilities over all texts.

Texts are read in blocks of about ``BLOCK_BYTES``. A block states its different grams (context and
byte) and words with their counts in learned texts; Spark adds these up, builds the tree bottom up
with one grouping per depth, and mixes top down with one join per depth. A block then gets the values
of its own grams and words and scores its texts, so no task holds the model. Sums over
rows are of whole numbers and thus the same in every run.

The base is the sum over words and one end of log10((c + 1) / (N + V + 1)), for c occurrences among N
learned tokens of V kinds. Null texts are empty: they have an end. Repeated rows count and are
scored each; rows without an id as the caller's condition says (null: not learned from). An empty
table has no scores. With nothing to learn from, a byte has probability 1/256 and the base is 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plotwise.llm.common import buffers, columns, records, ship, slices, split_words
from plotwise.session import staged

ORDER = 4
END = 255
BLOCK_BYTES = 32 << 20
#: Bytes of text whose grams are held at once.
SLICE_BYTES = 1 << 20
#: Logarithms as whole numbers: of a node's weight, and of a gram's probability.
NODE_UNIT, GRAM_UNIT = 1 << 12, 1 << 24

ROWS = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), ("text", pa.string()), ("gram", pa.int64()), ("word", pa.string()), ("n", pa.int64())])
SCORES = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()),
                    ("score", pa.float64()), ("bits_per_byte", pa.float64())])


def grams(texts: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Grams of all texts in a row, and the first of each text: one for each byte and for the end."""
    offsets, raw = buffers(pc.ascii_lower(texts))
    sizes, count = np.diff(offsets), len(offsets) - 1
    padded = np.full(len(raw) + count * (order + 1) + order, END, np.uint8)
    padded[np.arange(len(raw)) + np.repeat(np.arange(count) * (order + 1) + order, sizes)] = raw
    keys = np.zeros(len(raw) + count * (order + 1), np.int64)
    for i in range(order + 1):
        keys <<= 8
        keys |= padded[i:i + len(keys)]
    starts = offsets[:-1] + np.arange(count)
    return keys[np.arange(len(raw) + count) + np.repeat(np.arange(count) * order, sizes + 1)], starts


def counted(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys, ascending, with the sums of their weights."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(weights[order], first) if len(keys) else weights


class Block:
    """What a block's texts hold: different grams and words with their counts in learned texts."""

    def __init__(self, order: int):
        self.order, self.bytes = order, 0
        self.grams: list[tuple[np.ndarray, np.ndarray]] = []
        self.words: list[pa.Table] = []

    def add(self, texts: pa.Array, learned: np.ndarray) -> None:
        keys, starts = grams(texts, self.order)
        known = np.repeat(learned, np.diff(np.append(starts, len(keys))))
        kinds, n = np.unique(keys[known], return_counts=True)
        others = np.unique(keys[~known])
        self.grams.append(counted(np.concatenate([kinds, others]), np.concatenate([n, np.zeros(len(others), np.int64)])))
        bounds, words = split_words(pc.ascii_lower(texts))
        self.words.append(pa.table({"word": words, "n": np.repeat(learned, np.diff(bounds)).astype(np.int64)}).group_by("word").aggregate([("n", "sum")]))
        self.bytes += len(keys)

    def close(self, block: int) -> Iterator[pa.RecordBatch]:
        keys, n = counted(*(np.concatenate(x) for x in zip(*self.grams, strict=True)))
        yield rows(len(keys), block=np.full(len(keys), block), gram=keys, n=n)
        words = pa.concat_tables(self.words).group_by("word").aggregate([("n_sum", "sum")])
        for part in words.to_batches(max_chunksize=1 << 16):
            yield rows(part.num_rows, block=np.full(part.num_rows, block), word=part.column("word"), n=part.column("n_sum_sum"))


def rows(count: int, **known) -> pa.RecordBatch:
    return records({f.name: known.get(f.name, pa.nulls(count, f.type)) for f in ROWS}, ROWS)


def blocks(docs: DataFrame, order: int, block_bytes: int) -> DataFrame:
    """Texts with their block, and each block's grams and words, written down."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        open_block = Block(order)
        for batch in slices(batches, "text", min(SLICE_BYTES, block_bytes)):
            if open_block.bytes >= block_bytes:
                yield from open_block.close(number)
                number, open_block = number + 1, Block(order)
            texts = batch.column("text")
            open_block.add(texts, np.asarray(batch.column("learned")))
            yield rows(len(texts), block=np.full(len(texts), number), doc_id=batch.column("doc_id"), text=texts)
        if open_block.grams:
            yield from open_block.close(number)

    found = docs.mapInArrow(split, "block long, doc_id long, text string, gram long, word string, n long")
    return staged(found, "blocks", compression="zstd")


def log_gamma(x: Column) -> Column:
    """ln of the gamma function for x of 0.5 and more: Stirling's series eight steps further on."""
    y, steps = x + 8, x
    for i in range(1, 8):
        steps = steps * (x + i)
    series = 1 / (12 * y) - 1 / (360 * F.pow(y, F.lit(3.0))) + 1 / (1260 * F.pow(y, F.lit(5.0))) - 1 / (1680 * F.pow(y, F.lit(7.0)))
    return (y - 0.5) * F.log(y) - y + 0.5 * np.log(2 * np.pi) + series - F.log(steps)


def estimate(n0: Column, n1: Column) -> Column:
    """ln of the Krichevsky-Trofimov probability of n0 zeros and n1 ones."""
    return log_gamma(n0 + 0.5) + log_gamma(n1 + 0.5) - log_gamma(n0 + n1 + 1.0) - float(np.log(np.pi))


def tree(totals: DataFrame, order: int) -> list[DataFrame]:
    """Nodes by depth: (context, node, n0, n1, own, below, weight), logarithms in units; the deepest list the bytes that they lead to."""
    bits = F.explode(F.array(*[F.lit(b) for b in range(8)]))
    byte = F.col("gram").bitwiseAND(F.lit(255))
    each = totals.select(F.shiftright("gram", 8).alias("context"), byte.cast("int").alias("byte"), "n", bits.alias("b"))
    path = F.call_function("shiftright", F.col("byte") + 256, 8 - F.col("b"))  # a one, then the bits so far
    bit = F.call_function("shiftright", F.col("byte"), 7 - F.col("b")).bitwiseAND(F.lit(1))
    each = each.select("context", path.alias("node"), bit.alias("bit"), "byte", "n")
    level = each.groupBy("context", "node").agg(
        F.sum(F.when(F.col("bit") == 0, F.col("n")).otherwise(0)).alias("n0"), F.sum(F.when(F.col("bit") == 1, F.col("n")).otherwise(0)).alias("n1"),
        F.collect_list(F.struct("byte", "bit")).alias("leads"))  # at most 256
    level = level.withColumn("own", estimate(F.col("n0"), F.col("n1")))
    levels = [staged(level.withColumn("weight", units(F.col("own"))), "nodes")]
    for depth in range(order - 1, -1, -1):
        shorter = F.col("context").bitwiseAND(F.lit((1 << 8 * depth) - 1))
        level = levels[-1].groupBy(shorter.alias("context"), "node").agg(
            F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), (F.sum("weight") / NODE_UNIT).alias("below"))
        level = level.withColumn("own", estimate(F.col("n0"), F.col("n1")))
        both = F.greatest("own", "below") + F.log1p(F.exp(-F.abs(F.col("own") - F.col("below")))) - float(np.log(2))
        levels.append(staged(level.withColumn("weight", units(both)), "nodes"))
    return levels[::-1]


def units(value: Column) -> Column:
    return F.round(value * NODE_UNIT).cast("long")


def mixed(levels: list[DataFrame]) -> DataFrame:
    """ln probability of every gram, in units: at each node the estimates of all depths, mixed from the root down."""
    one = (F.col("n1") + 0.5) / (F.col("n0") + F.col("n1") + 1.0)
    above = None
    for depth, level in enumerate(levels):
        last = depth == len(levels) - 1
        # The chance that the contexts end here, given what was learned.
        stop = F.lit(1.0) if last else 1 / (1 + F.exp(F.least(F.col("below") - F.col("own"), F.lit(700.0))))
        if above is None:
            level = level.withColumn("left", F.lit(1.0)).withColumn("sum", F.lit(0.0))
        else:
            level = level.withColumn("shorter", F.col("context").bitwiseAND(F.lit((1 << 8 * (depth - 1)) - 1)))
            level = level.join(above.withColumnRenamed("context", "shorter"), ["shorter", "node"])
        done = F.col("sum") + F.col("left") * stop * one
        if last:
            level = level.select("context", F.explode("leads").alias("lead"), done.alias("sum"))
        else:
            above = level.select("context", "node", done.alias("sum"), (F.col("left") * (1 - stop)).alias("left"))
    chance = F.when(F.col("lead.bit") == 1, F.col("sum")).otherwise(1 - F.col("sum"))
    gram = F.call_function("shiftleft", F.col("context"), F.lit(8)).bitwiseOR(F.col("lead.byte").cast("long"))
    return level.groupBy(gram.alias("gram")).agg(F.sum(F.round(F.log(chance) * GRAM_UNIT).cast("long")).alias("value"))


def score(docs: DataFrame, learnable: Column, order: int = ORDER, block_bytes: int = BLOCK_BYTES,
          id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Base and model scores of every whole text. ``learnable`` is a condition on ``doc_id``: the rows that are learned from."""
    spark = ship(docs.sparkSession)
    source = columns(docs, doc_id=docs[id_column].cast("long"), text=F.coalesce(docs[text_column].cast("string"), F.lit("")))
    found = blocks(source.withColumn("learned", F.coalesce(learnable, F.lit(False))), order, block_bytes)

    totals = found.filter("gram is not null").groupBy("gram").agg(F.sum("n").alias("n"))
    values = mixed(tree(staged(totals, "grams"), order))
    grams_of = found.filter("gram is not null").select("block", "gram").join(values, "gram").select("block", "gram", F.lit(None).cast("string").alias("word"), "value")

    same = W.partitionBy("word")
    counts = found.filter("word is not null").select("block", "word", "n", F.sum("n").over(same).alias("value"), F.min("block").over(same).alias("first"))
    counts = staged(counts, "words", compression="zstd")
    ends = source.agg(F.count(F.when(F.coalesce(learnable, F.lit(False)), 1))).first()[0]
    words, kinds = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when((F.col("first") == F.col("block")) & (F.col("value") > 0), 1))).first()
    tokens, kinds = words + ends, kinds + (ends > 0)
    pulled = grams_of.unionByName(counts.select("block", F.lit(None).cast("long").alias("gram"), "word", "value"))

    def judge(key: tuple, texts: pa.Table, known: pa.Table) -> pa.Table:
        is_gram = known.column("gram").is_valid()
        of_grams, of_words = known.filter(is_gram), known.filter(pc.invert(is_gram))
        gram_set, gram_value = of_grams.column("gram").combine_chunks(), of_grams.column("value").to_numpy()
        word_set, word_count = of_words.column("word").combine_chunks(), of_words.column("value").to_numpy()
        word_score = np.log10((word_count + 1) / (tokens + kinds + 1))
        end_score = float(np.log10((ends + 1) / (tokens + kinds + 1)))
        out = []
        for batch in slices(iter(texts.combine_chunks().to_batches()), "text", SLICE_BYTES):
            keys, starts = grams(batch.column("text"), order)
            at = pc.index_in(pa.array(keys), value_set=gram_set)
            bounds, found_words = split_words(pc.ascii_lower(batch.column("text")))
            at_word = pc.index_in(found_words, value_set=word_set)
            if at.null_count or at_word.null_count:
                raise ValueError("a block misses grams or words of its texts")
            logs = np.add.reduceat(gram_value[np.asarray(at)], starts)
            at_word, of = np.asarray(at_word), np.repeat(np.arange(batch.num_rows), np.diff(bounds))
            sizes = np.diff(np.append(starts, len(keys)))
            natural = logs / GRAM_UNIT
            out.append(records({
                "doc_id": batch.column("doc_id"), "n_tokens": np.diff(bounds) + 1,
                "n_known": np.bincount(of, word_count[at_word] > 0, batch.num_rows).astype(np.int64) + (ends > 0),
                "base_score": np.bincount(of, word_score[at_word], batch.num_rows) + end_score,
                "score": natural / np.log(10), "bits_per_byte": -natural / np.log(2) / sizes}, SCORES))
        return pa.Table.from_batches(out, SCORES)

    texts = found.filter("text is not null").select(F.col("block").alias("of"), "doc_id", "text")
    scored = texts.groupBy("of").cogroup(pulled.groupBy("block")).applyInArrow(
        judge, "doc_id long, n_tokens long, n_known long, base_score double, score double, bits_per_byte double")
    return scored.withColumn("train_tokens", F.lit(tokens).cast("long"))
