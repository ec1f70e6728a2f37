"""Language identification: averaged embeddings of hashed subwords with a linear softmax.

A word's subwords are its n-grams of letters, with blanks as the word's ends. A text is the
average of its subwords' vectors, and a linear softmax over that average gives a probability
per language; both are trained by stochastic gradient descent. Learning takes at most
``PER_LANGUAGE`` different documents of each language, by a hash of their ids
(``learning.sample_texts``; a text that repeats teaches its language once), and ``DRAWN`` seeded
draws of subwords from each whole text. A part of these ids is held out, to calibrate: one
temperature that makes the probabilities honest, and a confidence below which a text is
rejected as standing between learned languages.

Probabilities share their mass among the learned languages, so they cannot see a text in none
of them. For that a text has a familiarity: the mean log frequency, among the learned draws of
its best language, of its subwords. Below a floor it is rejected. The floors are set on
held-out texts and on pieces of ``CUTS`` letters of them, per language and number of subwords:
``REJECTED`` of the texts that are in the language fall below (by a normal tail, or by the
quantile where that is lower). A text may further have one word, or ``LEAST_NEW`` of its
subwords, that learning never saw. Without held-out texts there is no floor.

Scoring covers whole texts; as both layers are linear, they are folded into one table of a
few numbers per subword. Texts that are null or have no letter are ``und`` with score 0 and
rejected. Repeated rows are scored alike. Without any language to learn, all is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotwise.llm import learning, ngrams
from plotwise.llm.common import columns, records, ship, slices
from plotwise.operators.sizes import small_or_none

ORDERS, BITS, DIMENSIONS = (1, 2, 3, 4), 16, 16
PER_LANGUAGE, MAX_LANGUAGES = 1_000, 500
DRAWN, SHORT = 256, 32
RATE, BATCH = 0.5, 32
#: Steps of a round, rounds at most, and the mean loss that is enough.
STEPS, ROUNDS, TAUGHT = 250, 12, 0.02
#: Bytes of text that are scored at once.
SCORED_BYTES = 1 << 20
#: Subwords of one word that may be new in a text, and the least and most that they count as of the text.
NEW, LEAST_NEW, MOST_NEW = 32, 0.05, 0.5
#: Part of the texts in a learned language that may be rejected as unfamiliar, lengths of pieces to set the floors on, and the least held-out texts with a deviation of their own.
REJECTED, CUTS, LEAST_HELD = 0.001, (4, 16, 64, 256, 1024, 4096), 20
UNKNOWN = "und"


def subwords(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each order: bucket and use of each place, first and end of each text.

    Places count if the n-gram holds a letter and no blank but at its ends.
    """
    offsets, codes = ngrams.words_of(*ngrams.code_points(texts))
    blank = codes == ngrams.BLANK
    inner = np.zeros(len(codes), bool)
    for n, bucket in ngrams.hashes(codes, tuple(range(1, max(ORDERS) + 1)), BITS):
        if n >= 3:
            inner = inner[:len(bucket)] | blank[n - 2:n - 2 + len(bucket)]
        else:
            inner = blank[:len(bucket)] if n == 1 else np.zeros(len(bucket), bool)
        if n in ORDERS:
            yield bucket, ~inner[:len(bucket)], *ngrams.places(offsets, n)


def parts_of(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each order, the buckets of all subwords in a row, and how many each text has."""
    out = []
    for bucket, use, first, end in subwords(texts):
        used = np.concatenate([[0], np.cumsum(use)])
        inside = np.zeros(len(bucket) + 1, np.int8)
        np.add.at(inside, np.minimum(first, len(bucket)), 1)
        np.add.at(inside, np.minimum(end, len(bucket)), -1)
        good = use & (np.cumsum(inside[:-1], dtype=np.int8) > 0)
        out.append((bucket[good], used[np.minimum(end, len(bucket))] - used[np.minimum(first, len(bucket))]))
    return out


def sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of runs of values, in double precision; empty runs as 0."""
    out = np.zeros(len(sizes))
    some = sizes > 0
    if some.any():
        out[some] = np.add.reduceat(values, (np.cumsum(sizes) - sizes)[some], dtype=np.float64)
    return out


class Model:
    """Logits and log frequency of each subword and language, the constants, temperature, least confidence and floors; fixed in size."""

    def __init__(self, languages: list[str], logits: np.ndarray, constant: np.ndarray, temperature: float = 1.0, least: float = 0.0,
                 usual: np.ndarray | None = None, floors: tuple[np.ndarray, np.ndarray] | None = None):
        self.languages, self.logits, self.constant = languages, logits, constant
        self.temperature, self.least = temperature, least
        self.usual, self.floors = usual, floors

    def averages(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Mean logits of each text's subwords, and how many it has."""
        return self.logits_of(parts_of(texts))

    def logits_of(self, parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        count = sum(sizes for _, sizes in parts)
        total = np.zeros((len(count), len(self.languages)))
        for bucket, sizes in parts:
            for k in range(len(self.languages)):
                total[:, k] += sums(self.logits[k][bucket], sizes)
        return total / np.maximum(count, 1)[:, None], count

    def familiarity(self, texts: pa.Array, language: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mean log frequency of each text's subwords in its language, and how many it has."""
        return self.familiar(parts_of(texts), language)

    def familiar(self, parts: list[tuple[np.ndarray, np.ndarray]], language: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        count = sum(sizes for _, sizes in parts)
        total = sum(sums(self.usual[np.repeat(language, sizes), bucket], sizes) for bucket, sizes in parts)
        return total / np.maximum(count, 1), count

    def unfamiliar(self, parts: list[tuple[np.ndarray, np.ndarray]], language: np.ndarray) -> np.ndarray:
        """Whether each text is less familiar than nearly all texts of its language with as many subwords."""
        if self.floors is None:
            return np.zeros(len(language), bool)
        mean, count = self.familiar(parts, language)
        sizes, least = self.floors
        at = np.log(np.maximum(count, 1))
        floor = np.zeros(len(language))
        for k in range(len(self.languages)):
            mine = language == k
            floor[mine] = np.interp(at[mine], sizes[k], least[k])
            new = np.clip(NEW / np.maximum(count[mine], 1), LEAST_NEW, MOST_NEW)
            floor[mine] -= new * (floor[mine] - self.usual[k].min())
        return mean < floor

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, calibrated confidence and rejection of each text."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        parts = parts_of(texts)
        mean, count = self.logits_of(parts)
        p = softmax((mean + self.constant) / self.temperature)
        some = count > 0
        best, confidence = p.argmax(axis=1), np.where(some, p.max(axis=1), 0.0)
        names = [self.languages[b] if s else UNKNOWN for b, s in zip(best.tolist(), some.tolist(), strict=True)]
        return names, confidence, ~some | (confidence < self.least) | self.unfamiliar(parts, best)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def draws(sample: DataFrame, seed: int) -> pa.Table:
    """(label, buckets) of the sample: ``DRAWN`` subwords of each whole text, drawn by a generator seeded with its id."""
    layout = pa.schema([("label", pa.string()), ("doc_id", pa.int64()), ("held", pa.bool_()), ("buckets", pa.list_(pa.int32()))])

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [[] for _ in range(batch.num_rows)]
            for bucket, use, first, end in subwords(batch.column("text")):
                for i in range(batch.num_rows):
                    found[i].append(bucket[first[i]:end[i]][use[first[i]:end[i]]])
            out = []
            for doc_id, parts in zip(batch.column("doc_id").to_pylist(), found, strict=True):
                every = np.concatenate(parts)
                out.append(np.random.default_rng([seed, abs(doc_id)]).choice(every, DRAWN).astype(np.int32) if len(every) else np.zeros(0, np.int32))
            yield records({"label": batch.column("label"), "doc_id": batch.column("doc_id"), "held": batch.column("held"), "buckets": out}, layout)

    table = sample.mapInArrow(draw, "label string, doc_id long, held boolean, buckets array<int>").toArrow()
    return table.sort_by([("doc_id", "ascending"), ("label", "ascending")]).combine_chunks()


def train(buckets: np.ndarray, labels: np.ndarray, classes: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Embeddings, softmax weights and constants, by stochastic gradient descent over small batches.

    A batch draws its languages evenly, then a text of each, so neither few texts nor a rare
    language leave the softmax untaught. Rounds of steps go on until their mean loss is below ``TAUGHT`` or
    no longer falls, at most ``ROUNDS``; in a last round the rate falls to 0. Every other
    step sees only the first ``SHORT`` draws of its texts, so that short texts are learned too.
    """
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1, 1, (1 << BITS, DIMENSIONS)) / DIMENSIONS
    weights, constant = np.zeros((DIMENSIONS, classes)), np.zeros(classes)
    by_label = np.argsort(labels, kind="stable")
    counts = np.bincount(labels, minlength=classes)
    starts, present = np.cumsum(counts) - counts, np.flatnonzero(counts)
    before, final = np.inf, False
    for turn in range(ROUNDS + 1):
        total = 0.0
        for step in range(STEPS):
            of = rng.choice(present, BATCH)
            some = by_label[starts[of] + (rng.random(BATCH) * counts[of]).astype(np.int64)]
            ids = buckets[some] if step % 2 else buckets[some, :SHORT]
            rate = RATE * (1 - step / STEPS) if final else RATE
            mean = vectors[ids].mean(axis=1)
            p = softmax(mean @ weights + constant)
            total -= np.log(p[np.arange(BATCH), labels[some]] + 1e-12).mean()
            wrong = p
            wrong[np.arange(BATCH), labels[some]] -= 1
            back = wrong @ weights.T / ids.shape[1]
            weights -= rate * mean.T @ wrong / BATCH * 8
            constant -= rate * wrong.mean(axis=0)
            np.add.at(vectors, ids.ravel(), np.repeat(-rate * back, ids.shape[1], axis=0))
        if final:
            break
        loss = total / STEPS
        final = loss < TAUGHT or (turn and loss > 0.9 * before) or turn == ROUNDS - 1
        before = min(before, loss)
    return vectors, weights, constant


def calibrate(logits: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """The temperature with the best likelihood on held-out texts; the least confidence that is not rejected:
    half of what all but 1 % of the right ones have, and at most one half."""
    if not len(labels):
        return 1.0, 0.0
    grid = 2.0 ** np.arange(-10, 6.25, 0.25)
    loss = [-np.log(softmax(logits / t)[np.arange(len(labels)), labels] + 1e-12).mean() for t in grid]
    t = float(grid[int(np.argmin(loss))])
    p = softmax(logits / t)
    right = p.max(axis=1)[p.argmax(axis=1) == labels]
    return t, min(0.5, 0.5 * float(np.quantile(right, 0.01))) if len(right) else 0.0


def frequencies(buckets: np.ndarray, labels: np.ndarray, classes: int) -> np.ndarray:
    """Log frequency of each bucket among the draws of each language, with half a count added."""
    counts = np.stack([np.bincount(buckets[labels == k].ravel(), minlength=1 << BITS) for k in range(classes)]) + 0.5
    return np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)


def pieces(held: DataFrame, model: Model) -> pa.Table:
    """(label, cut, subwords, familiarity in its own language) of whole held-out texts (cut 0) and of a piece of each length in ``CUTS``."""
    shared = held.sparkSession.sparkContext.broadcast(model)
    layout = pa.schema([("label", pa.int32()), ("cut", pa.int32()), ("count", pa.float64()), ("mean", pa.float64())])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        index = {name: i for i, name in enumerate(model.languages)}
        for batch in slices(batches):
            labels = np.array([index.get(x, -1) for x in batch.column("label").to_pylist()])
            batch, labels = batch.filter(pa.array(labels >= 0)), labels[labels >= 0]
            texts = batch.column("text").to_pylist()
            for cut in (0, *CUTS):
                some = np.array([not cut or len(t) > cut for t in texts], bool)
                # From the middle, so that pieces are not all beginnings of sentences.
                parts = pa.array([t[len(t) // 2:][:cut] if cut and len(t) >= 2 * cut else t[:cut] if cut else t for t, s in zip(texts, some, strict=True) if s], pa.string())
                mean, count = model.familiarity(parts, labels[some])
                good = count > 0
                yield records({"label": labels[some][good], "cut": np.full(int(good.sum()), cut), "count": count[good], "mean": mean[good]}, layout)

    return held.select("label", "text").mapInArrow(measure, "label int, cut int, count double, mean double").toArrow()


def floors(table: pa.Table, classes: int) -> tuple[np.ndarray, np.ndarray] | None:
    """For each language, ascending log numbers of subwords and the least familiarity there."""
    label, cut, count, mean = (np.asarray(table.column(c)) for c in ("label", "cut", "count", "mean"))
    if not len(label):
        return None
    # Whole texts stand with the pieces of about their length.
    step = np.where(cut > 0, np.searchsorted(CUTS, cut), np.searchsorted(np.log(CUTS), np.log(np.maximum(count / len(ORDERS), 1)) - 0.7)).clip(0, len(CUTS) - 1)
    tail = NormalDist().inv_cdf(REJECTED)
    sizes, least = np.full((classes, len(CUTS)), np.nan), np.full((classes, len(CUTS)), np.nan)
    for c in range(len(CUTS)):
        here = step == c
        groups = [mean[here & (label == k)] for k in range(classes)]
        off = [g - g.mean() for g in groups if len(g) > 1]
        # What all languages have in common, for those with few held-out texts.
        common = float(np.sqrt(sum((g ** 2).sum() for g in off) / max(1, sum(len(g) - 1 for g in off)))) if off else np.nan
        for k, g in enumerate(groups):
            if len(g):
                spread = g.std(ddof=1) if len(g) >= LEAST_HELD else common * np.sqrt(1 + 1 / len(g))
                least[k, c] = min(g.mean() + tail * spread, np.quantile(g, REJECTED)) if np.isfinite(spread) else np.nan
                sizes[k, c] = np.log(np.median(count[here & (label == k)]))
    for k in range(classes):
        known = np.isfinite(least[k])
        if known.any():
            order = np.argsort(sizes[k][known], kind="stable")
            x, y = sizes[k][known][order], least[k][known][order]
            at = np.linspace(x[0], x[-1], len(CUTS))
            sizes[k], least[k] = (x, y) if known.all() else (at, np.interp(at, x, y))
    known = np.isfinite(least[:, 0])
    if not known.any():
        return None
    # A language without held-out texts takes the lowest floors of the others.
    sizes[~known], least[~known] = sizes[known].mean(axis=0), least[known].min(axis=0)
    return sizes, least


def learn(docs: DataFrame, learnable: Column | None = None, language: str = "lang", id_column: str = "doc_id", text_column: str = "text",
          per_language: int = PER_LANGUAGE, seed: int = 9) -> Model:
    """Fit on documents whose language is known. ``learnable`` is a condition on ``doc_id``."""
    ship(docs.sparkSession)
    docs = columns(docs, doc_id=docs[id_column].cast("long"), text=docs[text_column].cast("string"), label=docs[language].cast("string"))
    known = docs.select("doc_id", "label").filter("doc_id is not null and label is not null").distinct()
    known = known.filter(learnable) if learnable is not None else known
    chosen = small_or_none(learning.pick(known, "label", per_language, seed), per_language * MAX_LANGUAGES)
    if chosen is None:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    # An id that repeats under another language is learned under its own rows' language only.
    sample = learning.sample_texts(docs, chosen, F.col("text"), "languages", "label", per_language, seed, own=F.col("label"))
    sample = sample.withColumn("held", F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.lit(5)) == 0)
    table = draws(sample, seed)
    full = np.asarray(table.column("buckets").combine_chunks().value_lengths()) == DRAWN
    table = table.filter(pa.array(full)).combine_chunks()
    languages = sorted(set(table.column("label").to_pylist()))
    if not languages:
        return Model([], np.zeros((0, 1 << BITS)), np.zeros(0))
    index = {name: i for i, name in enumerate(languages)}
    labels = np.array([index[x] for x in table.column("label").to_pylist()])
    buckets = np.asarray(table.column("buckets").combine_chunks().flatten()).reshape(-1, DRAWN).astype(np.int64)
    held = np.asarray(table.column("held"))
    # Languages with few texts are learned from all of them.
    small = (np.bincount(labels) < 20) | (np.bincount(labels, ~held) == 0)
    held = held & ~small[labels]
    vectors, weights, constant = train(buckets[~held], labels[~held], len(languages), seed)
    logits = np.ascontiguousarray((vectors @ weights).T.astype(np.float32))
    model = Model(languages, logits, constant, usual=frequencies(buckets[~held], labels[~held], len(languages)))
    average = logits[:, buckets[held]].mean(axis=2).T + constant
    model.temperature, model.least = calibrate(average, labels[held])
    measured = [name for name, few in zip(languages, small.tolist(), strict=True) if not few]
    model.floors = floors(pieces(sample.filter(F.col("held") & F.col("label").isin(measured)), model), len(languages)) if held.any() else None
    return model


def identify(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Language, confidence and rejection of every whole text; all input columns stay behind them."""
    shared = ship(docs.sparkSession).sparkContext.broadcast(model)
    layout = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=SCORED_BYTES):
            names, confidence, rejected = shared.value.predict(batch.column("text"))
            yield records({"doc_id": batch.column("doc_id"), "lang_pred": names, "score": confidence, "rejected": rejected}, layout)

    rows = columns(docs, doc_id=docs[id_column].cast("long"), text=docs[text_column].cast("string"))
    return rows.mapInArrow(predict, "doc_id long, lang_pred string, score double, rejected boolean")


def accepted(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """The documents that are not rejected, with their columns as they are."""
    shared = ship(docs.sparkSession).sparkContext.broadcast(model)
    at = docs.columns.index(text_column)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(iter([batch]), at, SCORED_BYTES):
                _, _, rejected = shared.value.predict(part.column(at).cast(pa.string()))
                yield part.filter(pa.array(~rejected))

    return docs.mapInArrow(keep, docs.schema)
