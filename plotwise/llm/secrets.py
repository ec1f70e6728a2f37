"""Secret scans with a trigram inverted index, in DataFrame functions only.

Each rule's regular expression gives a Boolean query of trigrams that every match must hold
(in lower case): an AND over parts of the expression, of an OR over the texts that such a
part can be, of all the trigrams of that text. The index lists, per block of documents, the
documents that hold a trigram; postings are intersected and united as the queries say, and
only the candidates that come out are verified by the expression. A rule without a
mandatory trigram is run over every text.

Blocks hold about ``BLOCK_ROWS`` documents whatever the input's size, so no list grows with
the data. Documents are keyed by a hash of id and text: rows that share a key are candidates
together, and each is verified on its own text.

Null and empty texts have no spans. Rows that repeat are scanned alike; an empty table gives
an empty result. Positions count code points.
"""

from __future__ import annotations

import re._constants as rc
import re._parser as rp  # the standard library's reading of an expression
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotwise.llm.common import columns
from plotwise.session import staged

#: Candidates (16 bytes each) that are sent to every executor at most; more meet the texts in a shuffle.
MAX_SENT = 1_000_000

BLOCK_ROWS = 4096
#: Texts that a part of an expression may stand for, and characters of a set, before the part ends there.
MOST_TEXTS, MOST_CHARACTERS = 64, 8
SPANS = "array<struct<start:bigint,order:int,end:bigint,body:bigint>>"
#: Marks around matches; where a text holds one, it is scanned with another control character in its place.
OPEN, MIDDLE, CLOSE, OTHER = "\x01", "\x02", "\x03", "\x04"


@dataclass(frozen=True)
class Rule:
    """Matches of ``head`` and ``body``; those with a shorter body than ``least`` are dropped, but still take their place."""

    kind: str
    head: str
    body: str
    least: int = 1

    @property
    def pattern(self) -> str:
        return f"({self.head})({self.body})"


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# The base kinds in their order, then well-known formats of keys.
NAMES = "|".join(map(either_case, ("password", "passwd", "secret", "token", "api_?key")))
BASE = (
    Rule("assign", rf"""(?:{NAMES})["']?\x20*[:=]\x20*["']?""", "[A-Za-z0-9+/_.=-]+", 6),
    Rule("access", "", "AKIA[A-Z0-9]+", 20),
    Rule("hex", "", "[0-9a-f]+", 24),
)
MORE = (
    Rule("github", "", "gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("slack", "", "xox[abprs]-[A-Za-z0-9-]+", 15),
    Rule("google", "", "AIza[A-Za-z0-9_-]+", 39),
    Rule("jwt", "", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40),
    Rule("pem", "", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 1),
)
RULES = BASE + MORE

Query = list[list[frozenset[str]]]  # all of: any of: all these trigrams


# -- trigram queries

def trigram_query(pattern: str) -> Query:
    """What every match must hold; empty if nothing is mandatory."""
    query: Query = []
    last = _walk(rp.parse(pattern), {""}, query)
    _end(last, query)
    return query


def _end(texts: set[str], query: Query) -> set[str]:
    """A part of the expression ends: each of its texts gives its trigrams, if all have any."""
    grams = {frozenset(t[i:i + 3] for i in range(len(t) - 2)) for t in texts}
    if frozenset() not in grams:
        query.append(sorted((g for g in grams if not any(h < g for h in grams)), key=sorted))
    return {""}


def _then(texts: set[str], more: set[str], query: Query) -> set[str]:
    if len(texts) * len(more) > MOST_TEXTS:
        texts = _end(texts, query)
    return {a + b for a in texts for b in more}


def _exact(items) -> set[str] | None:
    """The texts that a short expression stands for, or None if it is open."""
    query: Query = []
    marker = "\0"  # survives only if no part ended
    texts = _walk(items, {marker}, query)
    return {t[1:] for t in texts} if not query and all(t.startswith(marker) for t in texts) else None


def _walk(items, texts: set[str], query: Query) -> set[str]:
    for kind, value in items:
        if kind is rc.LITERAL:
            texts = _then(texts, {chr(value).lower()}, query)
        elif kind is rc.SUBPATTERN:
            texts = _walk(value[3], texts, query)
        elif kind is rc.IN and (some := _characters(value)) is not None:
            texts = _then(texts, some, query)
        elif kind is rc.BRANCH and all((e := _exact(x)) is not None for x in value[1]):
            texts = _then(texts, set().union(*(_exact(x) for x in value[1])), query)
        elif kind in (rc.MAX_REPEAT, rc.MIN_REPEAT) and value[1] == 1 and (e := _exact(value[2])) is not None:
            texts = _then(texts, e | {""} if value[0] == 0 else e, query)
        elif kind in (rc.MAX_REPEAT, rc.MIN_REPEAT) and value[0] > 0 and (e := _exact(value[2])) is not None:
            _end(_then(texts, e, query), query)
            texts = {""}
        else:
            texts = _end(texts, query)
    return texts


def _characters(items) -> set[str] | None:
    out: set[str] = set()
    for kind, value in items:
        if kind is rc.LITERAL:
            out.add(chr(value).lower())
        elif kind is rc.RANGE and value[1] - value[0] < MOST_CHARACTERS:
            out |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return out if len(out) <= MOST_CHARACTERS else None


# -- index and candidates

def keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``key`` and ``text`` beside the row's own columns (``own_`` and their place)."""
    text = docs[text_column].cast("string")
    return columns(docs, **{f"own_{i}": c for i, c in enumerate(docs.columns)}, text=text,
                   key=F.xxhash64(docs[id_column].cast("string"), text))


def build_index(rows: DataFrame, grams: list[str], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(block, trigram, postings): the keys of a block's texts that hold a trigram; written to the shared folder."""
    blocks = max(1, -(-rows.count() // block_rows))
    folded = rows.select("key", F.lower("text").alias("folded"))
    # One conditional per trigram, so that the folded text is made once.
    held = F.array_compact(F.array(*[F.when(F.contains("folded", F.lit(g)), F.lit(i)) for i, g in enumerate(grams)]))
    pairs = folded.select("key", F.explode(held).alias("trigram")).withColumn("block", F.pmod("key", F.lit(blocks)))
    return staged(pairs.groupBy("block", "trigram").agg(F.collect_set("key").alias("postings")), "trigrams")


def candidates(index: DataFrame, grams: list[str], queries: dict[int, Query]) -> DataFrame:
    """(key, rules): a bit per rule for which a text is a candidate."""
    number = {g: i for i, g in enumerate(grams)}
    lists = index.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "postings"))).alias("lists"))

    def postings(gram: str) -> Column:
        return F.coalesce(F.col("lists")[number[gram]], F.array().cast("array<long>"))

    def fold(parts: list[Column], by) -> Column:
        out = parts[0]
        for p in parts[1:]:
            out = by(out, p)
        return out

    found = []
    for rule, query in queries.items():
        every = [fold([fold([postings(g) for g in sorted(grams_)], F.array_intersect) for grams_ in any_], F.array_union) for any_ in query]
        found.append(F.struct(F.lit(1 << rule).alias("bit"), fold(every, F.array_intersect).alias("keys")))
    rows = lists.select(F.explode(F.array(*found)).alias("found")).select("found.bit", F.explode("found.keys").alias("key"))
    return rows.groupBy("key").agg(F.bit_or("bit").alias("rules"))


# -- verification

def parts_of(text: Column, rule: Rule) -> Column:
    """The text cut before each match; a match is head, mark, body, mark."""
    return F.split(F.regexp_replace(text, F.lit(rule.pattern), F.lit(f"{OPEN}$1{MIDDLE}$2{CLOSE}")), OPEN, -1)


def safe(text: Column) -> Column:
    marks = OPEN + MIDDLE + CLOSE
    held = F.contains(text, F.lit(OPEN)) | F.contains(text, F.lit(MIDDLE)) | F.contains(text, F.lit(CLOSE))
    return F.when(held, F.translate(text, marks, OTHER * 3)).otherwise(text)


def spans_of(parts: Column, order: int, rule: Rule) -> Column:
    """(start, order, end, start of the body) of each match that is long enough."""
    at = F.element_at

    def step(state: Column, part: Column) -> Column:
        # head, body and what follows
        head = F.length(F.substring_index(part, MIDDLE, 1)).cast("long")
        body = F.length(F.substring_index(F.substring_index(part, CLOSE, 1), MIDDLE, -1)).cast("long")
        start = state["at"]
        span = F.struct(start.alias("start"), F.lit(order).alias("order"), (start + head + body).alias("end"), (start + head).alias("body"))
        found = F.when(body >= rule.least, F.array_append(state["spans"], span)).otherwise(state["spans"])
        return F.struct((start + F.length(part) - 2).cast("long").alias("at"), found.alias("spans"))

    first = F.struct(F.length(at(parts, 1)).cast("long").alias("at"), F.array().cast(SPANS).alias("spans"))
    return F.aggregate(F.slice(parts, F.lit(2), F.size(parts)), first, step, lambda s: s["spans"])


def with_candidates(docs: DataFrame, rules: tuple[Rule, ...], id_column: str, text_column: str, block_rows: int) -> tuple[DataFrame, list[Column]]:
    """Rows with their text, and for each rule whether it is to be run on a row."""
    rows = keyed(docs, id_column, text_column)
    queries = {i: q for i, r in enumerate(rules) if (q := trigram_query(r.pattern))}
    grams = sorted({g for q in queries.values() for any_ in q for all_ in any_ for g in all_})
    if not queries:
        return rows.withColumn("rules", F.lit(0).cast("long")), [F.lit(True)] * len(rules)
    index = build_index(rows.select("key", "text"), grams, block_rows)
    found = staged(candidates(index, grams, queries), "candidates")
    rows = rows.join(F.broadcast(found) if found.count() <= MAX_SENT else found, "key", "left").withColumn("rules", F.coalesce("rules", F.lit(0)).cast("long"))
    return rows, [F.col("rules").bitwiseAND(F.lit(1 << i)) != 0 if i in queries else F.lit(True) for i in range(len(rules))]


def scanned(docs: DataFrame, rules: tuple[Rule, ...], id_column: str, text_column: str, block_rows: int) -> DataFrame:
    """Rows (``own_`` columns and ``text``) with their ``found``: (start, order, end, body), by start and then by rule."""
    rows, wanted = with_candidates(docs, rules, id_column, text_column, block_rows)
    own = [c for c in rows.columns if c.startswith("own_")]
    rows = rows.select(*own, "text", "rules", safe(F.coalesce("text", F.lit(""))).alias("scan"))
    marked = rows.select(*own, "text", *[F.when(w, parts_of(F.col("scan"), r)).alias(f"parts_{i}") for i, (r, w) in enumerate(zip(rules, wanted, strict=True))])
    none = F.array().cast(SPANS)
    each = [F.when(F.size(f"parts_{i}") > 1, spans_of(F.col(f"parts_{i}"), i, r)).otherwise(none) for i, r in enumerate(rules)]
    return marked.select(*own, "text", F.array_sort(F.concat(*each)).alias("found"))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_column: str = "doc_id", text_column: str = "text",
         block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``doc_id`` and ``spans`` of every row: (start, order, end, kind), by start and then by the rules' order."""
    rows = scanned(docs, rules, id_column, text_column, block_rows)
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    spans = F.transform("found", lambda s: F.struct(s["start"], s["order"], s["end"], kinds[s["order"]].alias("kind")))
    return rows.select(F.col(f"own_{docs.columns.index(id_column)}").alias("doc_id"), spans.alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_column: str = "doc_id", text_column: str = "text",
             instead: str = "[REDACTED]", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """All rows and columns, with the body of each match replaced in the text; bodies that overlap are replaced as one."""
    rows = scanned(docs, rules, id_column, text_column, block_rows)

    def step(state: Column, span: Column) -> Column:
        at = state["at"]
        more = F.concat(state["out"], F.substring(F.col("text"), (at + 1).cast("int"), (span["body"] - at).cast("int")), F.lit(instead))
        out = F.when(span["body"] >= at, more).otherwise(state["out"])
        return F.struct(F.greatest(at, span["end"]).alias("at"), out.alias("out"))

    first = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    text = F.aggregate("found", first, step, lambda s: F.concat(s["out"], F.substring(F.col("text"), (s["at"] + 1).cast("int"), F.length("text"))))
    rows = rows.withColumn("text", F.when(F.size("found") > 0, text).otherwise(F.col("text")))
    place = docs.columns.index(text_column)
    return rows.select(*[(F.col("text") if i == place else F.col(f"own_{i}")).alias(c) for i, c in enumerate(docs.columns)])


# -- the same in SQL

def oracle(rules: tuple[Rule, ...] = RULES, base: int = len(BASE)) -> str:
    """DuckDB SQL for the query: marks, cuts and sums up lengths in the same way, without an index."""
    def quoted(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    parts = []
    for i, r in enumerate(rules):
        cut = f"string_split(regexp_replace(t, {quoted(r.pattern)}, chr(1) || '\\1' || chr(2) || '\\2' || chr(3), 'g'), chr(1))"
        parts.append(f"SELECT rid, {i} AS ord, {quoted(r.kind)} AS kind, {r.least} AS least, {cut} AS parts FROM d")
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, translate(coalesce(text, ''), chr(1) || chr(2) || chr(3), chr(4) || chr(4) || chr(4)) AS t FROM documents),
cut AS ({' UNION ALL '.join(parts)}),
piece AS (SELECT rid, ord, kind, least, generate_subscripts(parts, 1) AS i, unnest(parts) AS part FROM cut WHERE len(parts) > 1),
sized AS (SELECT *, CASE WHEN i = 1 THEN length(part) ELSE length(part) - 2 END AS size,
  length(split_part(part, chr(2), 1)) AS head, length(split_part(split_part(part, chr(3), 1), chr(2), 2)) AS body FROM piece),
placed AS (SELECT *, CAST(coalesce(sum(size) OVER (PARTITION BY rid, ord ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM sized),
span AS (SELECT rid, ord, start, kind || ':' || start || ':' || (start + head + body) AS said FROM placed WHERE i > 1 AND body >= least),
per AS (SELECT rid, count(*) FILTER (ord = 0) AS n_assign, count(*) FILTER (ord = 1) AS n_access, count(*) FILTER (ord = 2) AS n_hex,
  string_agg(said, ',' ORDER BY start, ord) FILTER (ord < {base}) AS base, string_agg(said, ',' ORDER BY start, ord) AS spans FROM span GROUP BY rid)
SELECT doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access,
  CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN per USING (rid)
"""
