"""Queries of these operators over whole tables, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plotwise.llm import alignment, arc, ctw, idfile, langid, merkle, mixing, neardup, packing, quality, secrets, topk, toxicity
from plotwise.llm.common import remainder, ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = lambda spark, folder: fn(ship(spark), folder)
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of all documents, placed into sequences of at most 1024 ids."""
    placed = packing.pack_documents(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_tokens", "row_id")


@query
def op2_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Spans of secrets in every document; the base kinds come first among the rules."""
    found = secrets.scan(table(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s["order"] < len(secrets.BASE))
    counts = [F.size(F.filter(F.transform("spans", lambda s: s["kind"]), lambda k: k == kind)).cast("long").alias(f"n_{kind}")  # noqa: B023
              for kind in (r.kind for r in secrets.BASE)]
    return found.select("doc_id", *counts, F.sha2(secrets.listed(base), 256).alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans"))


ORACLES["op2_secrets"] = secrets.oracle()


@query
def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Words that a mix of all sources takes from each document."""
    return mixing.mixed_rows(table(spark, folder, "documents"))


@query
def op4_id_files(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as read back from files of coded ids."""
    return idfile.round_trip(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


@query
def op8_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The 10 best candidates of every vector whose id is divisible by 100."""
    return topk.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


ORACLES["op8_topk"] = """
WITH v AS (
  SELECT row_number() OVER () AS row_id, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS vector
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.row_id AS query_row, q.vec_id AS query_id, x.vec_id, x.row_id,
         CAST(list_sum(list_transform(range(1, len(x.vector) + 1), lambda i: x.vector[i] * q.vector[i])) AS BIGINT) AS score
  FROM v q JOIN v x ON q.row_id <> x.row_id
  WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_row ORDER BY score DESC, vec_id, row_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query
def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Records of all pages, converted from ARC files and read back from WARC files."""
    return arc.round_trip(table(spark, folder, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op9_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM f
"""


@query
def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts and verdict of every document; documents labelled as good are the trusted ones."""
    docs = table(spark, folder, "documents")
    trusted = table(spark, folder, "labels").filter("quality = 1").select("doc_id")
    return quality.judge(docs, quality.learn(docs, trusted))


@query
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document; rows whose crc32 leaves remainder 2 are held out from learning."""
    docs = table(spark, folder, "documents")
    model = toxicity.learn(docs, table(spark, folder, "labels"), learnable=remainder(F.col("doc_id")) != 2)
    return toxicity.score(docs, model).select(
        "doc_id", (remainder(F.col("doc_id")) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document; rows whose crc32 leaves remainder 2 are held out from learning."""
    docs = table(spark, folder, "documents")
    model = langid.learn(docs, learnable=remainder(F.col("doc_id")) != 2)
    return langid.identify(docs, model).select(
        "doc_id", (remainder(F.col("doc_id")) == 2).alias("held_out"), "lang_pred", "score", "rejected")


@query
def op5_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose sets of 3-word shingles are similar to 85 % or more."""
    return neardup.near_duplicates(table(spark, folder, "documents"), size=3, percent=85)


@query
def op12_merkle(spark: SparkSession, folder: str) -> DataFrame:
    """Proofs of all documents; half of them are found without their line breaks."""
    docs = table(spark, folder, "documents")
    touched = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 2 == 0
    found = {"text": F.when(touched, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))}
    proofs = merkle.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], found=found)
    return proofs.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@query
def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Two tokenizers' tokens of every document, aligned by bytes and counted over the corpus."""
    found = alignment.alignment(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query
def op13_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Log probabilities of every document; rows whose crc32 leaves remainder 2 modulo 7 are not learned from."""
    scored = ctw.score(table(spark, folder, "documents"), remainder(F.col("doc_id"), 7) != 2)
    return scored.select("doc_id", (remainder(F.col("doc_id"), 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score", "bits_per_byte")


def _written(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_written(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"


# The last bit of crc32, with its polynomial reversed, over the decimal digits of an id.
_CRC = """list_reduce(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), ''), ''), lambda c: CAST(ord(c) AS BIGINT)),
  lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, 3988292384 * (x & 1))), 4294967295)"""

ORACLES["op12_merkle"] = f"""
WITH RECURSIVE leaves AS (
  SELECT row_number() OVER () AS row_id, doc_id, source, {_leaf("text")} AS leaf,
         {_leaf(f"CASE WHEN (4294967295 - {_CRC}) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END")} AS now
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, row_id) - 1 AS slot FROM leaves),
nodes AS (
  SELECT 0 AS level, source, slot, leaf AS digest, count(*) OVER (PARTITION BY source) AS n FROM placed
  UNION ALL
  SELECT level + 1, source, slot // 3, sha256(string_agg(digest, '' ORDER BY slot)), (n + 2) // 3
  FROM nodes WHERE n > 1 GROUP BY level, source, slot // 3, n),
groups AS (
  SELECT source, digest, row_number() OVER (ORDER BY CAST(source AS BLOB) NULLS FIRST) - 1 AS slot, count(*) OVER () AS n FROM nodes WHERE n = 1),
over_groups AS (
  SELECT 0 AS level, slot, digest, n FROM groups
  UNION ALL
  SELECT level + 1, slot // 3, sha256(string_agg(digest, '' ORDER BY slot)), (n + 2) // 3
  FROM over_groups WHERE n > 1 GROUP BY level, slot // 3, n),
climb AS (
  SELECT row_id, p.doc_id, p.source, p.leaf, p.slot, CAST(0 AS BIGINT) AS level, FALSE AS outer_tree, p.now AS folded, '' AS path, n.n
  FROM placed p JOIN nodes n ON n.level = 0 AND n.source IS NOT DISTINCT FROM p.source AND n.slot = p.slot
  UNION ALL
  (WITH all_nodes AS (
     SELECT FALSE AS outer_tree, level, source, slot, digest FROM nodes
     UNION ALL SELECT TRUE, level, NULL, slot, digest FROM over_groups)
   SELECT c.row_id, any_value(c.doc_id), any_value(c.source), any_value(c.leaf), any_value(c.slot) // 3, any_value(c.level) + 1, any_value(c.outer_tree),
          sha256(string_agg(CASE WHEN a.slot = c.slot THEN c.folded ELSE a.digest END, '' ORDER BY a.slot)),
          any_value(c.path) || coalesce(string_agg(a.digest, '' ORDER BY a.slot) FILTER (a.slot <> c.slot), ''), (any_value(c.n) + 2) // 3
   FROM climb c JOIN all_nodes a ON a.outer_tree = c.outer_tree AND a.level = c.level AND a.slot // 3 = c.slot // 3
        AND (c.outer_tree OR a.source IS NOT DISTINCT FROM c.source)
   WHERE c.n > 1 GROUP BY c.row_id
   UNION ALL
   SELECT c.row_id, c.doc_id, c.source, c.leaf, g.slot, 0, TRUE, c.folded, c.path, g.n
   FROM climb c JOIN groups g ON g.source IS NOT DISTINCT FROM c.source
   WHERE c.n = 1 AND NOT c.outer_tree)),
tops AS (SELECT digest FROM over_groups WHERE n = 1)
SELECT c.doc_id, c.leaf, g.digest AS subroot, t.digest AS root, sha256(c.path) AS proof_sha256, c.folded AS folded_root, c.folded = t.digest AS verified
FROM climb c JOIN groups g ON g.source IS NOT DISTINCT FROM c.source CROSS JOIN tops t
WHERE c.outer_tree AND c.n = 1
"""
