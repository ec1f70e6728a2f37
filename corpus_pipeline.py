"""A training-data pipeline over ``documents``: language, near-duplicates, secrets, mix, sequences.

Every stage works on all rows that the one before it kept; it is written as Parquet and read
again. All but the last return the columns of the documents. Null and empty texts are
rejected by the first stage (they have no language); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plotwise.llm import langid, mixing, neardup, packing, secrets
from plotwise.llm.common import remainder, ship
from plotwise.session import staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned; those that the calibrated classifier rejects go."""
    ship(spark)
    return langid.accepted(docs, langid.learn(docs, learnable=remainder(F.col("doc_id")) != 2))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component: sets of five-word shingles, similar to 80 % or more."""
    ship(spark)
    return neardup.deduplicated(docs, size=5, percent=80)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced in their texts and their lengths put right."""
    out = secrets.redacted(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    ship(spark)
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents, placed into sequences of at most 1024 ids."""
    ship(spark)
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("near-duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: The first stage learns a model, which SQL cannot state; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
