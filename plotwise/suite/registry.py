"""Registration of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; without SQL only its rows can be checked."""
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sql_pick(key: str, words: Sequence[str]) -> str:
    """One of the words by a key that is not negative; a CASE runs far faster than splitting a list for each row."""
    return sql_case(f"({key}) % {len(words)}", dict(enumerate(words)))


def sql_case(key: str, mapping: dict, default: str = "NULL") -> str:
    """CASE expression of a small dictionary."""
    def lit(v):
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else repr(v)
    arms = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in mapping.items())
    return f"(CASE {key} {arms} ELSE {default} END)"
