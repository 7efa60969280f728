"""Registered queries: a name, a Spark callable and, where SQL can say it, an oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..scale import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table for costly work per row: dealt out when the file has too few splits."""
    return spread(table(spark, sf_dir, name))


def sql_draw(key: str) -> str:
    """The hash draw of `functions.hashing` as SQL text."""
    return f"(('0x' || substr(md5({key}), 1, 8))::BIGINT)"


def sql_alpha(col: str) -> str:
    """The alphabetic tokenizer as SQL text."""
    words = f"string_split_regex(lower({col}), '[^\\p{{L}}\\p{{N}}_]+')"
    return f"list_filter({words}, lambda t: regexp_full_match(t, '[a-z]+'))"


def sql_tokens(col: str = "text", key: str = "doc_id", source: str = "documents") -> str:
    """Subquery (key, pos, term) of a text table, pos from 0."""
    return (
        f"(SELECT {key}, generate_subscripts(l, 1) - 1 AS pos, unnest(l) AS term "
        f"FROM (SELECT {key}, {sql_alpha(col)} AS l FROM {source}))"
    )
