"""Joins with a term list: stop words, query words, item ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_TERMS = 1_000_000
MAX_TERM_BYTES = 64 * 1024 * 1024


def is_small(terms: DataFrame, max_terms: int = MAX_TERMS, max_bytes: int = MAX_TERM_BYTES) -> bool:
    """Whether a term list may be broadcast. Runs one aggregate over the list."""
    word = F.col(terms.columns[0]).cast("string")
    size = terms.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length(word)), F.lit(0)).alias("bytes")).first()
    return size["n"] <= max_terms and size["bytes"] <= max_bytes


def drop_terms(df: DataFrame, terms: DataFrame, col: str = "word", small: bool | None = None) -> DataFrame:
    """The rows whose ``col`` is not in the one-column list ``terms``."""
    return _match(df, terms, col, "left_anti", small)


def keep_terms(df: DataFrame, terms: DataFrame, col: str = "word", small: bool | None = None) -> DataFrame:
    """The rows whose ``col`` is in the one-column list ``terms``."""
    return _match(df, terms, col, "left_semi", small)


def _match(df: DataFrame, terms: DataFrame, col: str, how: str, small: bool | None) -> DataFrame:
    listed = terms.select(F.col(terms.columns[0]).alias(col))
    if small is None:
        small = is_small(terms)
    if small:
        return df.join(F.broadcast(listed), col, how).select(*df.columns)
    # A list too long to broadcast goes by a plain shuffle join, whose large
    # partitions adaptive execution splits, also those of one frequent term.
    return df.join(listed.distinct(), col, how).select(*df.columns)
