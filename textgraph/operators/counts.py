"""Counts of words: in all, per document, and in two corpora."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgraph.operators.terms import drop_terms, is_small


def word_count(tokens: DataFrame, order: bool = False) -> DataFrame:
    """``(word, cnt)`` of a token table; ``order`` sorts by word."""
    counts = tokens.groupBy("word").agg(F.count("*").alias("cnt"))
    return counts.orderBy("word") if order else counts


def term_freq(tokens: DataFrame) -> DataFrame:
    """``(doc_id, word, tf)`` of a token table ``(doc_id, word)``."""
    return tokens.groupBy("doc_id", "word").agg(F.count("*").alias("tf"))


def doc_freq(tf: DataFrame) -> DataFrame:
    """``(word, df)``: the number of documents that hold each word."""
    # Reading tf, which is never 0, keeps the input the same as that of the
    # other users of tf, so that Spark runs its shuffle once for all of them.
    return tf.groupBy("word").agg(F.count_if(F.col("tf") > 0).alias("df"))


def both_counts(tokens: DataFrame) -> DataFrame:
    """``(word, cnt)`` for words on side 1 and side 2, with the smaller count."""
    sides = tokens.groupBy("word").agg(
        F.count_if(F.col("side") == 1).alias("first"), F.count_if(F.col("side") == 2).alias("second")
    )
    both = (F.col("first") > 0) & (F.col("second") > 0)
    return sides.where(both).select("word", F.least("first", "second").alias("cnt"))


def swap(counts: DataFrame) -> DataFrame:
    """``(cnt, word)`` from ``(word, cnt)``."""
    return counts.select("cnt", "word")


def without_stop_words(
    tokens: DataFrame, stop: DataFrame | None, count: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """``count(tokens)`` less the stop words.

    A small list drops tokens before the shuffle. A long one is joined with the
    counts, in which a frequent word is one row, or one per document.
    """
    if stop is None:
        return count(tokens)
    if is_small(stop):
        return count(drop_terms(tokens, stop, small=True))
    return drop_terms(count(tokens), stop, small=False)
