"""Word count, and the words two corpora have in common."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgraph.functions.text import tokenize_delims, tokenize_words
from textgraph.operators.counts import both_counts, swap, without_stop_words, word_count


def count_words(df: DataFrame, text: str, stop: DataFrame | None = None, order: bool = False) -> DataFrame:
    """``(word, cnt)``: how often each word occurs that is no stop word."""
    counts = without_stop_words(tokenize_delims(df, text), stop, word_count)
    return counts.orderBy("word") if order else counts


def common_words(a: DataFrame, b: DataFrame, stop: DataFrame | None = None, text: str = "text") -> DataFrame:
    """``(cnt, word)``: words of both corpora, most frequent first.

    ``cnt`` is the smaller of the two counts. Equal counts go by word.
    """
    tokens = tokenize_words(a, text).withColumn("side", F.lit(1)).unionByName(
        tokenize_words(b, text).withColumn("side", F.lit(2))
    )
    return swap(without_stop_words(tokens, stop, both_counts)).orderBy(F.desc("cnt"), "word")
