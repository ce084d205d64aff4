"""Word count and common words over ``documents`` and ``benchmark``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgraph_checks.tables import STOP, stop_words, texts
from textgraph import common_words, count_words, order_report, tokenize_words


def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_words(texts(spark, sf_dir, "documents"), "text", stop_words(spark))


def word_count_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_words(texts(spark, sf_dir, "documents"), "text", stop_words(spark), order=True)


def common(spark: SparkSession, sf_dir: str) -> DataFrame:
    return common_words(texts(spark, sf_dir, "documents"), texts(spark, sf_dir, "benchmark"), stop_words(spark))


def common_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same words by bag intersection of the two token tables."""
    a = tokenize_words(texts(spark, sf_dir, "documents"), "text")
    b = tokenize_words(texts(spark, sf_dir, "benchmark"), "text")
    return a.intersectAll(b).groupBy("word").agg(F.count("*").alias("cnt"))


DELIMITED = f"""
SELECT word, count(*) AS cnt FROM (
  SELECT lower(token) AS word FROM (
    SELECT unnest(regexp_split_to_array(text, '[ .!?;\\[\\],''\\r\\n\\f]+')) AS token FROM documents)
  WHERE token <> '')
WHERE word NOT IN ({STOP}) GROUP BY word
"""


def words_of(name: str) -> str:
    return f"""
SELECT word FROM (SELECT unnest(regexp_split_to_array(lower(text), '[^a-z0-9_]+')) AS word FROM {name})
WHERE word <> ''
"""


QUERIES = {
    "word_count": word_count,
    "word_count_sorted": word_count_sorted,
    "common_words": common,
    "common_words_intersect": common_intersect,
    "word_count_order": lambda spark, sf: order_report(word_count_sorted(spark, sf), {"word": False}),
    "common_words_order": lambda spark, sf: order_report(common(spark, sf), {"cnt": True, "word": False}),
}
COMMON = f"""
WITH a AS (SELECT word, count(*) AS n FROM ({words_of("documents")}) GROUP BY word),
     b AS (SELECT word, count(*) AS n FROM ({words_of("benchmark")}) GROUP BY word)
SELECT least(a.n, b.n) AS cnt, a.word AS word FROM a JOIN b ON a.word = b.word WHERE a.word NOT IN ({STOP})
"""
IN_ORDER = "SELECT count(*) AS rows, 0::BIGINT AS out_of_order FROM"
SQL = {
    "word_count": DELIMITED,
    "word_count_sorted": DELIMITED,
    "common_words": COMMON,
    "word_count_order": f"{IN_ORDER} ({DELIMITED})",
    "common_words_order": f"{IN_ORDER} ({COMMON})",
    "common_words_intersect": f"""
SELECT word, count(*) AS cnt FROM (({words_of("documents")}) INTERSECT ALL ({words_of("benchmark")})) GROUP BY word
""",
}
