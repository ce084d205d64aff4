"""tf-idf weights, their normalisation, and the relevance of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textgraph.functions.numbers import ieee_divide
from textgraph.functions.text import MARK
from textgraph.operators.counts import doc_freq
from textgraph.operators.skew import HOT_FLOOR, attach_totals
from textgraph.operators.terms import is_small, keep_terms


def document_count(df: DataFrame) -> Column:
    """The number of documents in ``df``, as a subquery."""
    return df.agg(F.count_distinct("doc_id")).scalar()


def marked_count(df: DataFrame) -> Column:
    """The number of documents by the document frequency of their mark, as a subquery."""
    # A filter would move below the counts, and make another shuffle of them.
    return df.agg(F.max(F.when(F.col("word") == MARK, F.col("df")))).scalar()


def tf_idf(
    tf: DataFrame,
    n_docs: int | Column | None = None,
    hot_floor: int = HOT_FLOOR,
    marked: bool = False,
    of: DataFrame | None = None,
) -> DataFrame:
    """``(doc_id, word, tf_idf)`` with ``(1 + ln tf) * ln(N / df)``.

    N is ``n_docs``, or else the number of documents of ``tf``: with ``marked``, of
    ``document_terms(.., marked=True)``, all documents, also those without a word. Nothing is
    smoothed: a word of all N documents weighs 0, and with a fixed N below ``df`` the weight is
    negative. With ``of``, which has one row ``(doc_id)`` for each document wanted, only those are
    weighed; N and the frequencies stay those of all.
    """
    freq = doc_freq(tf)
    if n_docs is None:
        # Reading tf makes this share the shuffle of tf, as in doc_freq.
        n_docs = marked_count(freq) if marked else document_count(tf.where("tf > 0"))
    n = F.lit(n_docs) if isinstance(n_docs, int) else n_docs
    wanted = tf
    if of is not None:
        # Not a semi join or plain equality, which Spark would move below the counts of tf, so that
        # their shuffle would not be that of the frequencies.
        ids = of.select(F.col("doc_id").alias("_wanted"))
        wanted = tf.join(ids, F.col("doc_id").eqNullSafe(F.col("_wanted"))).select(*tf.columns)
    if marked:
        wanted = wanted.where(F.when(F.col("word") == MARK, 0).otherwise(F.col("tf")) > 0)
    weighed = attach_totals(wanted, freq, "word", "df", hot_floor)
    weight = (1 + F.ln("tf")) * F.ln(n / F.col("df"))
    return weighed.select("doc_id", "word", weight.alias("tf_idf"))


def documents_with(tf: DataFrame, query: DataFrame, small: bool | None = None) -> DataFrame:
    """``(doc_id)`` of the documents that hold a word of the query."""
    words = query.select(F.col(query.columns[0]).alias("_word")).distinct()
    if is_small(query) if small is None else small:
        words = F.broadcast(words)
    # Reading tf makes this share its shuffle, as in doc_freq.
    return tf.where("tf > 0").join(words, F.col("word").eqNullSafe(F.col("_word"))).select("doc_id").distinct()


def l2_normalize(tfidf: DataFrame, hot_floor: int = HOT_FLOOR) -> DataFrame:
    """``(doc_id, word, norm)``: each weight over the length of its document.

    A document whose weights are all 0 has length 0 and NaN throughout.
    """
    lengths = tfidf.groupBy("doc_id").agg(
        F.sum(F.col("tf_idf") * F.col("tf_idf")).alias("squares"), F.count("tf_idf").alias("terms")
    )
    norm = ieee_divide(F.col("tf_idf"), F.sqrt("squares"))
    return attach_totals(tfidf, lengths, "doc_id", "terms", hot_floor).select("doc_id", "word", norm.alias("norm"))


def relevance(norm: DataFrame, query: DataFrame) -> DataFrame:
    """``(doc_id, relevance)``: the sum of normalised weights of the query words.

    Documents without any of the words have no row.
    """
    return keep_terms(norm, query).groupBy("doc_id").agg(F.sum("norm").alias("relevance"))


def query_relevance(tfidf: DataFrame, query: DataFrame, small: bool | None = None) -> DataFrame:
    """``relevance(l2_normalize(tfidf), query)`` in one aggregate.

    The length of a document is the same for all of its words, so it divides
    the sum instead of each weight, and nothing is joined back. A query that is
    not ``small`` enough to broadcast marks its words by a shuffle join.
    """
    weight = F.col("tf_idf")
    asked = F.col("asked").isNotNull()
    words = query.select(F.col(query.columns[0]).alias("word"), F.lit(True).alias("asked")).distinct()
    if is_small(query) if small is None else small:
        words = F.broadcast(words)
    marked = tfidf.join(words, "word", "left")
    sums = marked.groupBy("doc_id").agg(
        F.sum(weight * weight).alias("squares"),
        F.sum(F.when(asked, weight)).alias("matched"),
        F.count_if(asked).alias("hits"),
    )
    return sums.where("hits > 0").select(
        "doc_id", ieee_divide(F.col("matched"), F.sqrt("squares")).alias("relevance")
    )


def top_k(scores: DataFrame, k: int = 3, pad: bool = False, digits: int | None = None) -> DataFrame:
    """``(rank, doc_id, relevance)``: the k best documents of positive relevance.

    Equal scores go by ``doc_id``. Exact copies may differ in the last bit of a
    floating sum; ``digits`` compares scores rounded to so many places. ``pad``
    fills up to k rows with blank ids, and makes ``doc_id`` text.
    """
    score = F.col("relevance")
    # NaN counts as greater than any number in Spark, so it has a test of its own.
    found = scores.where((score > 0) & ~F.isnan(score)).select("doc_id", "relevance")
    order = [(score if digits is None else F.round(score, digits)).desc(), F.col("doc_id").asc()]
    best = found.orderBy(*order).limit(k)
    # The window sees no more than k rows.
    ranked = best.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    if not pad:
        return ranked.select("rank", "doc_id", "relevance")
    slots = scores.sparkSession.range(1, k + 1).select(F.col("id").alias("rank"))
    return slots.join(ranked, "rank", "left").select(
        "rank",
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"),
        F.coalesce("relevance", F.lit(0.0)).alias("relevance"),
    )
