"""Document search by tf-idf."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgraph.functions.text import MARK, tokenize_words
from textgraph.operators.counts import term_freq, without_stop_words
from textgraph.operators.terms import is_small
from textgraph.operators.weights import (
    documents_with,
    query_relevance,
    tf_idf,
    top_k,
)


def without_mark(terms: DataFrame) -> DataFrame:
    """A term list less a line that is ``MARK``, which is no word of any text."""
    return terms.where(F.col(terms.columns[0]) != MARK)


def document_terms(docs: DataFrame, stop: DataFrame | None = None, text: str = "text", marked: bool = False) -> DataFrame:
    """``(doc_id, word, tf)`` of documents ``(doc_id, text)``, in one or more rows each.

    ``marked`` adds a row with the word ``MARK`` for each document, also for one without words, so
    that the number of documents comes with the frequencies of their words.
    """
    tokens = tokenize_words(docs, text, "doc_id", marked=marked)
    return without_stop_words(tokens, without_mark(stop) if marked and stop is not None else stop, term_freq)


def score_documents(
    docs: DataFrame,
    query: DataFrame,
    stop: DataFrame | None = None,
    n_docs: int | None = None,
    text: str = "text",
) -> DataFrame:
    """``(doc_id, relevance)`` of the documents that hold a query word.

    N is ``n_docs``, or else the number of documents, counted by their marks in the one scan
    of the texts. Document frequencies are of all documents; weights and lengths are
    made for those with a query word alone. Query words are matched
    as they stand; one with an upper-case letter finds nothing.
    """
    tf = document_terms(docs, stop, text, marked=True)
    query = without_mark(query)
    small = is_small(query)
    weights = tf_idf(tf, n_docs, marked=True, of=documents_with(tf, query, small))
    return query_relevance(weights, query, small)


def search_documents(
    docs: DataFrame,
    query: DataFrame,
    stop: DataFrame | None = None,
    k: int = 3,
    n_docs: int | None = None,
    text: str = "text",
    pad: bool = False,
    digits: int | None = None,
) -> DataFrame:
    """``(rank, doc_id, relevance)``: the k documents most relevant to the query."""
    return top_k(score_documents(docs, query, stop, n_docs, text), k, pad, digits)
