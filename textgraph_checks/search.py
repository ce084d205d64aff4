"""tf-idf and document search over ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgraph_checks.tables import QUERY_WORDS, RARE_WORDS, STOP, quoted, stop_words, table, texts
from textgraph import doc_freq, l2_normalize, nan_to_null, read_folders, relevance, search_documents, tf_idf, write_folders
from textgraph.plans.search import document_terms
from textgraph.scratch import cut_lineage, scratch_path
from textgraph.sources import terms_of


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir, "documents", "doc_id")


def terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_terms(docs(spark, sf_dir), stop_words(spark))


def rounded(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.round(nan_to_null(F.col(col)), 6))


def top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search_documents(
        docs(spark, sf_dir), terms_of(spark, QUERY_WORDS), stop_words(spark), digits=9
    )
    return rounded(found, "relevance")


def padded(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search_documents(
        docs(spark, sf_dir), terms_of(spark, RARE_WORDS), stop_words(spark), pad=True, digits=9
    )
    return rounded(found, "relevance")


def weighed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tf_idf(document_terms(docs(spark, sf_dir), stop_words(spark), marked=True), marked=True)


def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return l2_normalize(cut_lineage(weighed(spark, sf_dir)))


def top3_of_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The search over documents that are a file each; ids are the names of their folders."""
    path = scratch_path(spark)
    write_folders(table(spark, sf_dir, "documents"), path, "doc_id", "text")
    files = read_folders(spark, path, "doc_id")
    found = search_documents(files, terms_of(spark, QUERY_WORDS), stop_words(spark), text="value", digits=9)
    return rounded(found, "relevance")


QUERIES = {
    "term_freq": terms,
    "doc_freq": lambda spark, sf: doc_freq(terms(spark, sf)),
    "tf_idf": lambda spark, sf: rounded(weighed(spark, sf), "tf_idf"),
    "tf_idf_fixed_n": lambda spark, sf: rounded(tf_idf(terms(spark, sf), n_docs=10), "tf_idf"),
    "l2_normalized": lambda spark, sf: rounded(normalized(spark, sf), "norm"),
    "relevance": lambda spark, sf: rounded(
        relevance(normalized(spark, sf), terms_of(spark, QUERY_WORDS)), "relevance"
    ),
    "search_top3": top3,
    "search_padded": padded,
    "search_files": top3_of_files,
}


TF = f"""
tf AS (SELECT doc_id, word, count(*) AS tf FROM (
         SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^a-z0-9_]+')) AS word FROM documents)
       WHERE word <> '' AND word NOT IN ({STOP}) GROUP BY doc_id, word),
freq AS (SELECT word, count(*) AS df FROM tf GROUP BY word)"""


def weights(n: str) -> str:
    return f"""{TF},
weights AS (SELECT doc_id, tf.word AS word, (1 + ln(tf)) * ln({n} / df) AS tf_idf
            FROM tf JOIN freq ON tf.word = freq.word)"""


def scores(n: str, words: list[str], doc: str = "doc_id") -> str:
    return f"""{weights(n)},
lengths AS (SELECT doc_id, sqrt(sum(tf_idf * tf_idf)) AS len FROM weights GROUP BY doc_id),
norms AS (SELECT w.doc_id AS doc_id, word, CASE WHEN len > 0 THEN tf_idf / len END AS norm
          FROM weights w JOIN lengths l ON w.doc_id = l.doc_id),
scores AS (SELECT doc_id, sum(norm) AS relevance FROM norms WHERE word IN ({quoted(words)}) GROUP BY doc_id),
ranked AS (SELECT row_number() OVER (ORDER BY round(relevance, 9) DESC, {doc}) AS rank, {doc} AS doc_id, relevance
           FROM scores WHERE relevance > 0)"""


ALL = "(SELECT count(DISTINCT doc_id) FROM documents)::DOUBLE"
SQL = {
    "term_freq": f"WITH {TF} SELECT doc_id, word, tf FROM tf",
    "doc_freq": f"WITH {TF} SELECT word, df FROM freq",
    "tf_idf": f"WITH {weights(ALL)} SELECT doc_id, word, round(tf_idf, 6) AS tf_idf FROM weights",
    "tf_idf_fixed_n": f"WITH {weights('10.0::DOUBLE')} SELECT doc_id, word, round(tf_idf, 6) AS tf_idf FROM weights",
    "l2_normalized": f"WITH {scores(ALL, QUERY_WORDS)} SELECT doc_id, word, round(norm, 6) AS norm FROM norms",
    "relevance": f"WITH {scores(ALL, QUERY_WORDS)} SELECT doc_id, round(relevance, 6) AS relevance FROM scores",
    "search_top3": f"""WITH {scores(ALL, QUERY_WORDS)}
SELECT rank, doc_id, round(relevance, 6) AS relevance FROM ranked WHERE rank <= 3""",
    "search_files": f"""WITH {scores(ALL, QUERY_WORDS, "doc_id::VARCHAR")}
SELECT rank, doc_id, round(relevance, 6) AS relevance FROM ranked WHERE rank <= 3""",
    "search_padded": f"""WITH {scores(ALL, RARE_WORDS)}
SELECT slot AS rank, coalesce(doc_id::VARCHAR, '') AS doc_id, coalesce(round(relevance, 6), 0.0::DOUBLE) AS relevance
FROM (SELECT unnest([1, 2, 3])::BIGINT AS slot) LEFT JOIN ranked ON slot = rank""",
}
