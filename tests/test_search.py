import math

import pytest

from textgraph import (
    doc_freq,
    l2_normalize,
    relevance,
    score_documents,
    search_documents,
    term_freq,
    tf_idf,
    tokenize_words,
    top_k,
)
from textgraph.operators.weights import query_relevance
from textgraph.plans.search import document_terms
from textgraph.sources import terms_of

DOCS = [
    ("d1", "apple apple pear"),
    ("d2", "apple plum the"),
    ("d3", "apple the"),
    ("d4", "the apple fig fig fig fig"),
]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id string, text string")


@pytest.fixture
def tf(docs):
    return term_freq(tokenize_words(docs, "text", "doc_id"))


def brute(docs, stop=(), n=None):
    """Normalised weights by the formula, in plain Python."""
    counts = {d: {} for d, _ in docs}
    for d, text in docs:
        for w in text.split():
            if w not in stop:
                counts[d][w] = counts[d].get(w, 0) + 1
    n = n or len(docs)
    df = {}
    for words in counts.values():
        for w in words:
            df[w] = df.get(w, 0) + 1
    weights = {(d, w): (1 + math.log(c)) * math.log(n / df[w]) for d, ws in counts.items() for w, c in ws.items()}
    length = {d: math.sqrt(sum(v * v for (e, _), v in weights.items() if e == d)) for d, _ in docs}
    norm = {k: v / length[k[0]] if length[k[0]] else math.nan for k, v in weights.items()}
    return weights, norm


def as_dict(df, value):
    return {(r["doc_id"], r["word"]): r[value] for r in df.collect()}


def test_frequencies(tf, rows):
    assert ("d4", "fig", 4) in rows(tf)
    assert rows(doc_freq(tf)) == [("apple", 4), ("fig", 1), ("pear", 1), ("plum", 1), ("the", 3)]


@pytest.mark.parametrize("floor", [100_000, 1])
@pytest.mark.parametrize("n", [None, 10])
def test_weights_with_and_without_hot_words(tf, floor, n):
    want, norm = brute(DOCS, n=n)
    assert as_dict(tf_idf(tf, n, floor), "tf_idf") == pytest.approx(want)
    assert as_dict(l2_normalize(tf_idf(tf, n), floor), "norm") == pytest.approx(norm, nan_ok=True)


def test_a_word_of_all_documents_weighs_nothing(tf):
    assert as_dict(tf_idf(tf), "tf_idf")["d1", "apple"] == 0.0


def test_negative_weight_with_a_fixed_count(spark):
    tf = spark.createDataFrame([(i, "w", 1) for i in range(20)], "doc_id int, word string, tf long")
    assert tf_idf(tf, n_docs=10).first()["tf_idf"] == pytest.approx(math.log(0.5))


def test_document_of_such_words_has_nan_and_is_never_found(docs, spark):
    stop = terms_of(spark, ["the"])
    query = terms_of(spark, ["apple", "plum"])
    scores = {r["doc_id"]: r["relevance"] for r in score_documents(docs, query, stop).collect()}
    assert math.isnan(scores["d3"])
    assert scores["d2"] == pytest.approx(1.0)
    assert [tuple(r)[:2] for r in search_documents(docs, query, stop).collect()] == [(1, "d2")]


def test_one_aggregate_equals_the_stages(tf, spark):
    weights = tf_idf(tf)
    query = terms_of(spark, ["apple", "the", "fig", "fig", "nothing"])
    stages = {r["doc_id"]: r["relevance"] for r in relevance(l2_normalize(weights), query).collect()}
    once = {r["doc_id"]: r["relevance"] for r in query_relevance(weights, query).collect()}
    assert once == pytest.approx(stages, nan_ok=True)


def test_long_query_gives_the_same(docs, spark, monkeypatch):
    query = terms_of(spark, ["pear", "fig", "the"])
    want = [tuple(r) for r in search_documents(docs, query).collect()]
    monkeypatch.setattr("textgraph.operators.weights.is_small", lambda terms: False)
    monkeypatch.setattr("textgraph.operators.terms.is_small", lambda terms: False)
    got = [tuple(r) for r in search_documents(docs, query).collect()]
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want])


def test_lines_of_a_document_count_together(spark, docs, rows):
    parts = [(d, w) for d, text in DOCS for w in text.split()]
    query = terms_of(spark, ["pear", "fig"])
    split = spark.createDataFrame(parts, "doc_id string, text string")
    assert rows(search_documents(split, query, digits=9)) == rows(search_documents(docs, query, digits=9))


def test_query_words_are_matched_as_they_stand(docs, spark):
    assert search_documents(docs, terms_of(spark, ["Pear"])).count() == 0


def test_length_of_each_document_is_one_or_nan(tf):
    sums = {}
    for (doc, _), v in as_dict(l2_normalize(tf_idf(tf)), "norm").items():
        sums[doc] = sums.get(doc, 0) + v * v
    assert all(math.isnan(s) or s == pytest.approx(1.0) for s in sums.values())


def scores(spark, *values):
    return spark.createDataFrame([(f"d{i}", v) for i, v in enumerate(values)], "doc_id string, relevance double")


def test_top_k_takes_positive_scores_and_breaks_ties_by_id(spark):
    df = scores(spark, 0.5, float("nan"), 0.0, -1.0, 0.5, 0.9, float("inf"))
    assert [tuple(r)[:2] for r in top_k(df).collect()] == [(1, "d6"), (2, "d5"), (3, "d0")]
    assert [r["doc_id"] for r in top_k(df, k=10).collect()] == ["d6", "d5", "d0", "d4"]


def test_top_k_padded(spark, rows):
    assert rows(top_k(scores(spark, 0.5, 0.0), pad=True)) == [(1, "d0", 0.5), (2, "", 0.0), (3, "", 0.0)]
    assert rows(top_k(scores(spark, 0.0), k=1, pad=True)) == [(1, "", 0.0)]


def test_top_k_needs_no_shuffle_to_one_key(spark):
    plan = top_k(scores(spark, 0.1))._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


EMPTY = [*DOCS, ("none", ""), ("null", None), ("signs", " .,! "), ("d1", "pear"), ("none", "...")]


def final_plan(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text[: text.index("== Initial Plan ==")] if "== Initial Plan ==" in text else text


def test_documents_without_words_count(spark, tmp_path):
    """The stages equal the whole, and both equal the formula; a document in two rows is one."""
    spark.createDataFrame(EMPTY, "doc_id string, text string").write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    joined = {}
    for d, text in EMPTY:
        joined[d] = f"{joined.get(d, '')} {text or ''}"
    joined["signs"] = joined["none"] = ""
    _, norm = brute([*joined.items()], stop=("the",))
    weights = tf_idf(document_terms(docs, terms_of(spark, ["the", "", " "]), marked=True), marked=True)
    assert as_dict(l2_normalize(weights), "norm") == pytest.approx(norm, nan_ok=True)
    query = terms_of(spark, ["apple", "fig", "pear", "", " "])
    want = {}
    for (d, w), v in norm.items():
        if w in ("apple", "fig", "pear"):
            want[d] = want.get(d, 0) + v
    got = score_documents(docs, query, terms_of(spark, ["the", "", " "]))
    assert {r["doc_id"]: r["relevance"] for r in got.collect()} == pytest.approx(want, nan_ok=True)


def test_one_scan_and_hit_documents_alone(spark, tmp_path):
    words = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(words[(i + j) % 40] for j in range(5)) + (" rare" if i % 50 == 0 else "")) for i in range(400)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    query = terms_of(spark, ["rare"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scores = score_documents(docs, query)
        text = final_plan(scores)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert scores.count() == 8
    # The same scan and shuffle serve the frequencies, N, the hits and the weights.
    assert text.count("FileScan") == 1 and text.count("ReusedExchange") >= 2
    # Read from the top: the frequencies are joined above the reduction to documents with a hit.
    joins = [line for line in text.splitlines() if "Join [" in line]
    of_frequencies = next(i for i, line in enumerate(joins) if "word" in line and "_key" in line)
    of_documents = next(i for i, line in enumerate(joins) if "doc_id" in line and "_wanted" in line)
    assert of_frequencies < of_documents
