from textgraph import common_words, count_words, drop_terms, keep_terms, tokenize_delims, tokenize_words, word_count
from textgraph.operators.counts import both_counts, without_stop_words
from textgraph.operators.terms import is_small
from textgraph.sources import terms_of


def texts(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "doc_id int, text string")


def test_delimiters_keep_tab_colon_quote_hyphen_and_brackets(spark, rows):
    df = texts(spark, "Don't stop: a\tb [x], y!", 'say-"it" (now)\r\nNEXT;\fend?')
    assert rows(tokenize_delims(df, "text").select("word")) == sorted(
        [("don",), ("t",), ("stop:",), ("a\tb",), ("x",), ("y",), ('say-"it"',), ("(now)",), ("next",), ("end",)]
    )


def test_lower_case_comes_after_the_cut(spark, rows):
    assert rows(tokenize_delims(texts(spark, "ΟΣ.Α"), "text")) == [("α",), ("ος",)]


def test_words_are_ascii_word_characters(spark, rows):
    assert rows(tokenize_words(texts(spark, "Füß_a1-B", "...", ""), "text", "doc_id")) == [(0, "_a1"), (0, "b"), (0, "f")]


def test_word_count_drops_stop_words_after_lower_casing(spark, rows):
    df = texts(spark, "The cat the CAT", "cat, dog")
    assert rows(count_words(df, "text", terms_of(spark, ["the"]))) == [("cat", 3), ("dog", 1)]
    assert rows(count_words(df, "text")) == [("cat", 3), ("dog", 1), ("the", 2)]
    assert rows(count_words(df, "text", terms_of(spark, ["The"]))) == [("cat", 3), ("dog", 1), ("the", 2)]


def test_word_count_in_order(spark):
    df = texts(spark, "b a c Z _ é zz a 9")
    words = [r["word"] for r in count_words(df, "text", order=True).collect()]
    assert words == sorted(words, key=lambda w: w.encode())


def test_common_words_take_the_smaller_count_most_frequent_first(spark):
    a, b = texts(spark, "x x x y", "p q q q"), texts(spark, "x x z q q q q p")
    assert [tuple(r) for r in common_words(a, b).collect()] == [(3, "q"), (2, "x"), (1, "p")]
    assert [tuple(r) for r in common_words(a, b, terms_of(spark, ["q"])).collect()] == [(2, "x"), (1, "p")]


def test_common_words_are_the_bag_intersection(spark, rows):
    a, b = texts(spark, "x x x y u u", "u v"), texts(spark, "x x z u u u u")
    bag = tokenize_words(a, "text").intersectAll(tokenize_words(b, "text"))
    assert rows(common_words(a, b).select("word", "cnt")) == rows(word_count(bag))


def test_long_term_lists_give_the_same(spark, rows):
    """The path for lists beyond the broadcast bound, with one word a third of all."""
    df = texts(spark, *["the the the a b c d e f"] * 20)
    tokens = tokenize_words(df, "text", "doc_id")
    stop = terms_of(spark, ["the", "c", "zz"])
    assert rows(drop_terms(tokens, stop, small=False)) == rows(drop_terms(tokens, stop, small=True))
    assert rows(keep_terms(tokens, stop, small=False)) == rows(keep_terms(tokens, stop, small=True))
    assert rows(drop_terms(word_count(tokens), stop, small=False)) == rows(
        without_stop_words(tokens, stop, word_count)
    )


def test_stop_words_of_a_long_list_leave_the_counts(spark, rows, monkeypatch):
    df = texts(spark, "the cat the dog", "cat")
    stop = terms_of(spark, ["the", "dog"])
    want = rows(count_words(df, "text", stop)), rows(common_words(df, df, stop))
    monkeypatch.setattr("textgraph.operators.counts.is_small", lambda terms: False)
    assert (rows(count_words(df, "text", stop)), rows(common_words(df, df, stop))) == want


def test_size_check_of_term_lists(spark):
    terms = terms_of(spark, ["aa", "bb", "cc"])
    assert is_small(terms)
    assert not is_small(terms, max_terms=2)
    assert not is_small(terms, max_bytes=5)
    assert is_small(terms.where("word = 'x'"))


def test_small_stop_list_is_broadcast_and_large_is_not(spark):
    tokens = tokenize_words(texts(spark, "a b"), "text")
    terms = terms_of(spark, ["a"])

    def plan(small):
        return drop_terms(tokens, terms, small=small)._jdf.queryExecution().optimizedPlan().toString()

    assert "strategy=broadcast" in plan(True)
    assert "strategy=broadcast" not in plan(False)


def test_both_counts_needs_both_sides(spark, rows):
    tokens = spark.createDataFrame([("a", 1), ("b", 2), ("c", 1), ("c", 2), ("c", 2)], "word string, side int")
    assert rows(both_counts(tokens)) == [("c", 1)]
