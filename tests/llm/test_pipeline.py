"""The pipeline's stages, and its rows against the stages run by brute force on what they keep."""

from __future__ import annotations

import os

import pytest

import corpus_pipeline

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_each_stage_takes_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    given = {r.doc_id: r for r in docs.collect()}
    columns = docs.columns
    kept = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = str(tmp_path / f"{i}")
        stage(spark, docs, SF).write.parquet(out)
        docs = spark.read.parquet(out)
        if name != "bpe":
            assert docs.columns == columns
        kept.append({r.doc_id: r for r in docs.collect()})
    toxic, near, secret, mixed, coded = kept
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    gone = set(given) - set(toxic)
    assert sum(labels.get(k) == 0 for k in gone) <= 1
    assert all(toxic[k] == given[k] for k in toxic)
    assert set(near) <= set(toxic) and len({r.text for r in near.values()}) == len(near)
    assert set(secret) == set(near) == set(mixed) == set(coded)
    assert all(secret[k].n_chars == len(secret[k].text) for k in secret)
    assert {k: mixed[k].text for k in mixed} == {k: secret[k].text for k in secret}


def test_null_and_repeated_ids_keep_unlike_texts(spark):
    texts = {name: " ".join(f"{name}{i}" for i in range(60)) for name in "abcdef"}
    rows = [
        (None, texts["a"]), (None, texts["a"]), (None, texts["b"]), (None, texts["c"] + " end"), (1, texts["c"]),
        (2, texts["d"]), (2, texts["e"]), (2, texts["e"]), (3, texts["d"] + " end"), (4, texts["f"]),
        (None, None), (None, ""), (None, ""), (5, " "),
    ]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, source string")
    got = corpus_pipeline.one_of_each(spark, docs, "")
    assert got.columns == docs.columns
    want = [(None, texts["a"]), (None, texts["b"]), (1, texts["c"]), (2, texts["d"]), (2, texts["e"]), (4, texts["f"]), (None, None), (None, ""), (5, " ")]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(want, key=str)


def test_run_gives_the_last_stage(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert rows.count() == rows.select("doc_id").distinct().count() > 0


CLASHES = [
    "score", "evidence", "passages", "_id", "alone", "_th", "_row", "_kept", "class", "path", "_key", "_piece", "own", "whole", "block", "slot",
    "place", "number", "release", "deadline", "source_key", "words", "n", "a.b",
]


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_keep_columns_of_any_name(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    secret = 'password = "abcdef0123456789abcd" and more words than a few'
    texts = [secret, None, "", "plain words here", "x" * 30_000]
    rows = [(i, t, None, "s", str(len(t or "")), *[f"{c}{i}" for c in CLASHES]) for i, t in enumerate(texts)]
    types = "doc_id bigint, text string, lang string, source string, n_chars string, " + ", ".join(f"`{c}` string" for c in CLASHES)
    docs = spark.createDataFrame(rows, types)
    out = stage(spark, docs, SF)
    assert stage(spark, docs.limit(0), SF).count() == 0
    if name == "bpe":
        assert {r.doc_id for r in out.collect()} == {0, 1, 2, 3, 4}
        return
    assert out.columns == docs.columns
    got = {r.doc_id: r for r in out.collect()}
    assert got.keys() == {0, 1, 2, 3, 4} and all(got[i][c] == f"{c}{i}" for i in got for c in CLASHES)
    if name == "secrets":
        assert got[0].text != secret and got[0].n_chars == str(len(got[0].text)) and got[3].n_chars == "16" and got[1].text is None
