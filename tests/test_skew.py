"""Hot keys of any length, and long term lists."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from textgraph import pagerank_step
from textgraph.operators.cells import partial_products, sum_cells
from textgraph.operators import skew
from textgraph.operators.skew import attach_totals, cell_of, find_hot, find_hot_cells, product_sketch
from textgraph.operators.terms import drop_terms, keep_terms

LONG = "k" * 1200


def test_long_hot_key_is_cut(spark):
    key = F.when(F.col("id") < 300, F.lit(LONG)).otherwise(F.col("id").cast("string"))
    rows = spark.range(320).select("id", key.alias("key"))
    totals = rows.groupBy("key").agg(F.count("id").alias("n"))
    hot = find_hot(totals, "key", "n", floor=100).collect()
    assert [r["pieces"] for r in hot] == [3]
    got = attach_totals(rows, totals, "key", "n", floor=100).collect()
    assert len(got) == 320
    assert all(r["n"] == (300 if r["key"] == LONG else 1) for r in got)


def test_totals_meet_rows_by_one_number(spark):
    key = F.when(F.col("id") % 7 > 0, F.concat(F.lit("w"), (F.col("id") % 7).cast("string")))
    rows = spark.range(70).select("id", key.alias("key")).repartition(3)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = attach_totals(rows, rows.groupBy("key").agg(F.count("id").alias("n")), "key", "n", floor=4)
        plan = joined._jdf.queryExecution().sparkPlan().toString()
        got = joined.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(got) == 70 and {r["n"] for r in got} == {10} and None in {r["key"] for r in got}
    assert re.search(r"SortMergeJoin \[xxhash64\([^\]]*\)\], \[xxhash64\([^\]]*\)\]", plan)


def test_long_hot_inner_index(spark):
    a = spark.range(30).select(F.col("id").cast("string").alias("row"), F.lit(LONG).alias("col"), F.lit(2.0).alias("val"))
    b = spark.range(20).select(F.lit(LONG).alias("row"), F.col("id").cast("string").alias("col"), F.lit(3.0).alias("val"))
    items = spark.range(25).select(F.col("id").cast("string").alias("item"))
    got = sum_cells(partial_products(a, b, items, hot_floor=50)).collect()
    assert len(got) == 25 * 20 and {r["val"] for r in got} == {6.0}


def test_sketch_finds_the_hot_keys_of_exact_counts(spark, monkeypatch):
    key = F.when(F.col("id") < 4000, "the").when(F.col("id") < 6000, "of").when(F.col("id") < 6400, None).otherwise(F.col("id").cast("string"))
    left, right = spark.range(12_000).select(key.alias("k")), spark.range(3500, 9000).select(key.alias("k"))
    counts = [{r.k: r["count"] for r in side.groupBy("k").count().collect()} for side in (left, right)]
    products = {k: counts[0].get(k, 1) * counts[1].get(k, 1) for k in counts[0] | counts[1]}
    cells = {r.k: r.cell for r in left.unionByName(right).select("k", cell_of("k").alias("cell")).distinct().collect()}
    exact = {cells[k] for k, n in products.items() if n > 100_000}
    sketch = product_sketch(left, right, "k")
    assert {r.cell for r in find_hot_cells(sketch, 100_000).collect()} == exact and len(exact) == 3
    assert find_hot_cells(sketch, 10**9) is None
    assert sketch._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    # Few cells: keys share them, and a cell still holds all of each.
    monkeypatch.setattr(skew, "SKETCH_CELLS", 64)
    cells = {r.k: r.cell for r in left.unionByName(right).select("k", cell_of("k").alias("cell")).distinct().collect()}
    got = {r.cell: r.products for r in product_sketch(left, right, "k").collect()}
    assert len(got) <= 64 and all(got[cells[k]] >= n for k, n in products.items())
    assert {cells[k] for k, n in products.items() if n > 100_000} <= {r.cell for r in find_hot_cells(product_sketch(left, right, "k"), 100_000).collect()}


@pytest.mark.parametrize("cells", [1, 4, 1 << 20])
def test_product_does_not_depend_on_the_sketch(spark, monkeypatch, cells):
    monkeypatch.setattr(skew, "SKETCH_CELLS", cells)
    a = spark.range(400).select((F.col("id") % 20).cast("string").alias("row"), (F.col("id") % 7 * (F.col("id") % 3)).cast("string").alias("col"), F.col("id").cast("double").alias("val")).dropDuplicates(["row", "col"])
    b = a.select(F.col("col").alias("row"), F.col("row").alias("col"), "val")
    items = spark.range(20).select(F.col("id").cast("string").alias("item"))
    got = {(r.row, r.col): r.val for r in sum_cells(partial_products(a, b, items, hot_floor=5)).collect()}
    cells_ = a.collect()
    want: dict = {}
    for x in cells_:
        for y in cells_:
            if x.col == y.col:
                want[x.row, y.row] = want.get((x.row, y.row), 0) + x.val * y.val
    assert got == want


def test_long_list_and_one_hot_word(spark):
    word = F.when(F.col("id") % 10 != 0, "the").otherwise(F.col("id").cast("string"))
    tokens = spark.range(200).select(word.alias("word"))
    terms = spark.createDataFrame([("the",), ("10",), ("the",)], "word string")
    assert keep_terms(tokens, terms, small=False).count() == 181
    assert drop_terms(tokens, terms, small=False).count() == 19


def test_step_keeps_targets_that_are_no_nodes(spark):
    nodes = spark.createDataFrame([("a", 1.0, 1)], "page string, rank double, out_degree long")
    links = spark.createDataFrame([("a", "b")], "src string, dst string")
    got = {r["page"]: (round(r["rank"], 6), r["out_degree"]) for r in pagerank_step(nodes, links, 1).collect()}
    assert got == {"a": (0.15, 1), "b": (1.0, 0)}
