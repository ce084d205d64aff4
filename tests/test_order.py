"""Order of sorted results, and files found by the folders they stand in."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from textgraph import count_words, order_report, read_cells, read_folders, write_folders


@pytest.fixture
def words(spark):
    return spark.range(2000).select(F.concat(F.lit("w"), F.pmod(F.col("id") * 7919, F.lit(500))).alias("word"), "id")


def report(df, **order):
    return tuple(order_report(df, order).first())


def test_order_within_and_across_partitions(spark, words):
    counts = words.groupBy("word").agg(F.count("*").alias("cnt"), F.sum("id").alias("sum"))
    assert report(counts.repartitionByRange(5, "word").sortWithinPartitions("word"), word=False) == (500, 0)
    assert report(counts.repartitionByRange(5, F.desc("sum")).sortWithinPartitions(F.desc("sum"), "word"), sum=True, word=False) == (500, 0)
    # Every seam between five sorted parts is wrong, or every row but the first of each part.
    assert report(counts.repartitionByRange(5, F.desc("word")).sortWithinPartitions("word"), word=False) == (500, 4)
    assert report(counts.repartitionByRange(5, "word").sortWithinPartitions(F.desc("word")), word=False) == (500, 495)
    one = counts.coalesce(1).sortWithinPartitions("word")
    assert report(one, word=False) == (500, 0) and report(one, word=True) == (500, 499)


def test_ties_and_no_rows(spark):
    same = spark.range(10).select(F.lit(1).alias("cnt"), F.lit("x").alias("word"))
    assert report(same, cnt=True, word=False) == (10, 0)
    assert report(same.limit(0), cnt=True) == (0, 0)


def test_sorted_counts_are_in_order(spark):
    df = spark.range(300).select(F.concat_ws(" ", F.hash("id").cast("string"), F.lit("the é Z z")).alias("text"))
    assert report(count_words(df, "text", order=True), word=False)[1] == 0


def test_folders_keep_names_as_text(spark, tmp_path, rows):
    given = [("007", "a\nb"), ("x@1=y/z %", "é"), ("7", ""), ("1e3", "c")]
    write_folders(spark.createDataFrame(given, "doc string, text string"), f"{tmp_path}/docs", "doc", "text")
    want = sorted((name, line) for name, text in given for line in text.split("\n"))
    assert rows(read_folders(spark, f"{tmp_path}/docs", "doc")) == want


def test_one_matrix_of_several_is_read(spark, tmp_path, rows):
    lines = [("m1", "r,c,1"), ("m2", "r\tc\t2"), ("m1", "r,d,3"), ("m10", "bad line")]
    write_folders(spark.createDataFrame(lines, "file string, line string"), f"{tmp_path}/cells", "file", "line")
    cells = read_cells(spark, f"{tmp_path}/cells", folder="m1")
    assert rows(cells) == [("r", "c", 1.0), ("r", "d", 3.0)]
    assert "PartitionFilters: [isnotnull(file" in cells._jdf.queryExecution().executedPlan().toString()


def test_a_folder_holds_one_file_and_nothing_beside_it(spark, tmp_path):
    write_folders(spark.createDataFrame([("a", "x"), ("b", "y\nz"), ("c", None)], "doc string, text string"), f"{tmp_path}/docs", "doc", "text")
    assert [len(list(f.iterdir())) for f in (tmp_path / "docs").glob("doc=*")] == [1, 1, 1]
