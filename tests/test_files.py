import re
import sys

import pytest
from pyspark.sql import functions as F

from textgraph import (
    pack_key,
    read_adjacency,
    read_cells,
    read_folders,
    read_id_list,
    read_key_values,
    read_lines,
    read_table,
    read_tagged,
    read_terms,
    search_documents,
    terms_of,
    unpack_key,
    write_folders,
    write_table,
    write_tsv,
)
from textgraph.scratch import cut_lineage, scratch_path
from textgraph.sources.text import LISTING


def put(folder, name, text):
    (folder / name).write_bytes(text.encode())
    return str(folder / name)


def test_line_ends_and_file_name(spark, tmp_path, rows):
    put(tmp_path, "x@1=y.txt", "a\rb\nc\r\nd")
    put(tmp_path, "p+q r%20.txt", "e\n")
    assert rows(read_lines(spark, str(tmp_path))) == [("p+q r%20.txt", "e")] + [("x@1=y.txt", c) for c in "abcd"]


def test_files_as_documents(spark, tmp_path):
    put(tmp_path, "x@1=y.txt", "Fig fig\nplum\n")
    put(tmp_path, "z.txt", "plum\n")
    docs = read_lines(spark, str(tmp_path)).withColumnRenamed("file", "doc_id")
    found = search_documents(docs, terms_of(spark, ["fig"]), text="value", pad=True).collect()
    assert [r["doc_id"] for r in sorted(found)] == ["x@1=y.txt", "", ""]


def test_key_values(spark, tmp_path, rows):
    path = put(tmp_path, "kv", "k\tv\tw\nsolo\n\tonly\n")
    assert rows(read_key_values(spark, path)) == [("", "only"), ("k", "v\tw"), ("solo", "")]


def test_tagged(spark, tmp_path, rows):
    paths = {"f1": put(tmp_path, "a", "x\ny\n"), "f2": put(tmp_path, "b", "x\n")}
    assert rows(read_tagged(spark, paths)) == [("f1", "x"), ("f1", "y"), ("f2", "x")]


def test_adjacency(spark, tmp_path, rows):
    path = put(tmp_path, "g", "a\t0.5\tb\tc\tb\nb\t1\n\tc\t\t2e-1\t\ta\t\nd\n")
    assert rows(read_adjacency(spark, path)) == [
        ("a", 0.5, ["b", "c", "b"]), ("b", 1.0, []), ("c", 0.2, ["a"]), ("d", 0.0, [])
    ]
    raw = put(tmp_path, "raw", "a\tb\tc\nb\n")
    assert rows(read_adjacency(spark, raw, ranked=False)) == [("a", ["b", "c"]), ("b", [])]


@pytest.mark.parametrize("text, message", [("a\tx\tb\n", "not a number"), ("a\t1\tb\n\n", "without a page")])
def test_bad_adjacency_stops(spark, tmp_path, text, message):
    with pytest.raises(Exception, match=message):
        read_adjacency(spark, put(tmp_path, "g", text)).collect()


def test_cells(spark, tmp_path, rows):
    put(tmp_path, "m1", "r,c,1.5\nr\td\t2\n")
    put(tmp_path, "m2", "c,r,1e3,ignored\n")
    assert rows(read_cells(spark, str(tmp_path), "m1")) == [("r", "c", 1.5), ("r", "d", 2.0)]
    assert rows(read_cells(spark, str(tmp_path), "m2")) == [("c", "r", 1000.0)]
    assert read_cells(spark, str(tmp_path)).count() == 3
    with pytest.raises(Exception, match="not a number"):
        read_cells(spark, put(tmp_path, "bad", "r,c,x\n")).collect()


def test_terms(spark, tmp_path, rows):
    assert rows(read_terms(spark, put(tmp_path, "t", "The\nthe \nthe \n\nx"))) == [("",), ("The",), ("the ",), ("x",)]


@pytest.mark.parametrize(
    "text, ids",
    [
        ("3,1,,3, 2\n9,9\n", ["", " 2", "1", "3"]),
        ("3,1,,\n", ["1", "3"]),
        ("\n5\n", [""]),
        (",,\n5\n", []),
        ("7", ["7"]),
    ],
)
def test_id_list(spark, tmp_path, rows, text, ids):
    assert rows(read_id_list(spark, put(tmp_path, "ids", text))) == [(i,) for i in ids]


def test_id_list_of_a_file_in_many_splits(spark, tmp_path, rows):
    path = put(tmp_path, "ids", "3,1\n" + "9,9\n" * 50_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert rows(read_id_list(spark, path)) == [("1",), ("3",)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_tsv_round_trip(spark, tmp_path, rows):
    df = spark.createDataFrame([("w@x", 1e-9, 3), ("v", 0.1 + 0.2, None)], "word string, val double, n int")
    write_tsv(df, f"{tmp_path}/out")
    back = read_key_values(spark, f"{tmp_path}/out")
    assert rows(back) == [("v", "0.30000000000000004\t"), ("w@x", "1.0E-9\t3")]
    assert {float(v.split("\t")[0]) for _, v in rows(back)} == {1e-9, 0.1 + 0.2}
    with pytest.raises(Exception, match="already exists"):
        write_tsv(df, f"{tmp_path}/out")


def test_adjacency_round_trip(spark, tmp_path, rows):
    graph = spark.createDataFrame([("a", 1.0, ["b", "c"]), ("b", 0.1, [])], "page string, rank double, links array<string>")
    write_tsv(graph, f"{tmp_path}/g", ["page", "rank", "links"])
    assert rows(read_adjacency(spark, f"{tmp_path}/g")) == rows(graph)


def test_table_round_trip(spark, tmp_path, rows):
    df = spark.createDataFrame([("a", 1)], "word string, cnt long")
    write_table(df, f"{tmp_path}/t")
    assert read_table(spark, f"{tmp_path}/t").dtypes == df.dtypes
    with pytest.raises(Exception, match="already exists"):
        write_table(df, f"{tmp_path}/t")


def test_keys(spark, rows):
    df = spark.createDataFrame([("w", "d.1", 5)], "word string, doc string, n int")
    for sep in ("@", ",", "=", ".", "|", "\t"):
        packed = pack_key(df, sep, ["word", "doc"])
        assert packed.columns == ["key", "n"]
        if sep != ".":
            assert rows(unpack_key(packed, "key", sep, ["word", "doc"])) == rows(df)


def test_scratch_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    assert scratch_path(spark) != scratch_path(spark)
    assert base is None or scratch_path(spark).startswith(base)
    df = spark.range(3)
    cut = cut_lineage(df)
    assert sorted(r[0] for r in cut.collect()) == [0, 1, 2]
    assert "textgraph-" in cut.inputFiles()[0]


def test_folders_of_odd_names_and_lines(spark, tmp_path, rows):
    """As Spark's own writer would write them: an empty name is that of null, lines of a name stand in one file."""
    given = [(None, "n"), ("", "e"), ("a", "x\ny"), ("a", None), ("a", "z\r"), (" %/=:'\"{[^*?#\\", "odd"), ("é.", ""), ("b\n\x7f", "ü")]
    df = spark.createDataFrame(given, "`d=` string, text string")
    write_folders(df, f"{tmp_path}/ours", "d=", "text")
    df.repartition("d=").write.partitionBy("d=").text(f"{tmp_path}/spark")
    got = {name: sorted(p.name for p in (tmp_path / name).iterdir() if not p.name.startswith(".")) for name in ("ours", "spark")}
    assert got["ours"] == got["spark"] and "_SUCCESS" in got["ours"]
    order = lambda folder: sorted((str(name), value) for name, value in read_folders(spark, f"{tmp_path}/{folder}", "d=").collect())
    assert order("ours") == order("spark") and len(order("ours")) == 9
    assert {len([*p.iterdir()]) for p in (tmp_path / "ours").iterdir() if p.is_dir()} == {1}
    assert sorted(p.name for p in tmp_path.iterdir()) == ["ours", "spark"]
    with pytest.raises(Exception, match="already exists"):
        write_folders(df, f"{tmp_path}/ours", "d=", "text")


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    bad = spark.range(10).select("id", F.when(F.col("id") < 9, "x").otherwise(F.raise_error(F.lit("stop")).cast("string")).alias("text"))
    with pytest.raises(Exception, match="stop"):
        write_folders(bad, f"{tmp_path}/out", "id", "text")
    assert [*tmp_path.iterdir()] == []


@pytest.mark.skipif(sys.platform != "linux", reason="reads /proc")
def test_no_process_for_each_file(spark, tmp_path):
    begun = lambda: int(re.search(r"^processes (\d+)", open("/proc/stat").read(), re.M)[1])
    docs = spark.range(600).select("id", F.lit("x").alias("text"))
    docs.mapInArrow(lambda batches: batches, docs.schema).count()
    before = begun()
    write_folders(docs, f"{tmp_path}/out", "id", "text")
    assert begun() - before < 600


def test_folders_are_listed_by_few_tasks(spark, tmp_path):
    for i in range(200):
        (tmp_path / "f" / f"d={i}").mkdir(parents=True)
        put(tmp_path / "f" / f"d={i}", "part", f"{i}\n")
    most = spark.conf.get(LISTING)
    spark.sparkContext.setJobGroup("listing", "")
    try:
        df = read_folders(spark, str(tmp_path / "f"), "d")
        status = spark.sparkContext.statusTracker()
        stages = [s for job in status.getJobIdsForGroup("listing") for s in status.getJobInfo(job).stageIds]
        assert 0 < max(status.getStageInfo(s).numTasks for s in stages) <= 8 * spark.sparkContext.defaultParallelism < 200
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert spark.conf.get(LISTING) == most
    assert sorted(df.collect()) == sorted((str(i), str(i)) for i in range(200))


def test_folders_are_no_partitions_yet_chosen_before_they_are_read(spark, tmp_path):
    """Values of partitions are resolved in a time that grows with the square of their number."""
    write_folders(spark.range(5).select("id", F.lit("x").alias("text")), f"{tmp_path}/f", "id", "text")
    df = read_folders(spark, f"{tmp_path}/f", "id")
    assert df.dtypes == [("id", "string"), ("value", "string")]
    relation = df._jdf.queryExecution().analyzed().collectLeaves().head().relation()
    assert relation.partitionSchema().isEmpty()
    one = df.where("id = '3'")
    assert [tuple(r) for r in one.collect()] == [("3", "x")]
    scan = one._jdf.queryExecution().executedPlan().collectLeaves().head()
    scan.execute().count()
    assert scan.metrics().apply("numFiles").value() == 1
