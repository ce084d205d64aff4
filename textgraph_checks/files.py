"""Text and table sources and sinks: tables written as files and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgraph_checks import graph, search, words
from textgraph_checks.tables import table
from textgraph import (
    file_name,
    pack_key,
    prepare_graph,
    read_adjacency,
    read_cells,
    read_id_list,
    read_key_values,
    read_lines,
    read_table,
    read_tagged,
    read_terms,
    scan_folders,
    unpack_key,
    write_folders,
    write_table,
    write_tsv,
)
from textgraph.scratch import scratch_path


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark)
    table(spark, sf_dir, "documents").select("text").write.text(path)
    return read_lines(spark, path).select("value", F.col("file").startswith("part-").alias("named"))


def key_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with two values on a line, and customers' names without any."""
    orders, names = scratch_path(spark), scratch_path(spark)
    write_tsv(table(spark, sf_dir, "orders"), orders, ["o_orderkey", "o_custkey", "o_orderpriority"])
    write_tsv(table(spark, sf_dir, "customer"), names, ["c_name"])
    return read_key_values(spark, [orders, names])


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = {name: scratch_path(spark) for name in ("documents", "benchmark")}
    for name, path in paths.items():
        table(spark, sf_dir, name).select("text").write.text(path)
    return read_tagged(spark, paths)


def adjacency(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark)
    write_tsv(prepare_graph(graph.adjacency(spark, sf_dir)), path, ["page", "rank", "links"])
    return graph.joined(read_adjacency(spark, path))


def raw_adjacency(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark)
    write_tsv(graph.adjacency(spark, sf_dir), path, ["page", "links"])
    return graph.joined(read_adjacency(spark, path, ranked=False))


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells of ``lineitem`` with commas and, from the same files, with tabs."""
    commas, tabs = scratch_path(spark), scratch_path(spark)
    fields = ["l_suppkey", "l_partkey", "l_quantity"]
    sales = table(spark, sf_dir, "lineitem")
    pack_key(sales, ",", fields).select("key").write.text(commas)
    write_tsv(sales, tabs, fields)
    return read_cells(spark, [commas, tabs])


def cells_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two matrices written to folders of one path, of which one is read."""
    path = scratch_path(spark)
    fields = ["l_suppkey", "l_partkey", "l_quantity"]
    sales = table(spark, sf_dir, "lineitem").select(*[F.col(c).cast("string").alias(c) for c in fields])
    m1 = F.struct(F.lit("m1").alias("file"), F.concat_ws(",", *fields).alias("line"))
    m2 = F.struct(F.lit("m2").alias("file"), F.concat_ws("\t", *reversed(fields)).alias("line"))
    write_folders(sales.select(F.inline(F.array(m1, m2))), path, "file", "line", single=False)
    return read_cells(spark, path, folder="m1")


def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a file each: its lines, its files by base name, and whether names are those that Spark reads from."""
    path = scratch_path(spark)
    write_folders(table(spark, sf_dir, "documents"), path, "doc_id", "text")
    base = F.element_at(F.split(F.input_file_name(), "/"), -1)
    lines = scan_folders(spark, path, "doc_id").select("doc_id", file_name().alias("file"), base.alias("base"))
    return lines.groupBy("doc_id").agg(
        F.count("*").alias("lines"), F.count_distinct("file").alias("files"), F.bool_and(F.col("file") == F.col("base")).alias("named")
    )


def terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark)
    table(spark, sf_dir, "documents").select("source").write.text(path)
    return read_terms(spark, path)


def id_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The richest customer of each nation, as one line of ids and a line to skip."""
    path = scratch_path(spark)
    richest = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(
        F.max(F.struct("c_acctbal", "c_custkey"))["c_custkey"].cast("string").alias("id")
    )
    # One id per nation, so the list is as short as the table of nations.
    line = richest.agg(F.array_join(F.array_sort(F.collect_list("id")), ",").alias("ids"))
    line.select(F.concat("ids", F.lit(",,\nskipped,line")).alias("value")).coalesce(1).write.text(path)
    return read_id_list(spark, path)


def tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Term frequencies under the packed key word@document."""
    path = scratch_path(spark)
    packed = pack_key(search.terms(spark, sf_dir), "@", ["word", "doc_id"])
    write_tsv(packed, path, ["key", "tf"])
    pairs = unpack_key(read_key_values(spark, path), "key", "@", ["word", "doc_id"])
    return pairs.select("word", F.col("doc_id").cast("bigint").alias("doc_id"), F.col("value").cast("bigint").alias("tf"))


def typed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark)
    write_table(words.common(spark, sf_dir), path)
    return read_table(spark, path)


QUERIES = {
    "src_lines": lines,
    "src_key_values": key_values,
    "src_tagged": tagged,
    "src_adjacency": adjacency,
    "src_adjacency_raw": raw_adjacency,
    "src_cells": cells,
    "src_cells_by_file": cells_by_file,
    "src_file_names": file_names,
    "src_terms": terms,
    "src_id_list": id_list,
    "sink_tsv": tsv,
    "sink_table": typed_table,
}
CELLS = "SELECT l_suppkey::VARCHAR AS row, l_partkey::VARCHAR AS col, l_quantity AS val FROM lineitem"
SQL = {
    "src_lines": "SELECT unnest(string_split(text, chr(10))) AS value, TRUE AS named FROM documents",
    "src_key_values": """
SELECT o_orderkey::VARCHAR AS key, o_custkey || chr(9) || o_orderpriority AS value FROM orders
UNION ALL SELECT c_name, '' FROM customer""",
    "src_tagged": """
SELECT 'documents' AS tag, unnest(string_split(text, chr(10))) AS value FROM documents
UNION ALL SELECT 'benchmark', unnest(string_split(text, chr(10))) FROM benchmark""",
    "src_adjacency": f"""WITH {graph.LINES}
SELECT page, 1.0::DOUBLE AS rank, array_to_string(links, ' ') AS links FROM lines""",
    "src_adjacency_raw": f"WITH {graph.LINES} SELECT page, array_to_string(links, ' ') AS links FROM lines",
    "src_cells": f"{CELLS} UNION ALL {CELLS}",
    "src_cells_by_file": CELLS,
    "src_file_names": """
SELECT doc_id::VARCHAR AS doc_id, len(string_split(coalesce(text, ''), chr(10))) AS lines, 1::BIGINT AS files, true AS named
FROM documents""",
    "src_terms": "SELECT DISTINCT source AS word FROM documents",
    "src_id_list": """
SELECT c_custkey::VARCHAR AS item FROM (
  SELECT c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey DESC) AS i
  FROM customer) WHERE i = 1""",
    "sink_tsv": search.SQL["term_freq"],
    "sink_table": words.SQL["common_words"],
}
