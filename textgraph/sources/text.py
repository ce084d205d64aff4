"""Text sources. Each returns a DataFrame and reads nothing until it is used."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgraph.functions.numbers import parse_double
from textgraph.functions.text import file_name, folder_value
from textgraph.scratch import session_setting

CELL_SEPARATOR = "[\t,]"
# The most tasks that list folders, and how many for each core are enough.
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LISTING_TASKS = 8


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(file, value)``: the lines of text files with the base name of the file."""
    return spark.read.text(path).select(file_name().alias("file"), "value")


def read_folders(spark: SparkSession, path: str, name: str = "file") -> DataFrame:
    """``(name, value)``: the lines of files that ``write_folders`` wrote, with the name of their folder.

    The name is text as it was written. A condition on it chooses files before any is read.
    """
    return scan_folders(spark, path, name).select(name, "value")


def scan_folders(spark: SparkSession, path: str, name: str = "file") -> DataFrame:
    """``(value, name)``, with the metadata of files. The folders are listed here.

    Spark lists each by a task of its own up to ``LISTING`` tasks; some for each core take all folders in less time. Names are
    taken from the paths of files: as values of a partition column they cost Spark time that grows with the square of their number.
    """
    tasks = min(int(spark.conf.get(LISTING)), LISTING_TASKS * spark.sparkContext.defaultParallelism)
    with session_setting(spark, LISTING, tasks):
        return spark.read.text(path, recursiveFileLookup=True).withColumn(name, folder_value())


def read_key_values(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(key, value)``: lines cut at the first tab; without one the value is empty."""
    parts = F.split("value", "\t", 2)
    return spark.read.text(path).select(
        F.element_at(parts, 1).alias("key"),
        F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit("")).alias("value"),
    )


def read_tagged(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """``(tag, value)``: the lines of several paths, each with its own tag."""
    scans = [spark.read.text(path).select(F.lit(tag).alias("tag"), "value") for tag, path in paths.items()]
    return reduce(DataFrame.unionByName, scans)


def read_adjacency(spark: SparkSession, path: str | list[str], ranked: bool = True) -> DataFrame:
    """``(page, rank, links)`` from lines ``page, rank, link, link ...`` set apart by tabs.

    Runs of tabs count as one. A page without a rank field has rank 0 and no
    links. With ``ranked=False`` the lines hold no rank and the result is
    ``(page, links)``. A line without a page stops the job.
    """
    fields = F.filter(F.split("value", "\t"), lambda field: field != "")
    lines = spark.read.text(path).select(fields.alias("fields"))
    page = F.coalesce(
        F.try_element_at("fields", F.lit(1)),
        F.raise_error(F.lit("adjacency line without a page")).cast("string"),
    )
    before = 2 if ranked else 1
    links = F.slice("fields", before + 1, F.greatest(F.size("fields") - before, F.lit(0)))
    if not ranked:
        return lines.select(page.alias("page"), links.alias("links"))
    rank = F.when(F.size("fields") < 2, F.lit(0.0)).otherwise(parse_double(F.try_element_at("fields", F.lit(2))))
    return lines.select(page.alias("page"), rank.alias("rank"), links.alias("links"))


def read_cells(spark: SparkSession, path: str | list[str], file: str | None = None, folder: str | None = None) -> DataFrame:
    """``(row, col, val)`` from lines ``row,col,val`` with commas or tabs.

    ``file`` keeps only the cells of the files of that base name, for a folder
    that holds several matrices; ``folder`` those of the matrix that ``write_folders``
    wrote under that name.
    """
    if folder is not None:
        # A few folders, of which Spark opens one.
        lines = spark.read.schema("value string, file string").text(path).where(F.col("file") == folder)
    else:
        lines = read_lines(spark, path)
    if file is not None:
        lines = lines.where(F.col("file") == file)
    parts = F.split("value", CELL_SEPARATOR)
    return lines.select(
        F.element_at(parts, 1).alias("row"),
        F.coalesce(
            F.try_element_at(parts, F.lit(2)), F.raise_error(F.concat(F.lit("not row,col,val: "), F.col("value")))
        ).alias("col"),
        parse_double(F.try_element_at(parts, F.lit(3))).alias("val"),
    )


def read_terms(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(word)``: the distinct lines as they stand, neither trimmed nor lowered."""
    return spark.read.text(path).select(F.col("value").alias("word")).distinct()


def read_id_list(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(item)``: the distinct ids on the first line of each file, set apart by commas."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        "value",
        # Rises within a split, so the least id at offset 0 is the first line.
        F.monotonically_increasing_id().alias("id"),
    )
    first = lines.where(F.col("start") == 0).groupBy("file").agg(F.min_by("value", "id").alias("line"))
    # Empty ids at the end of the line do not count; those between commas do.
    ids = F.when(F.col("line").rlike("^,+$"), F.array().cast("array<string>")).otherwise(
        F.split(F.regexp_replace("line", ",+$", ""), ",")
    )
    return first.select(F.explode(ids).alias("item")).distinct()


def terms_of(spark: SparkSession, words: list[str], name: str = "word") -> DataFrame:
    """A one-column DataFrame of the distinct words of a list the caller holds."""
    import pyarrow as pa

    return spark.createDataFrame(pa.table({name: pa.array(list(dict.fromkeys(words)), pa.string())}))
