"""Inputs the driver queries share, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgraph.sources import terms_of

# Frequent words of the four languages of the test documents.
STOP_WORDS = [
    "the", "of", "and", "to", "in", "a", "is", "that", "it", "for", "as", "was", "be", "with", "by", "this", "are",
    "de", "la", "le", "que", "des", "et", "en", "der", "die", "und", "es",
]
# No document holds a word with an upper-case letter once words are lowered.
QUERY_WORDS = ["worthless", "license", "token", "License"]
# A row group of Parquet has so many bytes at most.
ROW_GROUP = 128 << 20
RARE_WORDS = ["aananwhly", "Token"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """The test tables have one row group each, which leaves their work to one core unless rows are dealt out.

    A table of as many files as there are cores, or of so many row groups by its size, is read by all of them, and its rows
    stay where they are. ``keys`` deal the rows as the join that follows needs them.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    files = df.inputFiles()
    if len(files) >= cores or file_bytes(df.sparkSession, files) >= cores * ROW_GROUP:
        return df
    return df.repartition(*keys) if keys else df.repartition(cores)


def file_bytes(spark: SparkSession, files: list[str]) -> int:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file)) for file in files]
    return sum(path.getFileSystem(conf).getFileStatus(path).getLen() for path in paths)


def texts(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    return spread(table(spark, sf_dir, name).select(*cols, "text"))


def stop_words(spark: SparkSession) -> DataFrame:
    return terms_of(spark, STOP_WORDS)


def key(prefix: str, col: str):
    return F.concat(F.lit(prefix), F.col(col).cast("string"))


def quoted(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


STOP = quoted(STOP_WORDS)
