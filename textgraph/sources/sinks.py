"""Sinks. None overwrites: a path that exists makes the job fail."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgraph.functions.text import NO_VALUE


def write_tsv(df: DataFrame, path: str, cols: list[str] | None = None) -> None:
    """One line per row, fields set apart by tabs, without quotes or escapes.

    The elements of an array column become fields of their own, so that
    ``page, rank, links`` gives an adjacency line. A null is an empty field.
    """
    kinds = dict(df.dtypes)
    fields = [
        F.col(c) if kinds[c].startswith("array") else F.coalesce(F.col(c).cast("string"), F.lit(""))
        for c in cols or df.columns
    ]
    df.select(F.concat_ws("\t", *fields).alias("value")).write.text(path)


def write_table(df: DataFrame, path: str) -> None:
    """A typed table, as Parquet."""
    df.write.parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


# A local folder gets no checksum file beside each file, which would be a second file with its own mode to set.
# Other file systems are written to as ever.
PLAIN_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}
# Characters that Spark writes as % and their number in the name of a folder.
ESCAPED = r"[\x01-\x1f\x7f\"#%'*/:=?\\{\[\]^]"


def write_folders(df: DataFrame, path: str, name: str, text: str, single: bool = True) -> None:
    """The text of each row as lines of a file in a folder ``<name>=<value>``.

    ``single`` gives each folder one file, from one task; without it a folder has one from each
    task that holds rows of it, which is the form where a name has many rows. In a local file system
    single files are written without Hadoop.
    """
    rows = df.select(F.col(name).cast("string").alias(name), text)
    if not single:
        rows.write.options(**PLAIN_FILES).partitionBy(name).text(path)
        return
    # An empty name shares the folder of null.
    rows = rows.withColumn(name, F.nullif(F.col(name), F.lit(""))).repartition(name)
    spark = df.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.getUri().getScheme() == "file" and dict(rows.dtypes)[text] == "string" and not files.exists(target):
        _write_local(rows, files, files.makeQualified(target), name, text)
    else:
        rows.write.partitionBy(name).text(path)


def _write_local(rows: DataFrame, files, target, name: str, text: str) -> None:
    """What Spark's writer makes of rows with all of a name in one task, in a local file system.

    There Hadoop, without native libraries, starts a process for each folder and each file to set its mode.
    Files are written under a hidden folder, which gets its name when all are there.
    """
    run = uuid.uuid4().hex
    hidden = rows.sparkSession._jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{target.getName()}-{run}")
    folder, column = hidden.toUri().getPath(), _in_path(name)
    escaped, none = ESCAPED, NO_VALUE

    def write(batches):
        # Holds nothing of this package, which workers then need not find.
        import itertools
        import os
        import re

        import pyarrow as pa
        from pyspark import TaskContext

        part = f"part-{TaskContext.get().partitionId():05d}-{run}.txt"
        lines = (row for batch in batches for row in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()).to_pylist(), strict=True))
        n = 0
        for value, same in itertools.groupby(lines, key=lambda row: row[0]):
            value = none if value is None else re.sub(escaped, lambda c: f"%{ord(c[0]):02X}", value)
            at = f"{folder}/{column}={value}"
            os.makedirs(at, exist_ok=True)
            # Another attempt of this task puts the same file in its place.
            own = f"{at}/.{part}-{TaskContext.get().taskAttemptId()}"
            with open(own, "wb") as file:
                for _, line in same:
                    file.write((line or b"") + b"\n")
            os.replace(own, f"{at}/{part}")
            n += 1
        yield pa.RecordBatch.from_pydict({"files": pa.array([n], pa.int64())})

    try:
        files.mkdirs(hidden)
        rows.sortWithinPartitions(name).select(name, text).mapInArrow(write, "files bigint").agg(F.sum("files")).first()
        files.create(hidden.suffix("/_SUCCESS")).close()
        if not files.rename(hidden, target):
            raise OSError(f"{hidden} could not be renamed to {target}")
    except BaseException:
        files.delete(hidden, True)
        raise


def _in_path(value: str) -> str:
    return re.sub(ESCAPED, lambda c: f"%{ord(c[0]):02X}", value)
