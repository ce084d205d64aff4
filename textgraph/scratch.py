"""Where intermediate tables go, how an iterative plan is cut short, and who removes its tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
# For large tables that are read a few times at most: bytes count for more than the time to pack them.
CODEC = "zstd"


def scratch_path(spark: SparkSession) -> str:
    """A path nobody uses yet, in the shared folder the session names.

    Executors can only read a folder they all see, so a cluster must set
    ``spark.checkpoint.dir``. A local session without it has a folder of its own.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
        base = f"{tempfile.gettempdir()}/textgraph-{spark.sparkContext.applicationId}"
    return f"{base.rstrip('/')}/textgraph-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, path: str | None = None, codec: str | None = None) -> DataFrame:
    """Write ``df`` as a table, packed by ``codec`` or as the session says, and read it back: a short plan on durable files."""
    path = path or scratch_path(df.sparkSession)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def session_setting(spark: SparkSession, name: str, value: object) -> Iterator[None]:
    """A setting of the session for what runs inside."""
    before = spark.conf.get(name)
    spark.conf.set(name, str(value))
    try:
        yield
    finally:
        spark.conf.set(name, before)


class TableScope:
    """The tables between the stages of a plan; it removes those that it wrote when it is closed.

    A result that was not written or collected yet reads from them, so it must be used before:

        with TableScope(spark) as scope:
            pagerank(adj, 50, scope=scope).write.parquet(out)
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []
        self.names: list[str] = []

    def __enter__(self) -> TableScope:
        return self

    def __exit__(self, *error) -> None:
        self.close()

    def cut(self, df: DataFrame) -> DataFrame:
        """As ``cut_lineage``, in a table of this scope."""
        self.paths.append(scratch_path(self.spark))
        return cut_lineage(df, self.paths[-1], CODEC)

    def cut_next(self, df: DataFrame, before: str | None) -> tuple[DataFrame, str]:
        """``df`` as a table and its path; the table of ``before``, which it was made from, goes."""
        table = self.cut(df)
        path = self.paths[-1]
        if before is not None:
            self.remove(before)
        return table, path

    def bucketed(self, df: DataFrame, keys: list[str], buckets: int, parts: tuple[str, ...] = ()) -> DataFrame:
        """``df`` as a table in buckets by ``keys``, so that a join on them does not shuffle it again. The values of ``parts`` have folders."""
        self.paths.append(scratch_path(self.spark))
        self.names.append(f"textgraph_{uuid.uuid4().hex}")
        # One task for each bucket, and so one file.
        dealt = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).options(path=self.paths[-1], compression=CODEC)
        (dealt.partitionBy(*parts) if parts else dealt).saveAsTable(self.names[-1])
        return self.spark.table(self.names[-1])

    def bucketed_next(self, df: DataFrame, keys: list[str], buckets: int, before: tuple[str, str] | None) -> tuple[DataFrame, tuple[str, str]]:
        """As ``bucketed``, with the table's name and path; that of ``before``, which it was made from, goes."""
        table = self.bucketed(df, keys, buckets)
        own = self.names[-1], self.paths[-1]
        if before is not None:
            self.spark.sql(f"DROP TABLE IF EXISTS {before[0]}")
            self.names.remove(before[0])
            self.remove(before[1])
        return table, own

    def remove(self, path: str) -> None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
        self.paths.remove(path)

    def close(self) -> None:
        while self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.names.pop()}")
        for path in list(self.paths):
            self.remove(path)
