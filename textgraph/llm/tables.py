"""Inputs and helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textgraph.llm.hashing import blocks, give_back

BLOCK_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(doc_id: str | Column, folds: int) -> Column:
    """``crc32`` of the id as text, modulo ``folds``; null for a null id."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(col.cast("string").cast("binary")), F.lit(folds)).cast("int")


def map_blocks(
    df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, size: int = BLOCK_BYTES, text: str = "text"
) -> DataFrame:
    """``work`` on blocks of rows with about ``size`` bytes of text each, within the partitions of ``df``."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, size, text):
            yield work(block)
            del block
            give_back()

    return df.mapInArrow(task, schema)


STANDARD = ("doc_id", "text", "lang", "source", "n_chars")
FURTHER = "further_columns"


def keeps_columns(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A pipeline stage that takes and returns any columns: those besides ``STANDARD`` pass it as one
    struct, so no name of theirs meets one that the stage uses itself. They can be of all types that compare."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        further = [c for c in docs.columns if c not in STANDARD]
        if not further:
            return stage(spark, docs, sf_dir)
        held = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(further)]).alias(FURTHER)
        out = stage(spark, docs.select(*[c for c in docs.columns if c in STANDARD], held), sf_dir)
        return out.select(*[F.col(FURTHER).getField(f"c{further.index(c)}").alias(c) if c in further else F.col(c) for c in docs.columns])

    return run


def strings(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """A text column as Python strings; null: empty."""
    return [x or "" for x in batch.column(name).to_pylist()]
