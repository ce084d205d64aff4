"""Whether a sorted DataFrame is in order, without bringing its rows together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textgraph.scratch import cut_lineage


def comes_after(a: Column, b: Column, order: dict[str, bool]) -> Column:
    """Whether ``a`` belongs behind ``b``; ``order`` tells of each field whether it descends."""
    out, same = F.lit(False), F.lit(True)
    for name, descending in order.items():
        x, y = a[name], b[name]
        out = out | (same & (x < y if descending else x > y))
        same = same & (x == y)
    return out


def order_report(df: DataFrame, order: dict[str, bool]) -> DataFrame:
    """``(rows, out_of_order)``: the rows of ``df``, and how many of them belong before the row that they follow.

    Rows are compared with the one before in their partition, and the first of each partition
    with the last of the one before it: one row for each partition comes together. The rows'
    places are written as a table. The fields of ``order`` hold no nulls.
    """
    key = F.struct(*order).alias("key")
    placed = cut_lineage(df.select(key, F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")))
    before = F.lag("key").over(Window.partitionBy("part").orderBy("at"))
    compared = placed.withColumn("before", before)
    parts = compared.groupBy("part").agg(
        F.min_by("key", "at").alias("first"),
        F.max_by("key", "at").alias("last"),
        F.count("*").alias("rows"),
        F.count_if(F.col("before").isNotNull() & comes_after(F.col("before"), F.col("key"), order)).alias("wrong"),
    )
    ends = parts.agg(
        F.array_sort(F.collect_list(F.struct("part", "first", "last"))).alias("ends"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("wrong"), F.lit(0)).alias("wrong"),
    )
    seams = F.transform("ends", lambda end, i: F.when(i > 0, comes_after(F.get("ends", i - 1)["last"], end["first"], order)))
    wrong = F.col("wrong") + F.size(F.filter(seams, lambda seam: seam))
    return ends.select("rows", wrong.cast("bigint").alias("out_of_order"))
