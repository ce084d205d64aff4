"""Sparse matrices as cells ``(row, col, val)``; no value is null.

Counts are taken of the value, not of rows, where a count and the cells are both
needed: with the same columns in use, Spark runs the shuffle below them once.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textgraph.functions.numbers import ieee_divide
from textgraph.operators.skew import (
    HOT_FLOOR,
    attach_totals,
    cell_of,
    every_piece,
    expected_products,
    find_hot_cells,
    find_hot_rows,
    or_one,
    piece_of,
    product_sketch,
    sketch_size,
)
from textgraph.operators.terms import is_small, keep_terms
from textgraph.scratch import CODEC, cut_lineage

# An inner index with fewer products than this is never hot.
HOT_PRODUCTS = 1_000_000
# So many products a task makes and adds up; the cells of as many fit in its memory.
TASK_PRODUCTS = 2_000_000
# Below so many products to a possible cell, adding up before the shuffle would not make them fewer.
FEW_PRODUCTS = 4
# So many cells of an inner index travel together at most.
PACKED_CELLS = 4096


def dedupe_cells(cells: DataFrame) -> DataFrame:
    """One value per cell: the greatest of those given."""
    return cells.groupBy("row", "col").agg(F.max("val").alias("val"))


def cell_product(a: DataFrame, b: DataFrame, items: DataFrame, hot_floor: int = HOT_PRODUCTS) -> DataFrame:
    """``(row, col, val)`` of a · b where row and column are both in ``items``.

    Only cells with a product have a row. ``items`` does not limit the inner
    index. ``a`` and ``b`` hold one value per cell.
    """
    return sum_cells(partial_products(a, b, items, hot_floor))


def sum_cells(cells: DataFrame) -> DataFrame:
    """One row per cell with the sum of its values."""
    return cells.groupBy(cell_keys(cells)).agg(F.sum("val").alias("val")).select("row", "col", "val")


def cell_keys(cells: DataFrame) -> list[str]:
    """The columns to group cells by: with the ``piece`` of a row cut by its columns, where it has one, so that they stay where they were dealt."""
    return [c for c in ("row", "col", "piece") if c in cells.columns]


def factors(a: DataFrame, b: DataFrame, items: DataFrame, small: bool | None = None) -> tuple[DataFrame, DataFrame]:
    """``(row, k, x, ..)`` of ``a`` and ``(k, col, y)`` of ``b``, limited to rows and columns in ``items``.

    Columns of ``a`` beside its cells stay.
    """
    small = is_small(items) if small is None else small
    rest = [c for c in a.columns if c not in ("row", "col", "val")]
    left = keep_terms(a, items, "row", small).select("row", F.col("col").alias("k"), F.col("val").alias("x"), *rest)
    right = keep_terms(b, items, "col", small).select(F.col("row").alias("k"), "col", F.col("val").alias("y"))
    return left, right


def product_row_sums(a: DataFrame, b: DataFrame, items: DataFrame, small: bool | None = None) -> DataFrame:
    """``(row, row_sum)`` of the product of ``a`` and ``b``, from its factors.

    The sums of a · b by row are a · (b · 1): as many products as ``a`` has cells, and none of the
    product itself. A row without products has no sum.
    """
    left, right = factors(a, b, items, small)
    ones = right.groupBy("k").agg(F.sum("y").alias("total"))
    return left.join(ones, "k").groupBy("row").agg(F.sum(F.col("x") * F.col("total")).alias("row_sum"))


def attach_row_sums(a: DataFrame, sums: DataFrame, hot_floor: int = HOT_FLOOR) -> DataFrame:
    """The cells of ``a``, each with the ``row_sum`` of its row in the product; 0 where the row has none."""
    if is_small(sums):
        few = F.broadcast(sums.select(F.col("row").alias("_row"), "row_sum"))
        return a.join(few, F.col("row") == F.col("_row"), "left").select(*a.columns, F.coalesce("row_sum", F.lit(0.0)).alias("row_sum"))
    rows = a.groupBy("row").agg(F.count("val").alias("cells")).join(sums, "row", "left")
    rows = rows.select("row", F.coalesce("row_sum", F.lit(0.0)).alias("row_sum"), "cells")
    return attach_totals(a, rows, "row", "cells", hot_floor).select(*a.columns, "row_sum")


def partial_products(
    a: DataFrame,
    b: DataFrame,
    items: DataFrame,
    hot_floor: int = HOT_PRODUCTS,
    small: bool | None = None,
    deal: bool = True,
) -> DataFrame:
    """``(row, col, val, ..)``: one summand per inner index, for ``sum_cells``.

    An inner index is hot by the number of products in its counter of a sketch, which bounds
    its own. Its cells are cut into a grid of pieces, in which those of ``a`` meet copies of those of ``b``.
    Columns of ``a`` beside its cells stay with their products.

    Where cells repeat little, an aggregate before the shuffle only fills its memory and spills. There
    ``deal`` sends the products to the task of their row, with as many tasks as keep ``TASK_PRODUCTS`` in
    each, and the sum by cell needs no shuffle of its own. Those of one cell of ``a`` travel as two arrays, of
    columns and of values. A row with many products is cut by its columns, by the same bar as a hot inner index; then
    products have a ``piece``, which ``sum_cells`` groups by too.
    """
    small = is_small(items) if small is None else small
    left, right = factors(a, b, items, small)
    rest = [c for c in left.columns if c not in ("row", "k", "x")]

    on = ["k"]
    # A table of ``SKETCH_CELLS`` rows at most, which is read some times.
    sketch = cut_lineage(product_sketch(left, right, "k"), codec=CODEC)
    size = sketch_size(sketch)
    hot = find_hot_cells(sketch, hot_floor, size)
    products = expected_products(size)
    tasks = _partitions(left)
    deal = deal and products > TASK_PRODUCTS and products < FEW_PRODUCTS * possible_cells(left, right)
    rows = find_hot_rows(left, "row", "k", sketch, hot_floor) if deal else None
    if deal:
        tasks = max(tasks, math.ceil(products / TASK_PRODUCTS))
        names = number_items(items) if small else None
        if names is not None:
            # The numbers keep the columns in the list too.
            listed = b.join(F.broadcast(names), F.col("col") == F.col("item"))
            right = listed.select(F.col("row").alias("k"), F.col("id").alias("col"), F.col("val").alias("y"))
    if hot is not None:
        # As many cuts on each side as make the pieces of both alike in size.
        even = F.ceil(F.sqrt(F.col("pieces") * F.col("xs") / F.col("ys"))).cast("bigint")
        a_pieces = F.least("pieces", "xs", F.greatest(even, F.lit(1).cast("bigint")))
        grid = hot.withColumn("a", a_pieces).select("cell", "a", F.ceil(F.col("pieces") / F.col("a")).cast("bigint").alias("b"))
        left, right = (
            side.join(F.broadcast(grid), cell_of("k") == F.col("cell"), "left")
            .withColumn("a", or_one("a"))
            .withColumn("b", or_one("b"))
            for side in (left, right)
        )
        left = left.withColumn("i", piece_of(F.col("a"), "row")).withColumn("j", every_piece(F.col("b")))
        right = right.withColumn("j", piece_of(F.col("b"), "col")).withColumn("i", every_piece(F.col("a")))
        on = ["k", "i", "j"]
    # Few bytes go in and many rows come out, so the number of tasks must not
    # follow the bytes, by which adaptive execution would merge partitions.
    left = left.repartition(tasks, *on)
    if not deal:
        return left.join(right, on).select("row", "col", (F.col("x") * F.col("y")).alias("val"), *rest)
    packed = left.join(pack_cells(right.repartition(tasks, *on), on), on).select(
        "row", "cols", F.transform("ys", lambda y: F.col("x") * y).alias("vals"), *rest
    )
    return deal_rows(packed, rows, tasks, names, rest)


def number_items(items: DataFrame) -> DataFrame:
    """``(item, id)`` of a list that ``is_small``: a number below its length for each item. Writes them."""
    ids = items.select(F.col(items.columns[0]).alias("item")).distinct().repartition(1)
    return cut_lineage(ids.select("item", F.monotonically_increasing_id().cast("int").alias("id")))


def pack_cells(cells: DataFrame, on: list[str]) -> DataFrame:
    """``(*on, cols, ys)``: the columns and values of cells ``(*on, col, y)`` with the same ``on``, at most ``PACKED_CELLS`` in a row."""
    place = F.row_number().over(Window.partitionBy(*on).orderBy("col")) - 1
    parts = cells.select(*on, "col", "y", F.floor(place / PACKED_CELLS).alias("part"))
    packed = parts.groupBy(*on, "part").agg(F.collect_list(F.struct("col", "y")).alias("cells"))
    return packed.select(*on, F.col("cells.col").alias("cols"), F.col("cells.y").alias("ys"))


def deal_rows(packed: DataFrame, rows: DataFrame | None, tasks: int, names: DataFrame | None, rest: list[str]) -> DataFrame:
    """``(row, col, val, ..)`` of ``(row, cols, vals, ..)``, dealt by row; those of hot ``rows``, ``(cell, pieces)``, one by one, by ``piece``."""
    keys = ["row"]
    if rows is not None:
        keys.append("piece")
        whole = F.array(F.struct(F.lit(0).cast("bigint").alias("piece"), "cols", "vals"))
        single = F.transform(
            F.arrays_zip("cols", "vals"),
            lambda c: F.struct(
                F.pmod(F.xxhash64(c["cols"]), F.col("pieces")).alias("piece"), F.array(c["cols"]).alias("cols"), F.array(c["vals"]).alias("vals")
            ),
        )
        cut = packed.join(F.broadcast(rows), cell_of("row") == F.col("cell"), "left")
        packed = cut.select("row", *rest, F.inline(F.when(F.col("pieces").isNull(), whole).otherwise(single)))
    dealt = packed.repartition(tasks, *keys)
    summands = dealt.select(*keys, "vals", *rest, F.posexplode("cols").alias("place", "col"))
    if names is not None:
        summands = summands.join(F.broadcast(names), F.col("col") == F.col("id")).drop("col").withColumnRenamed("item", "col")
    return summands.select("row", "col", F.get("vals", F.col("place")).alias("val"), *keys[1:], *rest)


def possible_cells(left: DataFrame, right: DataFrame) -> int:
    """About how many cells (rows of ``left``) x (columns of ``right``) are. Runs two aggregates."""
    counts = [df.agg(F.approx_count_distinct(c)).first()[0] for df, c in ((left, "row"), (right, "col"))]
    return counts[0] * counts[1]


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def key_sets(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(row)`` of the rows of ``a`` and ``(col)`` of the columns of ``b``."""
    rows = a.where(F.col("val").isNotNull()).select("row").distinct()
    return rows, b.where(F.col("val").isNotNull()).select("col").distinct()


def zeros_of(rows: DataFrame, cols: DataFrame, items: DataFrame, sums: DataFrame | None = None) -> DataFrame:
    """Cells of value 0: (rows × items) and (items × columns), with the ``row_sum`` of their rows if ``sums`` are given."""
    ids = items.select(F.col(items.columns[0]).alias("item")).distinct()
    of_items = ids.select(F.col("item").alias("row"))
    if sums is not None:
        # A sum joins a row before it is laid out, not each of its cells.
        rows, of_items = (
            keys.join(sums, "row", "left").select("row", F.coalesce("row_sum", F.lit(0.0)).alias("row_sum")) for keys in (rows, of_items)
        )
    return (
        pair_up(rows, ids.withColumnRenamed("item", "col"))
        .unionByName(pair_up(of_items, cols))
        .withColumn("val", F.lit(0.0))
    )


def zero_cells(a: DataFrame, b: DataFrame, items: DataFrame) -> DataFrame:
    """Cells of value 0: (rows of a × items) and (items × columns of b)."""
    return zeros_of(*key_sets(a, b), items)


def fill_cells(product: DataFrame, a: DataFrame, b: DataFrame, items: DataFrame) -> DataFrame:
    """``product`` with a 0 in every cell of (rows of a × items) and (items ×
    columns of b) that has none: as many rows as those sets have cells."""
    return sum_cells(product.unionByName(zero_cells(a, b, items)))


def pair_up(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every pair of a left and a right row, which is what a dense result is.

    Both sides are cut into ``side`` strips by their first column and meet as the tiles of
    a grid by an equi join, so that no side is held whole by any task.
    """
    side = math.ceil(math.sqrt(4 * _partitions(left)))
    strips = left.withColumn("i", piece_of(side, left.columns[0])).withColumn("j", every_piece(side))
    bands = right.withColumn("i", every_piece(side)).withColumn("j", piece_of(side, right.columns[0]))
    return strips.repartition(_partitions(left), "i", "j").join(bands, ["i", "j"]).select(*left.columns, *right.columns)


def normalize_rows(cells: DataFrame, hot_floor: int = HOT_FLOOR) -> DataFrame:
    """Each value over the sum of its row; NaN in a row of zeros.

    The sums are written. Where they are few enough to broadcast, no cell is shuffled.
    """
    sums = cut_lineage(cells.groupBy("row").agg(F.sum("val").alias("row_sum"), F.count("val").alias("cells")))
    share = ieee_divide(F.col("val"), F.col("row_sum"))
    if is_small(sums):
        rows = F.broadcast(sums.select(F.col("row").alias("_row"), "row_sum"))
        shares = cells.join(rows, F.col("row").eqNullSafe(F.col("_row")), "left")
        return shares.select("row", "col", share.alias("val"))
    return attach_totals(cells, sums, "row", "cells", hot_floor).select("row", "col", share.alias("val"))


def scale_cells(summands: DataFrame) -> DataFrame:
    """``(row, col, val)``: summands with the ``row_sum`` of their row, added up by cell and divided by it."""
    sums = summands.groupBy(cell_keys(summands)).agg(F.sum("val").alias("val"), F.max("row_sum").alias("row_sum"))
    return sums.select("row", "col", ieee_divide(F.col("val"), F.col("row_sum")).alias("val"))
