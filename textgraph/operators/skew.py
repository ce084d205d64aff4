"""Equi joins that stay balanced when one key holds much of the data.

A key is hot when it has more than one part in ``HOT_KEYS`` of all rows, so
there are fewer than ``HOT_KEYS`` hot keys whatever the data: a table of them
can be broadcast. Keys with fewer than ``HOT_FLOOR`` rows are never hot; one
task takes them with ease. The rows of a hot key are cut into pieces that each
meet a copy of the other side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from textgraph.scratch import cut_lineage

HOT_KEYS = 10_000
HOT_FLOOR = 100_000
SKETCH_CELLS = 1 << 20


def key_hash(key: str) -> Column:
    """What stands for a key in a table of hot keys: eight bytes, however long the key is.

    Both sides of a join look pieces up by it, so keys that share a hash share their cut.
    """
    return F.xxhash64(key)


def cell_of(key: str) -> Column:
    """The cell of a key in a sketch of ``SKETCH_CELLS`` counters."""
    return F.pmod(key_hash(key), F.lit(SKETCH_CELLS))


def product_sketch(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``(cell, xs, ys, products)``: rows of both sides and an upper bound of their joined rows, by cell of the key.

    Counters of a fixed number add up, so a task hands on at most ``SKETCH_CELLS`` rows, however
    many keys there are, and one shuffle takes both sides. A cell holds at least the joined rows of
    each of its keys, so none of a cell that is not hot is hot. It holds more by (rows of other keys
    in the cell on one side) x (rows on the other), on average one part in ``SKETCH_CELLS`` of all rows of a side
    for each row of the other. A side without rows of a cell counts as one: the other is shuffled too.
    """
    sides = [(left, 1, 0), (right, 0, 1)]
    rows = [df.select(cell_of(key).alias("cell"), F.lit(x).cast("bigint").alias("x"), F.lit(y).cast("bigint").alias("y")) for df, x, y in sides]
    counts = rows[0].unionByName(rows[1]).groupBy("cell").agg(F.sum("x").alias("xs"), F.sum("y").alias("ys"))
    least = [F.greatest(F.col(c), F.lit(1).cast("bigint")).alias(c) for c in ("xs", "ys")]
    return counts.select("cell", *least).withColumn("products", F.col("xs").cast("double") * F.col("ys"))


def sketch_size(sketch: DataFrame) -> Row:
    """``(total, most, xs, ys)`` of ``product_sketch``: its sums and its greatest cell. Runs one aggregate."""
    return sketch.agg(
        F.sum("products").alias("total"), F.max("products").alias("most"), F.sum("xs").alias("xs"), F.sum("ys").alias("ys")
    ).first()


def expected_products(size: Row) -> float:
    """About how many joined rows there are: the sum of the cells less what keys that share a cell add to it."""
    if size["total"] is None:
        return 0.0
    shared = float(size["xs"]) * size["ys"] / SKETCH_CELLS
    return max(size["total"] - shared, 0.0)


def find_hot_cells(sketch: DataFrame, floor: int, size: Row | None = None) -> DataFrame | None:
    """``(cell, xs, ys, products, pieces)`` of the hot cells of ``product_sketch``, or None if there are none.

    Each has more than one part in ``HOT_KEYS`` of all products, so there are fewer of them. Runs one aggregate
    where the ``size`` of the sketch is not given.
    """
    size = sketch_size(sketch) if size is None else size
    bar = max(float(floor), (size["total"] or 0) / HOT_KEYS)
    if (size["most"] or 0) <= bar:
        return None
    return sketch.where(F.col("products") > bar).withColumn("pieces", F.ceil(F.col("products") / F.lit(bar)).cast("bigint"))


def find_hot_rows(left: DataFrame, row: str, key: str, sketch: DataFrame, floor: int) -> DataFrame | None:
    """``(cell, pieces)`` of the hot rows of a product of ``left`` by the other side of ``product_sketch``, or None if there are none.

    A row is hot by the counter of its hash, which adds up the other side's counters of its keys: an upper bound of its joined
    rows. Counters have fixed numbers, so those of the sketch can be broadcast. Runs one job, and writes the counters.
    """
    others = F.broadcast(sketch.select(F.col("cell").alias("_cell"), "ys"))
    met = left.join(others, cell_of(key) == F.col("_cell")).groupBy(cell_of(row).alias("cell")).agg(F.sum("ys").alias("products"))
    met = cut_lineage(met)
    size = met.agg(F.sum("products").alias("total"), F.max("products").alias("most")).first()
    bar = max(float(floor), (size["total"] or 0) / HOT_KEYS)
    if (size["most"] or 0) <= bar:
        return None
    return met.where(F.col("products") > bar).select("cell", F.ceil(F.col("products") / F.lit(bar)).cast("bigint").alias("pieces"))


def find_hot(counts: DataFrame, key: str, n: str, floor: int = HOT_FLOOR) -> DataFrame | None:
    """``(hash, pieces)`` and the columns of ``counts`` but the key for its hot rows, or None if there are none.

    ``counts`` has one row per key that stands for ``n`` rows. Fewer than ``HOT_KEYS``
    rows, for a broadcast. Runs one aggregate, so that the usual plan, without hot
    keys, stays a plain join.
    """
    size = counts.agg(F.sum(n).alias("total"), F.max(n).alias("most")).first()
    bar = max(float(floor), (size["total"] or 0) / HOT_KEYS)
    if (size["most"] or 0) <= bar:
        return None
    rest = [c for c in counts.columns if c != key]
    hot = counts.where(F.col(n) > bar).withColumn("pieces", F.ceil(F.col(n) / F.lit(bar)).cast("bigint"))
    most = F.max(F.struct("pieces", *rest)).alias("most")
    return hot.groupBy(key_hash(key).alias("hash")).agg(most).select("hash", "most.*")


def or_one(col: str = "pieces") -> Column:
    return F.coalesce(F.col(col), F.lit(1).cast("bigint"))


def piece_of(pieces: Column | int, *cols: str) -> Column:
    """The piece a row falls into, by content: a task run twice says the same."""
    return F.pmod(F.xxhash64(*cols), F.lit(pieces) if isinstance(pieces, int) else pieces)


def every_piece(pieces: Column | int) -> Column:
    """One copy of a row for each piece."""
    last = F.lit(pieces - 1) if isinstance(pieces, int) else pieces - 1
    return F.explode(F.sequence(F.lit(0).cast("bigint"), last.cast("bigint")))


def same(left: Column, right: Column) -> Column:
    """Whether two values are equal or both null, in a form that Spark does not take for a key of a join."""
    return (left.isNull() & right.isNull()) | ((left <= right) & (left >= right))


def attach_totals(rows: DataFrame, totals: DataFrame, key: str, n: str, floor: int = HOT_FLOOR) -> DataFrame:
    """Give each row the columns of ``totals``, which has one row per key.

    ``totals[n]`` is the number of rows that have the key. Totals made of the
    same rows cost no second run of what lies below: a hash, which is never null, adds no
    filter on the key, so the shuffles below stay alike and are reused. Rows meet by one number, the
    hash of key and piece, which sorts faster than a key with many equal rows; then the key itself is compared.
    """
    values = [c for c in totals.columns if c != key]
    bar = F.greatest(F.lit(float(floor)), totals.agg(F.sum(n)).scalar() / HOT_KEYS)
    counts = totals.where(F.col(n) > bar).select(
        key_hash(key).alias("_hot"), F.ceil(F.col(n) / bar).cast("bigint").alias("pieces")
    )
    hot = F.broadcast(counts.groupBy("_hot").agg(F.max("pieces").alias("pieces")))
    cut = rows.join(hot, key_hash(key) == F.col("_hot"), "left").select(
        *rows.columns, piece_of(or_one(), *rows.columns).alias("_piece")
    )
    copied = totals.join(hot, key_hash(key) == F.col("_hot"), "left").select(
        F.col(key).alias("_key"), *values, every_piece(or_one()).alias("_copy")
    )
    match = (F.xxhash64(key, "_piece") == F.xxhash64("_key", "_copy")) & same(F.col(key), F.col("_key")) & same(F.col("_piece"), F.col("_copy"))
    return cut.join(copied, match, "left").select(*rows.columns, *values)
