"""The item matrix product and the recommendation matrix made of it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from textgraph.operators.cells import (
    HOT_PRODUCTS,
    attach_row_sums,
    dedupe_cells,
    key_sets,
    partial_products,
    product_row_sums,
    scale_cells,
    sum_cells,
    zeros_of,
)
from textgraph.operators.terms import is_small
from textgraph.scratch import CODEC, cut_lineage


@dataclass(frozen=True)
class Product:
    """A matrix product as its cells that have products, and the key sets that its zeros follow from.

    ``cells`` is ``(row, col, val)``, ``rows`` the rows of the left factor, ``cols`` the
    columns of the right one, ``items`` the list. No zero is stored.
    """

    cells: DataFrame
    rows: DataFrame
    cols: DataFrame
    items: DataFrame

    def dense(self) -> DataFrame:
        """The zeros laid out: a cell for each of (rows × items) and (items × columns)."""
        return sum_cells(self.cells.unionByName(zeros_of(self.rows, self.cols, self.items)))


def factored_product(a: DataFrame, b: DataFrame, items: DataFrame, hot_floor: int = HOT_PRODUCTS) -> Product:
    """The product of a · b over an item list, without its zeros but with what they follow from."""
    # Each matrix is read for its counts, for the product and for the key sets.
    a, b = cut_lineage(dedupe_cells(a), codec=CODEC), cut_lineage(dedupe_cells(b), codec=CODEC)
    return Product(sum_cells(partial_products(a, b, items, hot_floor)), *key_sets(a, b), items)


def sparse_matmul(
    a: DataFrame, b: DataFrame, items: DataFrame, dense: bool = False, hot_floor: int = HOT_PRODUCTS
) -> DataFrame:
    """``(row, col, val)`` of a · b over an item list.

    A cell has a product only where its row and its column are in ``items``.
    ``dense`` adds the zeros of (rows of a × items) and (items × columns of b);
    without them the work and the result follow the products alone.
    """
    product = factored_product(a, b, items, hot_floor)
    return product.dense() if dense else product.cells


def recommend(m1: DataFrame, m2: DataFrame, items: DataFrame, dense: bool = False, hot_floor: int = HOT_PRODUCTS) -> DataFrame:
    """The product of two matrices with each row scaled to the sum 1.

    The row sums are made from the factors and ride along with the cells of ``m1``, so the
    product streams once into the sum by cell that divides it.
    """
    a, b = cut_lineage(dedupe_cells(m1), codec=CODEC), cut_lineage(dedupe_cells(m2), codec=CODEC)
    small = is_small(items)
    sums = cut_lineage(product_row_sums(a, b, items, small))
    # With zeros to come, the sum by cell shuffles them all.
    summands = partial_products(attach_row_sums(a, sums), b, items, hot_floor, small, deal=not dense)
    if dense:
        summands = summands.unionByName(zeros_of(*key_sets(a, b), items, sums))
    return scale_cells(summands)
