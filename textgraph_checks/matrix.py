"""Matrix products over ``lineitem``.

Sparse products: A is customer × part with the quantity bought, B is part ×
customer with the number of purchases, the items are all customers. A part has
about thirty buyers at every scale, so the work and the result grow with the sales.
Dense products have nations of suppliers in place of customers, and the items are
the nations of all regions but one: as many cells at every scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgraph_checks.tables import spread, table
from textgraph import cell_product, dedupe_cells, fill_cells, nan_to_null, normalize_rows, recommend, sparse_matmul
from textgraph.scratch import CODEC, cut_lineage


def cells(df: DataFrame, row: str, col: str, val) -> DataFrame:
    """Grouped by the text of row and column, so that what groups cells again finds them dealt."""
    keys = [F.col(row).cast("string").alias("row"), F.col(col).cast("string").alias("col")]
    return df.select(*keys, "l_quantity").groupBy("row", "col").agg(val.cast("double").alias("val"))


def sales_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_quantity"))


def purchases(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Customer × part, part × customer, and the customers."""
    buyers = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    sales = spread(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity"), "l_orderkey").join(buyers, "l_orderkey")
    items = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("item"))
    return (
        cells(sales, "o_custkey", "l_partkey", F.sum("l_quantity")),
        cells(sales, "l_partkey", "o_custkey", F.count("*")),
        items,
    )


def nations(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nation × part, part × nation, and the nations outside region 0."""
    sellers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    sales = sales_of(spark, sf_dir).join(sellers, "l_suppkey")
    items = table(spark, sf_dir, "nation").where("n_regionkey <> 0").select(F.col("n_nationkey").cast("string").alias("item"))
    return (
        cells(sales, "s_nationkey", "l_partkey", F.sum("l_quantity")),
        cells(sales, "l_partkey", "s_nationkey", F.count("*")),
        items,
    )


def shares(df: DataFrame) -> DataFrame:
    return df.withColumn("val", F.round(nan_to_null(F.col("val")), 6))


def sold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One cell per sale, so that cells repeat."""
    return sales_of(spark, sf_dir).select(
        F.col("l_suppkey").cast("string").alias("row"),
        F.col("l_partkey").cast("string").alias("col"),
        F.col("l_quantity").alias("val"),
    )


def filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b, ids = nations(spark, sf_dir)
    a, b = cut_lineage(a), cut_lineage(b)
    return fill_cells(cell_product(a, b, ids), a, b, ids)


QUERIES = {
    "matmul_sparse": lambda spark, sf: sparse_matmul(*purchases(spark, sf)),
    "matmul_dense": lambda spark, sf: sparse_matmul(*nations(spark, sf), dense=True),
    "cells_filled": filled,
    "rows_normalized": lambda spark, sf: shares(normalize_rows(cut_lineage(sparse_matmul(*purchases(spark, sf)), codec=CODEC))),
    "recommend": lambda spark, sf: shares(recommend(*purchases(spark, sf))),
    "recommend_dense": lambda spark, sf: shares(recommend(*nations(spark, sf), dense=True)),
    "cells_deduped": lambda spark, sf: dedupe_cells(sold(spark, sf)),
}


def matrices(sales: str, side: str, items: str) -> str:
    return f"""
sales AS ({sales}),
a AS (SELECT {side}::VARCHAR AS row, l_partkey::VARCHAR AS col, sum(l_quantity)::DOUBLE AS val
      FROM sales GROUP BY {side}, l_partkey),
b AS (SELECT l_partkey::VARCHAR AS row, {side}::VARCHAR AS col, count(*)::DOUBLE AS val
      FROM sales GROUP BY l_partkey, {side}),
items AS ({items})"""


PURCHASES = matrices(
    "SELECT o_custkey, l_partkey, l_quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
    "o_custkey",
    "SELECT c_custkey::VARCHAR AS item FROM customer",
)
NATIONS = matrices(
    "SELECT s_nationkey, l_partkey, l_quantity FROM lineitem JOIN supplier ON l_suppkey = s_suppkey",
    "s_nationkey",
    "SELECT n_nationkey::VARCHAR AS item FROM nation WHERE n_regionkey <> 0",
)
PRODUCT = """
product AS (SELECT a.row AS row, b.col AS col, sum(a.val * b.val) AS val FROM a JOIN b ON a.col = b.row
            WHERE a.row IN (SELECT item FROM items) AND b.col IN (SELECT item FROM items) GROUP BY a.row, b.col)"""
DENSE = f"""{PRODUCT},
cells AS (SELECT row, item AS col FROM (SELECT DISTINCT row FROM a), items
          UNION SELECT item, col FROM items, (SELECT DISTINCT col FROM b)),
dense AS (SELECT c.row AS row, c.col AS col, coalesce(p.val, 0) AS val
          FROM cells c LEFT JOIN product p ON c.row = p.row AND c.col = p.col)"""


def scaled(cells: str) -> str:
    return f"""sums AS (SELECT row, sum(val) AS total FROM {cells} GROUP BY row)
SELECT d.row AS row, d.col AS col, CASE WHEN total <> 0 THEN round(val / total, 6) END AS val
FROM {cells} d JOIN sums s ON d.row = s.row"""


SQL = {
    "matmul_sparse": f"WITH {PURCHASES}, {PRODUCT} SELECT row, col, val FROM product",
    "matmul_dense": f"WITH {NATIONS}, {DENSE} SELECT row, col, val FROM dense",
    "cells_filled": f"WITH {NATIONS}, {DENSE} SELECT row, col, val FROM dense",
    "rows_normalized": f"WITH {PURCHASES}, {PRODUCT}, {scaled('product')}",
    "recommend": f"WITH {PURCHASES}, {PRODUCT}, {scaled('product')}",
    "recommend_dense": f"WITH {NATIONS}, {DENSE}, {scaled('dense')}",
    "cells_deduped": """
SELECT l_suppkey::VARCHAR AS row, l_partkey::VARCHAR AS col, max(l_quantity) AS val
FROM lineitem GROUP BY l_suppkey, l_partkey""",
}
