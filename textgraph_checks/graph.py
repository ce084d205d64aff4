"""PageRank over the references between orders, parts, suppliers and customers.

Links, one or more per row of a table: order → part, part → supplier and
supplier → order for each row of ``lineitem``; order → customer for each row of
``orders``. Customers are mere targets, links repeat, and suppliers are hubs.

As adjacency lines: an order with the part and supplier of each of its rows,
one line per row, so that lines repeat; a supplier with its nation; a part
without links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgraph_checks.tables import key, spread, table
from textgraph import (
    attach_links,
    dedupe_adjacency,
    node_count,
    page_table,
    pagerank,
    pagerank_links,
    pagerank_step,
    prepare_graph,
    rank_contributions,
)
from textgraph.scratch import cut_lineage, scratch_path


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    order, part, supplier = key("o", "l_orderkey"), key("p", "l_partkey"), key("s", "l_suppkey")

    def link(src, dst):
        return F.struct(src.alias("src"), dst.alias("dst"))

    triangles = F.inline(F.array(link(order, part), link(part, supplier), link(supplier, order)))
    buyers = table(spark, sf_dir, "orders").select(
        key("o", "o_orderkey").alias("src"), key("c", "o_custkey").alias("dst")
    )
    sales = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    return spread(sales).select(triangles).unionByName(buyers)


def adjacency(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "lineitem").select(
        key("o", "l_orderkey").alias("page"), F.array(key("p", "l_partkey"), key("s", "l_suppkey")).alias("links")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        key("s", "s_suppkey").alias("page"), F.array(key("n", "s_nationkey")).alias("links")
    )
    parts = table(spark, sf_dir, "part").select(
        key("p", "p_partkey").alias("page"), F.array().cast("array<string>").alias("links")
    )
    return orders.unionByName(suppliers).unionByName(parts)


def joined(df: DataFrame) -> DataFrame:
    return df.withColumn("links", F.concat_ws(" ", "links"))


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    adj = adjacency(spark, sf_dir)
    return joined(prepare_graph(adj)).withColumn("n", node_count(adj).scalar())


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_lineage(page_table(links(spark, sf_dir))).withColumn("rank", F.lit(1.0))


def ranks(df: DataFrame) -> DataFrame:
    return df.select("page", F.round("rank", 6).alias("rank"))


def contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = rank_contributions(nodes(spark, sf_dir), links(spark, sf_dir))
    return sent.select("page", F.round("credit", 9).alias("credit"))


def step(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = nodes(spark, sf_dir)
    n = start.agg(F.count_if("is_line")).scalar()
    return ranks(pagerank_step(start, links(spark, sf_dir), n))


def three_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranks(pagerank_links(links(spark, sf_dir), 3))


def seven_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Past the first cut, so the links are read from their buckets."""
    return ranks(pagerank_links(links(spark, sf_dir), 7))


def adjacency_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    adj = adjacency(spark, sf_dir)
    lines = cut_lineage(dedupe_adjacency(adj))
    linked = attach_links(pagerank(lines, 2, node_count(adj).first()["n"], unique=True), lines)
    return joined(linked).withColumn("rank", F.round("rank", 6))


def saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranks of both steps, read back from the folders they were saved in."""
    path = scratch_path(spark)
    pagerank_links(links(spark, sf_dir), 2, save_each=path)
    steps = [spark.read.parquet(f"{path}{i}").withColumn("step", F.lit(i)) for i in range(2)]
    return steps[0].unionByName(steps[1]).select("step", "page", F.round("rank", 6).alias("rank"))


QUERIES = {
    "graph_prepared": prepared,
    "rank_contributions": contributions,
    "pagerank_step": step,
    "pagerank_3": three_steps,
    "pagerank_7": seven_steps,
    "pagerank_adjacency": adjacency_ranks,
    "pagerank_saved": saved,
    "adjacency_deduped": lambda spark, sf: joined(dedupe_adjacency(adjacency(spark, sf))),
}


LINKS = """
links AS (SELECT 'o' || l_orderkey AS src, 'p' || l_partkey AS dst FROM lineitem
          UNION ALL SELECT 'p' || l_partkey, 's' || l_suppkey FROM lineitem
          UNION ALL SELECT 's' || l_suppkey, 'o' || l_orderkey FROM lineitem
          UNION ALL SELECT 'o' || o_orderkey, 'c' || o_custkey FROM orders)"""
LINES = """
lines AS (SELECT 'o' || l_orderkey AS page, ['p' || l_partkey, 's' || l_suppkey] AS links FROM lineitem
          UNION ALL SELECT 's' || s_suppkey, ['n' || s_nationkey] FROM supplier
          UNION ALL SELECT 'p' || p_partkey, []::VARCHAR[] FROM part)"""
DEDUPED = f"{LINES}, deduped AS (SELECT page, max(links) AS links FROM lines GROUP BY page)"


def steps(n: int, count: str) -> str:
    """CTEs r0 .. rn over a CTE ``links``; r0 has the pages and starting ranks."""
    ctes = ["degree AS (SELECT src, count(*) AS d FROM links GROUP BY src)"]
    for i in range(1, n + 1):
        ctes.append(f"""
r{i} AS (SELECT p.page AS page, 0.85 * coalesce(s.credit, 0) + 0.15 / {count} AS rank
        FROM r0 p LEFT JOIN (
          SELECT l.dst AS page, sum(r.rank / d.d) AS credit
          FROM links l JOIN degree d ON l.src = d.src JOIN r{i - 1} r ON l.src = r.page GROUP BY l.dst) s
        ON p.page = s.page)""")
    return ",\n".join(ctes)


START = "r0 AS (SELECT DISTINCT unnest([src, dst]) AS page, 1.0::DOUBLE AS rank FROM links)"
SOURCES = "(SELECT count(DISTINCT src) FROM links)"
SQL = {
    "graph_prepared": f"""WITH {LINES}
SELECT page, 1.0::DOUBLE AS rank, array_to_string(links, ' ') AS links, (SELECT count(*) FROM lines) AS n FROM lines""",
    "rank_contributions": f"""WITH {LINKS}, degree AS (SELECT src, count(*) AS d FROM links GROUP BY src)
SELECT dst AS page, round(1.0::DOUBLE / d, 9) AS credit FROM links JOIN degree ON links.src = degree.src""",
    "pagerank_step": f"WITH {LINKS}, {START}, {steps(1, SOURCES)} SELECT page, round(rank, 6) AS rank FROM r1",
    "pagerank_3": f"WITH {LINKS}, {START}, {steps(3, SOURCES)} SELECT page, round(rank, 6) AS rank FROM r3",
    "pagerank_7": f"WITH {LINKS}, {START}, {steps(7, SOURCES)} SELECT page, round(rank, 6) AS rank FROM r7",
    "pagerank_adjacency": f"""WITH {DEDUPED},
links AS (SELECT page AS src, unnest(links) AS dst FROM deduped),
r0 AS (SELECT page, 1.0::DOUBLE AS rank FROM (SELECT page FROM deduped UNION SELECT dst FROM links)),
{steps(2, "(SELECT count(*) FROM lines)")}
SELECT r2.page AS page, round(rank, 6) AS rank, coalesce(array_to_string(d.links, ' '), '') AS links
FROM r2 LEFT JOIN deduped d ON r2.page = d.page""",
    "pagerank_saved": f"""WITH {LINKS}, {START}, {steps(2, SOURCES)}
SELECT 0 AS step, page, round(rank, 6) AS rank FROM r1 UNION ALL SELECT 1, page, round(rank, 6) FROM r2""",
    "adjacency_deduped": f"WITH {DEDUPED} SELECT page, array_to_string(links, ' ') AS links FROM deduped",
}
