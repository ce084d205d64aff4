"""PageRank for a fixed number of steps."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgraph.operators.graph import (
    DAMPING,
    HASHED_BYTES,
    count_links,
    deal_links,
    dedupe_adjacency,
    fit_in_hashes,
    hot_sources,
    hub_degree,
    links_of,
    node_count,
    page_bytes,
    page_table,
    pagerank_step,
    split_sources,
)
from textgraph.operators.skew import HOT_FLOOR
from textgraph.scratch import TableScope, cut_lineage, session_setting

# Steps planned as one query. All of them read the same shuffle of the links, or the same buckets.
STEPS_PER_PLAN = 5
PARTITIONS = "spark.sql.shuffle.partitions"
# Where hubs are broadcast, at least so many buckets for each core, if there are as many shuffle partitions.
BUCKETS_PER_CORE = 4


def pagerank(
    adj: DataFrame,
    iterations: int,
    n: int | Column | None = None,
    damping: float = DAMPING,
    initial_rank: float | None = 1.0,
    save_each: str | None = None,
    hot_floor: int = HOT_FLOOR,
    scope: TableScope | None = None,
    unique: bool = False,
) -> DataFrame:
    """``(page, rank)`` of an adjacency table after ``iterations`` steps.

    N is ``n``, or else the number of lines. ``initial_rank=None`` starts from
    the ``rank`` column of ``adj``. ``save_each`` writes the ranks of step i, with the
    out-degrees, to ``<save_each>i``. ``scope`` owns the tables between the steps; without one
    those that the result reads stay. ``unique`` tells that no page has two lines.
    """
    scope = scope or TableScope(adj.sparkSession)
    # Taken once: as a subquery it would read the source again in each plan.
    n = node_count(adj).first()["n"] if n is None else n
    lines = adj if unique else dedupe_adjacency(adj)
    if iterations > STEPS_PER_PLAN or save_each is not None:
        lines = scope.cut(lines)
    links = links_of(lines)
    pages = scope.cut(page_table(links, lines))
    if initial_rank is None:
        given = pages.join(lines.select("page", "rank"), "page", "left")
        start = given.select("page", F.coalesce("rank", F.lit(0.0)).alias("rank"), "out_degree")
    else:
        start = pages.select("page", F.lit(float(initial_rank)).alias("rank"), "out_degree")
    return _iterate(start, links, pages, iterations, n, damping, save_each, hot_floor, scope)


def pagerank_links(
    links: DataFrame,
    iterations: int,
    n: int | Column | None = None,
    damping: float = DAMPING,
    initial_rank: float = 1.0,
    lines: DataFrame | None = None,
    save_each: str | None = None,
    hot_floor: int = HOT_FLOOR,
    scope: TableScope | None = None,
) -> DataFrame:
    """As ``pagerank``, from a table ``(src, dst)`` with one row per link.

    No page's links need to fit in a row. ``lines`` names further pages, such
    as those without links. N is ``n``, or else the number of pages that have
    links or are named in ``lines``.
    """
    scope = scope or TableScope(links.sparkSession)
    pages = scope.cut(page_table(links, lines))
    n = pages.agg(F.count_if("is_line")).scalar() if n is None else n
    start = pages.select("page", F.lit(float(initial_rank)).alias("rank"), "out_degree")
    return _iterate(start, links, pages, iterations, n, damping, save_each, hot_floor, scope)


def _iterate(
    nodes: DataFrame,
    links: DataFrame,
    pages: DataFrame,
    iterations: int,
    n: int | Column,
    damping: float,
    save_each: str | None,
    hot_floor: int,
    scope: TableScope,
) -> DataFrame:
    if iterations < 1:
        raise ValueError("iterations must be at least 1")
    if iterations > STEPS_PER_PLAN or save_each is not None:
        least = hub_degree(pages)
        if least is not None and hot_sources(pages.where(F.col("out_degree") < least), hot_floor) is None:
            return _iterate_with_hubs(nodes, links, pages, iterations, n, damping, save_each, least, scope)
    hot = hot_sources(pages, hot_floor)
    hashed = fit_in_hashes(pages)
    if iterations > STEPS_PER_PLAN or save_each is not None:
        # Several plans read the links: each once, in buckets that no plan shuffles.
        buckets = int(links.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        keys = ["src"] if hot is None else ["src", "piece"]
        # Dealt once: equal links are counted in the bucket that they are written to.
        links = split_sources(links, hot).repartition(buckets, *keys)
        links = scope.bucketed(count_links(links, *keys[1:]), keys, buckets)
    else:
        links = split_sources(links, hot)
    last = None
    for i in range(iterations):
        nodes = pagerank_step(nodes, links, n, damping, pages, hot, hashed)
        if save_each is not None:
            nodes = cut_lineage(nodes, f"{save_each}{i}")
        elif (i + 1) % STEPS_PER_PLAN == 0 and i + 1 < iterations:
            nodes, last = scope.cut_next(nodes, last)
    return nodes.select("page", "rank")


def _iterate_with_hubs(
    nodes: DataFrame,
    links: DataFrame,
    pages: DataFrame,
    iterations: int,
    n: int | Column,
    damping: float,
    save_each: str | None,
    least: int,
    scope: TableScope,
) -> DataFrame:
    """As ``_iterate`` where hubs have many links: their credits are broadcast to the targets and never shuffled.

    Both uses of a step's ranks read a table of them. A credit is added up per bucket of its sources before it is shuffled, so there are
    only as many buckets as keep their pages in hash tables. Pages and ranks stand in buckets too.
    """
    spark = links.sparkSession
    partitions = int(spark.conf.get(PARTITIONS))
    buckets = min(partitions, max(math.ceil(page_bytes(pages) / HASHED_BYTES), BUCKETS_PER_CORE * spark.sparkContext.defaultParallelism))
    last = None
    with session_setting(spark, PARTITIONS, buckets):
        dealt = scope.bucketed(deal_links(links, pages, least, buckets), ["key"], buckets, ("pulled",))
        pushed = dealt.where(~F.col("pulled")).select(F.col("key").alias("src"), F.col("other").alias("dst"), "cnt")
        pulled = dealt.where("pulled").select(F.col("other").alias("src"), F.col("key").alias("dst"), "cnt")
        pages = scope.bucketed(pages, ["page"], buckets)
        hashed = fit_in_hashes(pages)
        for i in range(iterations):
            nodes = pagerank_step(nodes, pushed, n, damping, pages, hashed=hashed, pulled=pulled, least=least)
            if save_each is not None:
                nodes = cut_lineage(nodes, f"{save_each}{i}")
            else:
                nodes, last = scope.bucketed_next(nodes, ["page"], buckets, last)
    return nodes.select("page", "rank")
