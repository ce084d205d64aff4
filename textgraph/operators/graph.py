"""The parts of PageRank: pages, links, and one step.

Shapes: an adjacency table ``(page, rank, links)`` or ``(page, links)`` with one
line per page; links ``(src, dst)``, one row each, or ``(src, dst, cnt)``, one row for so many; pages ``(page, out_degree,
is_line)``; nodes ``(page, rank, out_degree)``.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textgraph.operators.skew import HOT_FLOOR, every_piece, find_hot, key_hash, or_one, piece_of
from textgraph.operators.terms import MAX_TERM_BYTES, is_small
from textgraph.scratch import cut_lineage

DAMPING = 0.85
# A hash table of pages takes about so many bytes a page besides its name, and may take so many a partition.
PAGE_BYTES = 100
HASHED_BYTES = 128 << 20
# A hub has so many links at least; there are so many hubs at most, as their credits are broadcast, and with fewer links than these none is needed.
HUB_LINKS = 64
MAX_HUBS = 500_000
HUB_FLOOR = 1_000_000


def prepare_graph(adj: DataFrame, initial_rank: float = 1.0) -> DataFrame:
    """``(page, rank, links)`` with the starting rank on every line."""
    return adj.select("page", F.lit(float(initial_rank)).alias("rank"), "links")


def node_count(adj: DataFrame) -> DataFrame:
    """``(n)``: the number of adjacency lines, repeated pages included."""
    return adj.agg(F.count("*").alias("n"))


def list_order(links: Column) -> Column:
    """A number of eight bytes that never falls where the list rises: its first seven bytes of text.

    A longer list or text behind them is not told apart.
    """
    head = F.rpad(F.hex(F.substring(F.encode(F.get(links, F.lit(0)), "UTF-8"), 1, 7)), 14, "0")
    number = F.coalesce(F.conv(head, 16, 10).cast("bigint"), F.lit(0))
    return F.when(links.isNull(), F.lit(-2)).when(F.size(links) == 0, F.lit(-1)).otherwise(number).cast("bigint")


def dedupe_adjacency(adj: DataFrame) -> DataFrame:
    """One line per page: of several, the one with the greatest link list.

    An aggregate over ``list_order`` finds the pages with more than one line, and their
    greatest number. The other pages pass as they are, lists and all: only lines that share
    a page and its number are shuffled and compared by their lists. Writes the pages found.
    """
    lines = adj.groupBy("page").agg(F.count("*").alias("lines"), F.max(list_order(F.col("links"))).alias("_top"))
    repeated = cut_lineage(lines.where("lines > 1").select(F.col("page").alias("_page"), "_top"))
    if is_small(repeated):
        repeated = F.broadcast(repeated)
    marked = adj.join(repeated, F.col("page").eqNullSafe(F.col("_page")), "left")
    rest = [F.desc(c) for c in adj.columns if c not in ("page", "links")]
    place = F.row_number().over(Window.partitionBy("page").orderBy(F.desc("links"), *rest))
    greatest = marked.where(list_order(F.col("links")) == F.col("_top")).withColumn("_place", place).where("_place = 1")
    return marked.where("_top IS NULL").select(*adj.columns).unionByName(greatest.select(*adj.columns))


def links_of(adj: DataFrame) -> DataFrame:
    """``(src, dst)`` with repeated links kept; a page without links has none."""
    return adj.select(F.col("page").alias("src"), F.explode("links").alias("dst"))


def count_links(links: DataFrame, *keep: str) -> DataFrame:
    """``(src, dst, *keep, cnt)``: each link once, with how often it stands. Columns to ``keep`` follow from the link."""
    return links.groupBy("src", "dst", *keep).agg(F.count("*").alias("cnt"))


def page_table(links: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """``(page, out_degree, is_line)`` of sources, targets and the pages of ``lines``.

    ``is_line`` tells the pages that have a line of their own, which are the
    sources and those of ``lines``, from mere targets.
    """
    def end(page: str, out: int, line: bool) -> Column:
        return F.struct(F.col(page).alias("page"), F.lit(out).alias("out"), F.lit(line).alias("line"))

    ends = links.select(F.inline(F.array(end("src", 1, True), end("dst", 0, False))))
    if lines is not None:
        ends = ends.unionByName(lines.select("page", F.lit(0).alias("out"), F.lit(True).alias("line")))
    return ends.groupBy("page").agg(F.sum("out").alias("out_degree"), F.bool_or("line").alias("is_line"))


def hot_sources(pages: DataFrame, floor: int = HOT_FLOOR) -> DataFrame | None:
    """``(hash, pieces)`` for pages with more links than one task should take, or
    None where there are none. Runs one aggregate over the pages."""
    hot = find_hot(pages, "page", "out_degree", floor)
    return None if hot is None else hot.select("hash", "pieces")


def split_sources(links: DataFrame, hot: DataFrame | None) -> DataFrame:
    """Links with the ``piece`` of their source they belong to, if any is hot."""
    if hot is None:
        return links
    cut = links.join(F.broadcast(hot), key_hash("src") == F.col("hash"), "left")
    return cut.select(*links.columns, piece_of(or_one(), "dst").alias("piece"))


def page_bytes(pages: DataFrame) -> int:
    """About how many bytes hash tables of all pages take. Runs one aggregate over the pages."""
    size = F.lit(PAGE_BYTES) + F.coalesce(F.octet_length(F.col("page").cast("string")), F.lit(0))
    return pages.agg(F.sum(size.cast("bigint"))).first()[0] or 0


def fit_in_hashes(pages: DataFrame, most: int = HASHED_BYTES) -> bool:
    """Whether the pages of one shuffle partition make a hash table of ``most`` bytes at most. Runs one aggregate over the pages."""
    return page_bytes(pages) <= most * int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hub_degree(pages: DataFrame) -> int | None:
    """The least out-degree of a hub, or None where hubs have too few links to matter.

    Hubs are the pages with the most links, as many as a broadcast may hold. Runs one aggregate over the pages, by quarters of octaves.
    """
    quarter = F.floor(F.log2("out_degree") * 4).alias("quarter")
    size = F.sum(F.octet_length(F.col("page").cast("string")))
    counts = pages.where(F.col("page").isNotNull() & (F.col("out_degree") >= HUB_LINKS)).groupBy(quarter).agg(
        F.count("*").alias("n"), size.alias("bytes"), F.sum("out_degree").alias("links"), F.min("out_degree").alias("least")
    )
    n = size = links = 0
    least = None
    for row in counts.orderBy(F.desc("quarter")).collect():
        n, size = n + row["n"], size + row["bytes"]
        if n > MAX_HUBS or size > MAX_TERM_BYTES:
            break
        links, least = links + row["links"], row["least"]
    return least if links >= HUB_FLOOR else None


def deal_links(links: DataFrame, pages: DataFrame, least: int, buckets: int) -> DataFrame:
    """``(key, other, pulled, cnt)``: counted links dealt to ``buckets``, those of hubs by their target, others by their source.

    ``key`` is that end of the link, ``other`` the other one, and ``pulled`` tells the links of hubs.
    """
    hubs = F.broadcast(pages.where(F.col("out_degree") >= least).select(F.col("page").alias("_hub")))
    marked = links.join(hubs, F.col("src") == F.col("_hub"), "left").withColumn("pulled", F.col("_hub").isNotNull())
    ends = F.when(F.col("pulled"), F.struct(F.col("dst").alias("key"), F.col("src").alias("other"))).otherwise(
        F.struct(F.col("src").alias("key"), F.col("dst").alias("other"))
    )
    dealt = marked.select(ends.alias("ends"), "pulled").select("ends.*", "pulled").repartition(buckets, "key")
    return dealt.groupBy("key", "other", "pulled").agg(F.count("*").alias("cnt"))


def hashed_if(df: DataFrame, hashed: bool) -> DataFrame:
    """A table of one row a page that the other side of its join streams past, so that neither is sorted."""
    return df.hint("shuffle_hash") if hashed else df


def rank_contributions(nodes: DataFrame, links: DataFrame, hot: DataFrame | None = None, hashed: bool = False) -> DataFrame:
    """``(page, credit)``: ``rank / out_degree`` of the source, for each link.

    A repeated link counts each time, and in counted links is one row of so many credits; pages without links send nothing. With
    ``hot``, links must come from ``split_sources``: a hot source sends to each
    of its pieces. ``hashed`` tells that the nodes ``fit_in_hashes``: then the links are not sorted.
    """
    share = (F.col("rank") / F.col("out_degree")).alias("credit")
    senders = nodes.where("out_degree > 0").select(F.col("page").alias("src"), share)
    on = ["src"]
    if hot is not None:
        senders = senders.join(F.broadcast(hot), key_hash("src") == F.col("hash"), "left").select(
            "src", "credit", every_piece(or_one()).alias("piece")
        )
        on = ["src", "piece"]
    credit = F.col("credit") * F.col("cnt") if "cnt" in links.columns else F.col("credit")
    return links.join(hashed_if(senders, hashed), on).select(F.col("dst").alias("page"), credit.alias("credit"))


def pagerank_step(
    nodes: DataFrame,
    links: DataFrame,
    n: int | Column,
    damping: float = DAMPING,
    pages: DataFrame | None = None,
    hot: DataFrame | None = None,
    hashed: bool = False,
    pulled: DataFrame | None = None,
    least: int = 0,
) -> DataFrame:
    """Nodes after one step: ``damping * S + (1 - damping) / n``.

    S is the credit a page receives, 0 for a page nobody links to. ``pages``
    has every page of the result and its out-degree; by default those are the
    pages of ``nodes`` and the targets of links, which have none of their own.
    Rank of pages without links is not handed back. ``hashed``: as in ``rank_contributions``.
    ``pulled``, which goes with ``pages``, has the counted links of hubs, pages with ``least`` links or more, in buckets by target: the credits of
    hubs are broadcast to them.
    """
    total = n if isinstance(n, Column) else F.lit(n)
    credit = F.coalesce("credit", F.lit(0.0))
    hubs = []
    if pulled is not None:
        met = rank_contributions(F.broadcast(nodes.where(F.col("out_degree") >= least)), pulled)
        hubs = [met.groupBy("page").agg(F.sum("credit").alias("hub_credit"))]
        nodes = nodes.where(F.col("out_degree") < least)
        credit = credit + F.coalesce("hub_credit", F.lit(0.0))
    received = rank_contributions(nodes, links, hot, hashed).groupBy("page").agg(F.sum("credit").alias("credit"))
    base = F.lit(float(1 - Decimal(str(damping)))) / total
    rank = F.lit(damping) * credit + base
    if pages is None:
        every = nodes.select("page", "out_degree").join(received, "page", "full")
    else:
        every = pages.select("page", "out_degree")
        for side in [received, *hubs]:
            every = every.join(hashed_if(side, hashed), "page", "left")
    return every.select("page", rank.alias("rank"), F.coalesce("out_degree", F.lit(0)).alias("out_degree"))


def attach_links(ranks: DataFrame, adj: DataFrame) -> DataFrame:
    """``(page, rank, links)`` of deduplicated lines, ready for another run.

    A page that is only a target gets an empty list.
    """
    return ranks.join(adj.select("page", "links"), "page", "left").select(
        "page", "rank", F.coalesce("links", F.array().cast("array<string>")).alias("links")
    )

