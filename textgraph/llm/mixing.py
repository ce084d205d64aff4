"""Mixing sources to target weights by Pfair windows and earliest deadline first.

The documents of a source are cut into blocks of ``BLOCK`` documents, in a fixed
random order. Block j (from 1) of a source with share w of all weights is released
at slot ``floor((j - 1) / w)`` and due by slot ``ceil(j / w)``. Each slot takes, of the
released blocks, the one of the earliest deadline, ties to the smaller source key. Every
block gets a slot in its window, so each source is less than one block from its weight
at any slot, however many slots there are.

Periods of slots are laid out apart from each other, one row each. At the slot T where
two periods meet, a source has had ``floor(w T)`` blocks or one more; the fractions x of
``w T`` sum to the number of those with one more. A block that may lie on either side of T
(``open``) comes before it by earliest deadline, as long as no more than ``ceil`` of the sum
of x lie before T among the open blocks released at or after any slot. Some choice keeps
every such sum, by release and by deadline, between its floor and ceiling (two chains of sets
make a totally unimodular system, which x itself solves), and the earliest deadlines do as
well by deadline as any. No interval of slots then has more blocks than slots, which is what
earliest deadline first needs to meet all deadlines. A period is longer than any window, so
no block is open at two meetings.

When a source runs dry its slots stay empty and the rest goes on in proportion.
No document is left out. The driver holds one row for each source, at most ``MOST_SOURCES``
(ValueError beyond: group them first), and its weight as an integer of ``SCALE`` parts of the
whole, ``SCALE / LEAST_SHARE`` at least: a period has some slots more than the inverse of the
least share, and a task folds one period at a time, looking at each source in each slot.

Defined results: a null source is a source of its own; weights that are null, not positive or
not finite, or whose key is null, count as missing, and those of one key are added; documents
alike in all columns, and null ids, keep their number; an empty table gives an empty result;
further columns may have any name but those of the result (ValueError).
Only DataFrame functions are used.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textgraph.llm.fingerprints import let
from textgraph.llm.tables import keeps_columns, table

BLOCK = 16
PERIOD = 1024
SCALE = 1 << 38
LEAST_SHARE = 1 << 20
MOST_SOURCES = 100_000
PAGE = 256
PIECES = 256
ROWS_PER_PIECE = 50_000
FLATTEN = 0.5
RESULT = ("block", "release", "deadline", "slot", "place")


def source_key(col: str = "source") -> Column:
    """A key without nulls."""
    return F.coalesce(F.concat(F.lit("="), F.col(col).cast("string")), F.lit("null"))


def source_sizes(docs: DataFrame) -> DataFrame:
    """``(source_key, documents)``."""
    return docs.groupBy(source_key().alias("source_key")).agg(F.count("*").alias("documents"))


def flattened_weights(docs: DataFrame, power: float = FLATTEN) -> DataFrame:
    """``(source_key, weight)``: each source by its number of documents to a power, so large ones weigh less."""
    return source_sizes(docs).select("source_key", F.pow("documents", F.lit(power)).alias("weight"))


def integer_shares(weights: dict[str, float]) -> dict[str, int]:
    """Parts of a whole of about ``SCALE`` by source key, keys in order."""
    total = sum(weights.values())
    return {key: max(SCALE // LEAST_SHARE, round(w / total * SCALE)) for key, w in sorted(weights.items())}


def div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def wide(col: Column) -> Column:
    return col.cast("decimal(19, 0)")


def to_bytes(number: Column, width: int) -> Column:
    return F.unhex(F.lpad(F.hex(number), 2 * width, "0"))


def from_bytes(part: Column) -> Column:
    return F.conv(F.hex(part), 16, 10).cast("bigint")


def at_slot(sources: Column, whole: Column, slot: Column) -> Column:
    """Of each source ``(i, own, x, full, done)``: ``own * slot`` over ``whole`` is ``full`` and a rest
    ``x``, and ``done`` is the number of its blocks before the slot."""

    def rests(p: Column) -> Column:
        product = wide(p["own"]) * wide(slot)
        return F.struct(
            p["i"].alias("i"), p["own"].alias("own"), (product % wide(whole)).cast("bigint").alias("x"), div(product, wide(whole)).alias("full")
        )

    def open_block(p: Column) -> Column:
        due = div(whole - p["x"] + p["own"] - 1, p["own"])
        release = -div(p["x"] + p["own"] - 1, p["own"])
        return F.struct(due.alias("due"), p["i"].alias("i"), release.alias("release"), p["x"].alias("x"))

    def bound(o: Column, opened: Column) -> Column:
        later = F.aggregate(opened, F.lit(0).cast("bigint"), lambda n, q: n + F.when(q["release"] >= o["release"], q["x"]).otherwise(0))
        return F.struct(o["release"].alias("release"), div(later + whole - 1, whole).alias("room"))

    def choose(opened: Column) -> Column:
        def take(s: Column, o: Column) -> Column:
            full = F.exists(s["bounds"], lambda b: (b["release"] <= o["release"]) & (b["room"] <= 0))
            less = F.transform(
                s["bounds"],
                lambda b: F.struct(b["release"].alias("release"), (b["room"] - F.when(b["release"] <= o["release"], 1).otherwise(0)).alias("room")),
            )
            return F.when(full, s).otherwise(F.struct(less.alias("bounds"), F.concat(s["taken"], F.array(o["i"])).alias("taken")))

        bounds = F.transform(opened, lambda o: bound(o, opened))
        start = F.struct(bounds.alias("bounds"), F.array().cast("array<int>").alias("taken"))
        return F.aggregate(F.array_sort(opened), start, take, lambda s: s["taken"])

    def states(parts: Column) -> Column:
        opened = F.transform(F.filter(parts, lambda p: p["x"] > 0), open_block)
        taken = let(opened, choose)
        done = lambda p, chosen: p.withField("done", p["full"] + F.array_contains(chosen, p["i"]).cast("int"))
        return let(taken, lambda chosen: F.transform(parts, lambda p: done(p, chosen)))

    return let(F.transform(sources, rests), states)


def period_slots(sources: Column, whole: Column, period: Column, slots: Column, first: Column) -> Column:
    """``(slot, i, block)`` of the ``slots`` from ``first`` on, in a period of ``period`` slots that begins there."""

    def waiting(i: Column, own: Column, x: Column, full: Column, last: Column, block: Column) -> Column:
        nth = block - full
        due = F.least(period, div(nth * whole - x + own - 1, own))
        release = F.greatest(F.lit(0).cast("bigint"), div((nth - 1) * whole - x, own))
        return F.struct(
            due.alias("due"), i.alias("i"), F.when(block > last, period).otherwise(release).alias("release"),
            own.alias("own"), x.alias("x"), full.alias("full"), last.alias("last"), block.alias("block"),
        )

    def lay_out(begin: Column, end: Column) -> Column:
        heads = F.zip_with(begin, end, lambda p, q: waiting(p["i"], p["own"], p["x"], p["full"], q["done"], p["done"] + 1))
        nothing = F.lit(b"")
        start = F.struct(F.struct(heads.alias("heads"), nothing.alias("entry")).alias("now"), nothing.alias("book"), nothing.alias("page"))

        # A step of a fold copies its arrays and structs, but not its binaries. So entries are bytes, and
        # join the page a step later, and full pages the book.
        def step(s: Column, t: Column) -> Column:
            def serve(best: Column) -> Column:
                heads = F.transform(
                    s["now"]["heads"],
                    lambda h: F.when(h["i"] == best["i"], waiting(h["i"], h["own"], h["x"], h["full"], h["last"], h["block"] + 1)).otherwise(h),
                )
                return F.struct(heads.alias("heads"), F.concat(to_bytes(best["i"], 4), to_bytes(best["block"], 8)).alias("entry"))

            now = let(F.array_min(F.filter(s["now"]["heads"], lambda h: h["release"] <= t)), serve)
            page = F.concat(s["page"], s["now"]["entry"])
            turn = t % PAGE == 0
            return F.struct(
                now.alias("now"),
                F.when(turn, F.concat(s["book"], page)).otherwise(s["book"]).alias("book"),
                F.when(turn, nothing).otherwise(page).alias("page"),
            )

        def entries(book: Column) -> Column:
            def entry(t: Column) -> Column:
                at = (t * 12 + 1).cast("int")
                i, block = from_bytes(F.substring(book, at, F.lit(4))), from_bytes(F.substring(book, at + 4, F.lit(8)))
                return F.struct((first + t).alias("slot"), i.cast("int").alias("i"), block.alias("block"))

            return F.transform(times, entry)

        times = F.sequence(F.lit(0).cast("bigint"), slots - 1)
        return let(F.aggregate(times, start, step, lambda s: F.concat(s["book"], s["page"], s["now"]["entry"])), entries)

    return let(at_slot(sources, whole, first), lambda begin: let(at_slot(sources, whole, first + period), lambda end: lay_out(begin, end)))


def schedule(spark, shares: dict[str, int], blocks: dict[str, int], period: int = PERIOD) -> DataFrame:
    """``(source_key, own, block, slot)`` of all slots up to the last that a block needs, by the blocks of each source."""
    keys, whole = list(shares), sum(shares.values())
    need = max((-(-blocks.get(key, 0) * whole // own) for key, own in shares.items()), default=0)
    period = max(period, 2 + -(-whole // min(shares.values(), default=1)))
    sources = F.from_json(F.lit(json.dumps([{"i": i, "own": shares[key]} for i, key in enumerate(keys)])), "array<struct<i:int,own:bigint>>")
    names = F.from_json(F.lit(json.dumps(keys)), "array<string>")
    all_, length = F.lit(whole).cast("bigint"), F.lit(period).cast("bigint")
    rows = spark.range(-(-need // period)).select((F.col("id") * length).alias("first"))
    slots = F.least(length, F.lit(need).cast("bigint") - F.col("first"))
    return rows.select(F.explode(period_slots(sources, all_, length, slots, F.col("first"))).alias("s")).select(
        F.get(names, F.col("s.i")).alias("source_key"), F.get(sources, F.col("s.i"))["own"].alias("own"), "s.block", "s.slot"
    )


def numbered(docs: DataFrame, pieces: int) -> DataFrame:
    """``(row, source_key, number)``: ``docs`` as one struct, numbered from 0 within each source, in an order by hash.

    A source is numbered in pieces, and each piece is moved by the sizes of those before it.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    ids = [F.xxhash64("doc_id").alias("order"), F.col("doc_id").alias("id"), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")]
    cut = docs.select(row, source_key().alias("source_key"), *ids, F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(pieces)).alias("piece"))
    sizes = cut.groupBy("source_key", "piece").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("source_key").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1))
    moved = sizes.select("source_key", "piece", F.coalesce(before, F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("source_key", "piece").orderBy("order", "id", "whole")) - 1
    return (
        cut.withColumn("within", within)
        .join(moved, ["source_key", "piece"])
        .select("row", "source_key", (F.col("before") + F.col("within")).alias("number"))
    )


def mix(docs: DataFrame, weights: DataFrame | None = None, block: int = BLOCK, period: int = PERIOD) -> DataFrame:
    """``docs`` with ``block`` (from 1), ``release``, ``deadline``, ``slot`` and ``place`` (in the slot).

    ``weights`` is ``(source_key, weight)``; sources that it lacks have no slot (null) and come
    last. By default weights are ``flattened_weights``. ``period`` is the least number of slots
    that are laid out at a time. Counts the documents of each source when called.
    """
    if clash := [c for c in docs.columns if c in RESULT]:
        raise ValueError(f"columns {clash} are names of the result")
    spark = docs.sparkSession
    counts = {r["source_key"]: r["documents"] for r in source_sizes(docs).limit(MOST_SOURCES + 1).collect()}
    if weights is None:
        given = {key: n**FLATTEN for key, n in counts.items()}
    else:
        usable = weights.where("source_key IS NOT NULL AND weight > 0 AND weight < double('infinity')")
        rows = usable.groupBy("source_key").agg(F.sum("weight").cast("double").alias("weight")).limit(MOST_SOURCES + 1).collect()
        given = {r["source_key"]: r["weight"] for r in rows}
    if max(len(counts), len(given)) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    shares = integer_shares(given)
    whole = sum(shares.values())
    pieces = max(PIECES, -(-max(counts.values(), default=0) // ROWS_PER_PIECE))
    slots = schedule(spark, shares, {key: -(-n // block) for key, n in counts.items()}, period)
    j, own = wide(F.col("block")), wide(F.col("own"))
    rows = numbered(docs, pieces).withColumn("block", F.floor(F.col("number") / block) + 1)
    return rows.join(slots, ["source_key", "block"], "left").select(
        "row.*",
        "block",
        div((j - 1) * whole, own).alias("release"),
        div(j * whole + own - 1, own).alias("deadline"),
        "slot",
        F.pmod(F.col("number"), F.lit(block)).alias("place"),
    )


def op8_mixing(spark, sf_dir: str) -> DataFrame:
    """The slot of every document in a mix of all sources."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mix(docs)


@keeps_columns
def in_mixed_order(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, all columns, in the order of their slots."""
    order = [F.col("slot").asc_nulls_last(), F.col("source"), F.col("block"), F.col("place")]
    return mix(docs).repartitionByRange(*order).sortWithinPartitions(*order).select(*docs.columns)
