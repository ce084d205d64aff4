"""A Merkle manifest of a table: per source a tree of digests, and over the sources one root.

Slot pivot: node i of a level is child ``i % FANOUT`` of node ``i // FANOUT`` of the next.
One aggregate by parent spreads the children into ``FANOUT`` columns, each the maximum of
the one child that has the slot. Concatenated, the columns hash to the parent; without a
child's own column they are its siblings. So children come back out of the columns with
their proofs, and nothing is joined with itself.

Numbers of nodes come from a table written in ranges of ``(key, order)``: a row's place in
its range, and before it the rows of its key in lower ranges. A source of any size is thus
numbered by many tasks. Each level up holds a sixteenth of the nodes of the one below.

Defined results: a null column hashes as ``-``; a null source is a source of its own, the
first; null ids come first in a source, equal ids go by their leaf, and rows alike in all hashed
columns have each a leaf (alike, with proofs of their own places). Columns other than the
hashed ones take no part. An empty table gives no rows, and a root that nobody asks for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textgraph.llm.tables import table
from textgraph.scratch import cut_lineage

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def field(value: Column) -> Column:
    """A field of a leaf: its UTF-8 byte count, a colon, itself; a null is ``-``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    return digest(F.concat(*[field(v) for v in values]))


def group_key(col: str) -> Column:
    """Text without nulls, in the order of ``col`` with nulls first."""
    return F.coalesce(F.concat(F.lit("="), F.col(col).cast("string")), F.lit(""))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``number``, from 0 within each ``key`` by ``order``, and ``n``, the rows of the key."""
    place = ["_part", "_at"]
    ranges = rows.repartitionByRange("key", *order).sortWithinPartitions("key", *order)
    ranges = cut_lineage(ranges.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")))
    parts = ranges.groupBy("key", "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    # One row per key and range, of which a key has as many as tasks wrote it.
    by_key = Window.partitionBy("key")
    before = F.sum("_n").over(by_key.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("key", "_part", "_first", F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_n").over(by_key).alias("n"))
    number = F.col("_at") - F.col("_first") + F.col("_before")
    return ranges.join(parts, ["key", "_part"]).withColumn("number", number).drop("_first", "_before", *place)


def spread(nodes: DataFrame, fanout: int) -> DataFrame:
    """``(key, n, number, c0 .. )``: one row per parent, with each of its nodes in the column of its slot.

    A node is ``digest`` and all columns but ``key``, ``n`` and ``number``, which are those
    of the parent here. Nodes alone on their level have no parent.
    """
    child = F.struct("digest", *[c for c in nodes.columns if c not in ("key", "n", "number", "digest")])
    slot = F.pmod("number", F.lit(fanout))
    columns = [F.max(F.when(slot == i, child)).alias(f"c{i}") for i in range(fanout)]
    parent = ["key", F.expr(f"(n + {fanout - 1}) div {fanout}").alias("n"), F.expr(f"number div {fanout}").alias("number")]
    return nodes.where("n > 1").groupBy(*parent).agg(*columns)


def joined(slots: list[int]) -> Column:
    """The digests of the columns of ``slots``, end to end; a slot without a child is empty."""
    return F.concat(F.lit(""), *[F.coalesce(F.col(f"c{i}.digest"), F.lit("")) for i in slots])


def parents(level: DataFrame, fanout: int) -> DataFrame:
    return level.select("key", "n", "number", digest(joined([*range(fanout)])).alias("digest"))


def children(level: DataFrame, fanout: int) -> DataFrame:
    """``(key, number, child, top, path)``: the nodes of the columns, whose path starts with their siblings."""

    def slot(i: int) -> Column:
        step = F.struct(joined([*range(i)]).alias("before"), joined([*range(i + 1, fanout)]).alias("after"))
        return F.struct((F.col("number") * fanout + i).alias("number"), F.col(f"c{i}").alias("child"), step.alias("step"))

    out = level.select("key", "top", "path", F.explode(F.array(*[slot(i) for i in range(fanout)])).alias("x"))
    path = F.concat(F.array("x.step"), F.col("path")).alias("path")
    return out.where("x.child IS NOT NULL").select("key", "x.number", "x.child", "top", path)


def climb(nodes: DataFrame, fanout: int = FANOUT) -> tuple[list[DataFrame], DataFrame]:
    """The levels above ``nodes`` ``(key, n, number, digest, ..)``, a table, lowest first, and
    ``(key, top)``, the last digest of each key.

    Runs an aggregate for each level, of which there are as many as sixteenfolds in the largest key.
    """
    levels: list[DataFrame] = []
    top = nodes.where("n = 1").select("key", F.col("digest").alias("top"))
    while nodes.where("n > 1").limit(1).count():
        levels.append(cut_lineage(spread(nodes, fanout)))
        nodes = parents(levels[-1], fanout)
        top = top.unionByName(nodes.where("n = 1").select("key", F.col("digest").alias("top")))
    return levels, top


def descend(levels: list[DataFrame], nodes: DataFrame, tops: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """``(key, number, child, top, path)`` of all ``nodes``, the lowest.

    ``tops`` is ``(key, top, path)`` with the siblings above each key's last node, which its path
    ends with. It is joined where a key has one row, so a large key is not hot.
    """
    below = None
    for level in reversed(levels):
        last = level.where("n = 1").join(tops, "key")
        rest = last.limit(0) if below is None else level.where("n > 1").join(below.drop("child"), ["key", "number"])
        below = children(last.unionByName(rest), fanout)
    lone = nodes.where("n = 1")
    child = F.struct("digest", *[c for c in nodes.columns if c not in ("key", "n", "number", "digest")]).alias("child")
    lone = lone.join(tops, "key").select("key", "number", child, "top", "path")
    return lone if below is None else below.unionByName(lone)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda node, step: digest(F.concat(step["before"], node, step["after"])))


def manifest(docs: DataFrame, tampered: Column | None = None, fields: tuple[str, ...] = FIELDS, fanout: int = FANOUT) -> DataFrame:
    """``(doc_id, source, number, leaf, tampered_leaf, subroot, root, path)`` of every row.

    ``path`` is the proof: for each level up to the root the siblings before and after.
    ``tampered`` stands in place of ``text`` in ``tampered_leaf``. The levels are tables.
    """
    changed = F.col("leaf")
    if tampered is not None:
        other = leaf([tampered if c == "text" else F.col(c) for c in fields])
        changed = F.when(tampered.eqNullSafe(F.col("text")), F.col("leaf")).otherwise(other)
    named = docs.select(*dict.fromkeys([*fields, "doc_id", "source", "text"]))
    made = named.withColumns({"leaf": leaf([F.col(c) for c in fields]), "key": group_key("source")})
    made = made.select("key", "doc_id", F.col("leaf").alias("digest"), changed.alias("changed"))
    leaves = cut_lineage(numbered(made, ["doc_id", "digest"]))
    levels, subroots = climb(leaves, fanout)
    # The tree over the last digests of the sources, in the order of the sources.
    subroots = subroots.select(F.lit("").alias("key"), F.col("key").alias("source_key"), F.col("top").alias("digest"))
    sources = cut_lineage(numbered(subroots, ["source_key"]))
    above, root = climb(sources, fanout)
    root = root.withColumn("path", F.array().cast("array<struct<before:string,after:string>>"))
    tops = descend(above, sources, root, fanout)
    tops = cut_lineage(tops.select("child.source_key", "child.digest", "top", "path"))
    tops = tops.select(F.col("source_key").alias("key"), F.struct(F.col("digest").alias("subroot"), F.col("top").alias("root")).alias("top"), "path")
    return descend(levels, leaves, tops, fanout).select(
        "child.doc_id",
        F.when(F.col("key") != "", F.expr("substring(key, 2)")).alias("source"),
        "number",
        F.col("child.digest").alias("leaf"),
        F.col("child.changed").alias("tampered_leaf"),
        "top.subroot",
        "top.root",
        "path",
    )


def op13_merkle(spark, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and what a tampered text does to them."""
    touched = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    text = F.when(touched, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
    rows = manifest(table(spark, sf_dir, "documents"), text)
    proof = F.array_join(F.transform("path", lambda s: F.concat(s["before"], s["after"])), "")
    fold = folded(F.col("tampered_leaf"), F.col("path"))
    return rows.select("doc_id", "leaf", "subroot", "root", digest(proof).alias("proof_sha256"), fold.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root")
    )


# Levels of the SQL: sources of up to 16 ** DEPTH rows.
DEPTH = 7


def _sql() -> str:
    def part(col: str) -> str:
        return f"coalesce(octet_length(encode({col}::VARCHAR))::VARCHAR || ':' || {col}::VARCHAR, '-')"

    def hashed(text: str) -> str:
        return f"sha256({part('doc_id')} || {part('source')} || {part('lang')} || {part('n_chars')} || {part(text)})"

    # crc32, a byte at a time.
    byte = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    codes = "list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)"
    crc = f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), lambda c, b: {byte}), 4294967295)"
    lowered = f"translate(text, '{UPPER}', '{LOWER}')"

    def tree(name: str, rows: str) -> str:
        """``name_0``: rows (key, i, n, d); each level up has the parents, and ``name_s{l}`` the siblings."""
        out = [f"{name}_0 AS ({rows})"]
        for level in range(DEPTH):
            out.append(
                f"{name}_{level + 1} AS (SELECT key, i // 16 AS i, (any_value(n) + 15) // 16 AS n, "
                f"sha256(string_agg(d, '' ORDER BY i)) AS d FROM {name}_{level} WHERE n > 1 GROUP BY key, i // 16)"
            )
            around = f"OVER (PARTITION BY key, i // 16 ORDER BY i ROWS BETWEEN"
            out.append(
                f"{name}_s{level} AS (SELECT key, i, coalesce(string_agg(d, '') {around} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before, "
                f"coalesce(string_agg(d, '') {around} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after FROM {name}_{level} WHERE n > 1)"
            )
        return ",\n".join(out)

    def top(name: str) -> str:
        return " UNION ALL ".join(f"SELECT key, d FROM {name}_{level} WHERE n = 1" for level in range(DEPTH + 1))

    def fold(name: str, rows: str) -> str:
        """Up the tree, by rows (.., key, i, proof, node)."""
        for level in range(DEPTH):
            side = f"{name}_s{level}"
            rows = (
                f"SELECT r.* REPLACE (r.i // 16 AS i, CASE WHEN s.key IS NULL THEN r.proof ELSE r.proof || s.before || s.after END AS proof, "
                f"CASE WHEN s.key IS NULL THEN r.node ELSE sha256(s.before || r.node || s.after) END AS node) "
                f"FROM ({rows}) r LEFT JOIN {side} s ON r.key = s.key AND r.i = s.i"
            )
        return rows

    return f"""
WITH leaves AS (
    SELECT doc_id, coalesce('=' || source, '') AS key, {hashed("text")} AS leaf,
        CASE WHEN {crc} % 5 = 0 THEN {hashed(lowered)} ELSE {hashed("text")} END AS changed FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY key) AS n FROM leaves),
{tree("low", "SELECT key, i, n, leaf AS d FROM placed")},
subroots AS ({top("low")}),
ranked AS (SELECT '' AS key, key AS of, d, row_number() OVER (ORDER BY encode(key)) - 1 AS i, count(*) OVER () AS n FROM subroots),
{tree("high", "SELECT key, i, n, d FROM ranked")},
roots AS ({top("high")}),
climbed AS ({fold("low", "SELECT doc_id, leaf, key, key AS of, i, '' AS proof, changed AS node FROM placed")}),
crossed AS (SELECT c.* REPLACE ('' AS key, k.i AS i), k.d AS subroot FROM climbed c JOIN ranked k ON c.of = k.of),
done AS ({fold("high", "SELECT * FROM crossed")})
SELECT doc_id, leaf, subroot, (SELECT d FROM roots) AS root, sha256(proof) AS proof_sha256, node AS folded_root,
    node = (SELECT d FROM roots) AS verified FROM done"""


SQL = _sql()
