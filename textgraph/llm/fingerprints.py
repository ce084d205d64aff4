"""Document fingerprints as threshold-scaled sketches.

A sketch holds every hash of a shingle of ``WORDS`` words that lies in the lowest
``1 / SCALE`` of the range of hashes. Its size grows with the text, so sketches of
very unequal texts are compared fairly: the share of one in the other estimates
containment, and the union of two is the sketch of both texts together. A text
with shingles but none so low has its lowest hash, so only texts without words
have an empty sketch.

Letters A-Z are lowered; words are separated by spaces and the control characters
9 to 13; a text of fewer words is one shingle. Null texts are empty. Only DataFrame
functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textgraph.llm.tables import table
from textgraph.scratch import cut_lineage

WORDS = 5
SCALE = 8


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(low, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def sketch(text: Column, n: int = WORDS, scale: int = SCALE) -> Column:
    """The sketch of a text: rising distinct hashes."""
    below = -(1 << 63) + (1 << 64) // scale

    def kept(hashes: Column) -> Column:
        low = F.filter(hashes, lambda h: h < F.lit(below))
        return F.when(F.size(low) > 0, F.array_sort(F.array_distinct(low))).when(
            F.size(hashes) > 0, F.array(F.array_min(hashes))
        ).otherwise(F.array().cast("array<bigint>"))

    def shingles(words: Column) -> Column:
        last = F.greatest(F.size(words) - (n - 1), F.lit(1))
        hashes = F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice(words, i, F.lit(n))))
        return F.when(F.size(words) > 0, hashes).otherwise(F.array().cast("array<bigint>"))

    return let(words_of(text), lambda w: let(shingles(w), kept))


def merged(a: Column, b: Column, scale: int = SCALE) -> Column:
    """The sketch of two texts together, from theirs."""
    below = -(1 << 63) + (1 << 64) // scale
    both = F.array_sort(F.array_union(a, b))
    return let(both, lambda x: let(F.filter(x, lambda h: h < F.lit(below)), lambda low: F.when(F.size(low) > 0, low).otherwise(F.slice(x, 1, 1))))


def likeness(a: Column, b: Column) -> Column:
    """The estimate of the Jaccard similarity; 1 for two empty sketches."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def containment(a: Column, b: Column) -> Column:
    """The estimate of the share of a's shingles that b has; 1 for an empty a."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def as_text(hashes: Column) -> Column:
    return F.array_join(F.transform(hashes, lambda h: F.lower(F.hex(h))), " ")


def fingerprints(docs: DataFrame, n: int = WORDS, scale: int = SCALE) -> DataFrame:
    """``docs`` with the column ``sketch``."""
    return docs.withColumn("sketch", sketch(F.coalesce("text", F.lit("")), n, scale))


def neighbours(docs: DataFrame) -> DataFrame:
    """``(doc_id, rep, above, need)``: each id with the one before it in descending order, the
    last before the first, and the length that one's text needs a third of.

    Null is the least id. Of the texts of a repeated id, that of hash ``rep`` stands for it.
    """
    text = F.coalesce("text", F.lit(""))
    ids = docs.groupBy("doc_id").agg(F.max(F.length(text)).alias("n"), F.min(F.xxhash64(text)).alias("rep"))
    down = F.col("doc_id").desc_nulls_last()
    # Read twice below, and a range partitioning is drawn anew each time.
    ranged = cut_lineage(ids.repartitionByRange(down).withColumn("part", F.spark_partition_id()))
    order = F.struct(F.col("doc_id").isNotNull(), F.col("doc_id"))
    lasts = ranged.groupBy("part").agg(F.min_by(F.struct("doc_id", "n"), order).alias("end"))
    # As many rows as the ranges, not as the ids.
    each = Window.partitionBy(F.lit(0)).orderBy("part")
    whole = each.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carried = lasts.select("part", F.coalesce(F.lag("end").over(each), F.last("end").over(whole)).alias("carried"))
    within = F.lag(F.struct("doc_id", "n")).over(Window.partitionBy("part").orderBy(down))
    joined = ranged.withColumn("above", within).join(carried, "part")
    above = F.coalesce("above", "carried")
    return joined.select("doc_id", "rep", above["doc_id"].alias("above"), above["n"].alias("need"))


def compare_edited(docs: DataFrame) -> DataFrame:
    """Each row of ``(doc_id, text)`` with the sketches of its text, of its text with the last third
    replaced by the beginning of the next document's (descending ids, the first after the last),
    and of the next document.

    Rows of one id have the same next document: one with the next lower id.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    links = neighbours(docs).withColumnRenamed("doc_id", "_id")
    # Not an equality of two sides, which would become a key of the join: texts lie by id alone, in one
    # shuffle for both joins.
    stands = F.xxhash64("text").bitwiseXOR(F.col("rep")) == 0
    below = rows.join(links, F.col("doc_id").eqNullSafe(F.col("_id"))).where(stands)
    heads = below.select(
        F.col("above").alias("_above"), F.substring("text", F.lit(1), F.floor(F.col("need") / 3).cast("int")).alias("head"), sketch(F.col("text")).alias("next_sketch")
    )
    # Rows alike in id and text are one.
    heads = heads.groupBy("_above").agg(F.first("head").alias("head"), F.first("next_sketch").alias("next_sketch"))
    both = rows.join(heads, F.col("doc_id").eqNullSafe(F.col("_above")))
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - third), F.substring("head", F.lit(1), third))
    both = both.select("doc_id", n.cast("bigint").alias("n_chars"), edited.alias("edited"), sketch(F.col("text")).alias("sketch"), "next_sketch")
    return both.withColumn("edited_sketch", sketch(F.col("edited")))


def op4_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and how alike they are."""
    compared = compare_edited(table(spark, sf_dir, "documents"))
    return compared.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        containment(F.col("edited_sketch"), F.col("sketch")).alias("kept_in_edited"),
    )
