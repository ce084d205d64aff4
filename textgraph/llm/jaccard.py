"""Exact n-gram Jaccard join of whole texts by PartEnum signatures.

The set of a text holds its distinct shingles. Sets lie in bands by size, such that
two similar ones are in one band or in neighbouring ones. In a band, two sets that
reach the threshold differ in at most k shingles. Shingles are dealt by hash to n1
partitions of n2 parts each; if n1 > k / (k2 + 1), some partition has at most k2
differences, so the sets agree on some ``n2 - k2`` of its parts. Each such choice
of parts is a signature, and similar sets share one. Where all chosen parts are empty,
which says next to nothing, the signatures are the shingles of the partition, whole and
without any one of them: with one difference, one of both sets is the other without a
shingle. Bands in which similar sets are equal have no signatures, as equal sets are one class.

Texts with equal sets are one class, by a hash of the set. Classes that share a
signature are candidates. A parity sketch, whose distance never exceeds the number
of differences, rules most out; the sets of the rest are counted out exactly.
Where many classes share a signature, only the first is paired with each at once.
After the links so found are joined to components, classes of that signature are
paired only across components, and sketches are compared before a pair is a row. So close copies cost what they number, not its
square, and no component is missed. A large crowd is cut into blocks, and each pair of blocks is a group of its own.

Defined results: a text with fewer words than n has one shingle, its whole sequence;
one without words (or null) has none and is linked with nothing. A component's id
is its least document id; null ids count where no other is. Documents alike in all
columns are kept apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgraph.llm.components import components
from textgraph.llm.hashing import U64, Empty, mix, shingle_sets
from textgraph.llm.tables import keeps_columns, map_blocks, table
from textgraph.operators.terms import is_small
from textgraph.scratch import cut_lineage

# Rows by themselves take small blocks; signatures of one block are a blob for each bucket.
ROWS_BYTES = 1 << 20
BLOCK_BYTES = 2 << 20
CHARS_PER_BUCKET = 1 << 20
LEAST_BUCKETS = 256
CROWD = 32
CROWD_BLOCK = 1024
PARTS, SPARE = 4, 1
LOW48 = U64((1 << 48) - 1)
_edges = Empty()


def band_starts(num: int, den: int, most: int) -> np.ndarray:
    """The least size of each band: a set and one similar to it lie at most one band apart."""
    known = _edges.get((num, den))
    if known is None or known[-1] <= most:
        starts = [1]
        while starts[-1] <= 2 * most + 2:
            starts.append(starts[-1] * den // num + 1)
        known = _edges[num, den] = np.array(starts)
    return known


def differences(num: int, den: int, starts: np.ndarray) -> np.ndarray:
    """By band, how many shingles two similar sets can differ in, the smaller one in the band."""
    last = np.append(starts[1:], starts[-1] * den // num + 1) - 1
    return (den - num) * (last + last * den // num) // (den + num)


def signatures(sets: np.ndarray, first: np.ndarray, num: int, den: int, n2: int = PARTS, k2: int = SPARE) -> tuple[np.ndarray, np.ndarray]:
    """``(signature, row)`` of all sets, whose sizes are above 0."""
    sizes = np.diff(first)
    starts = band_starts(num, den, int(sizes.max(initial=1)))
    most = differences(num, den, starts)
    band = np.searchsorted(starts, sizes, side="right") - 1
    out, owner = [], []
    # A set is the smaller of a pair in its own band, and the larger in the one below.
    for shift in (0, 1):
        rows = np.flatnonzero(band >= shift)
        rows = rows[most[band[rows] - shift] > 0]
        if not len(rows):
            continue
        at = band[rows] - shift
        n1 = most[at] // (k2 + 1) + 1
        offset = np.cumsum(n1) - n1
        member = np.concatenate([np.arange(first[r], first[r + 1]) for r in rows.tolist()]) if len(rows) < len(sizes) else np.arange(len(sets))
        of = np.repeat(np.arange(len(rows)), sizes[rows])
        x = sets[member]
        q = mix(x + U64(0x51ED270B9F0AF731))
        part = ((q >> U64(32)) * n1[of].astype(U64)) >> U64(32)
        inner = ((q & U64(0xFFFFFFFF)) * U64(n2)) >> U64(32)
        group = offset[of] + part.astype(np.int64)
        cell = group * n2 + inner.astype(np.int64)
        x = mix(x)
        sums = np.zeros(int(n1.sum()) * n2, U64)
        np.add.at(sums, cell, x)
        held = np.zeros(len(sums), bool)
        held[cell] = True
        held, whole = held.reshape(-1, n2), sums.reshape(-1, n2).sum(axis=1, dtype=U64)
        sums = mix(sums).reshape(-1, n2)
        row = np.repeat(np.arange(len(rows)), n1)
        place = np.arange(len(row)) - offset[row]
        base = mix((at[row].astype(U64) << U64(40)) + (place.astype(U64) << U64(8)))
        for c, chosen in enumerate(combinations(range(n2), n2 - k2)):
            total = base + U64(c)
            for j in chosen:
                total = total + mix(sums[:, j] + U64(j + 1))
            said = held[:, chosen].any(axis=1) | (k2 != 1)
            out.append(mix(total[said]))
            owner.append(rows[row[said]])
        if k2 == 1:
            thin = held.sum(axis=1) <= 1
            without = thin[group]
            base = mix(base + U64(0xFF))
            out += [mix(base[thin] + mix(whole[thin])), mix(base[group[without]] + mix(whole[group[without]] - x[without]))]
            owner += [rows[row[thin]], rows[of[without]]]
    if not out:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    return np.concatenate(out), np.concatenate(owner)


def parity_sketch(values: np.ndarray) -> bytes:
    """One bit for each cell of a power of 2: whether an odd number of hashes fall into it."""
    cells = 1 << max(6, int(len(values) - 1).bit_length())
    odd = np.bincount((mix(values) & U64(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def sketch_distance(a: bytes, b: bytes) -> int:
    """The number of unlike bits; the larger sketch is folded to the size of the smaller."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    n = min(len(x), len(y))
    while len(x) > n:
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > n:
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def low_bytes(sig: np.ndarray) -> bytes:
    """The lower 48 bits of each signature; a chance meeting is only one more candidate."""
    return np.ascontiguousarray(sig.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def from_low_bytes(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return wide.reshape(-1).view("<u8")


def class_of(sets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of each set."""
    sums = np.zeros(len(sets) + 1, U64)
    np.cumsum(mix(sets + U64(0xA5A5A5A5)), dtype=U64, out=sums[1:])
    return mix(sums[first[1:]] - sums[first[:-1]] + np.diff(first).astype(U64)).view(np.int64)


def mark(docs: DataFrame, n: int) -> DataFrame:
    """``(doc_id, th, n_shingles, class, sketch)`` of each document; ``th`` is a hash of its text."""

    def work(block: pa.RecordBatch) -> pa.RecordBatch:
        sets, first = shingle_sets(block.column("text"), n)
        sizes = np.diff(first)
        sketches = [parity_sketch(sets[first[i] : first[i + 1]]) if sizes[i] else b"" for i in range(len(sizes))]
        cols = [block.column("doc_id"), block.column("th"), pa.array(sizes, pa.int64()), pa.array(class_of(sets, first)), pa.array(sketches, pa.binary())]
        return pa.record_batch(cols, ["doc_id", "th", "n_shingles", "class", "sketch"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"), "text")
    return map_blocks(rows, work, f"doc_id {id_type}, th bigint, n_shingles bigint, class bigint, sketch binary", ROWS_BYTES)


def sign(docs: DataFrame, n: int, num: int, den: int, buckets: int) -> DataFrame:
    """``(bucket, classes, counts, sigs)``: the signatures of the classes of each block, by bucket."""

    def work(block: pa.RecordBatch) -> pa.RecordBatch:
        sets, first = shingle_sets(block.column("text"), n)
        sizes, classes = np.diff(first), class_of(sets, first)
        real = np.flatnonzero(sizes)
        _, one = np.unique(classes[real], return_index=True)
        one = np.sort(real[one])
        small = np.concatenate([[0], np.cumsum(sizes[one])])
        member = np.repeat(first[:-1][one] - small[:-1], sizes[one]) + np.arange(small[-1])
        sig, row = signatures(sets[member], small, num, den)
        bucket = ((sig >> U64(48)) * U64(buckets) >> U64(16)).astype(np.int32)
        order = np.lexsort((row, bucket))
        sig, row, bucket = sig[order], row[order], bucket[order]
        edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=buckets))
        blobs = []
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            who, counts = np.unique(row[a:b], return_counts=True)
            blobs.append((int(bucket[a]), classes[one[who]].tobytes(), counts.astype(np.uint32).tobytes(), low_bytes(sig[a:b])))
        cols = list(zip(*blobs, strict=True)) if blobs else [(), (), (), ()]
        kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.record_batch([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["bucket", "classes", "counts", "sigs"])

    return map_blocks(docs.select("text"), work, "bucket int, classes binary, counts binary, sigs binary", BLOCK_BYTES)


def pairs_of_groups(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of values with one key; keys are sorted."""
    left, right = [], []
    step = 1
    at = np.arange(len(key) - 1)
    while len(at):
        at = at[at + step < len(key)]
        at = at[key[at] == key[at + step]]
        left.append(value[at])
        right.append(value[at + step])
        step += 1
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def distinct_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low, high = np.minimum(a, b), np.maximum(a, b)
    order = np.lexsort((high, low))
    low, high = low[order], high[order]
    new = np.ones(len(low), bool)
    new[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    return low[new], high[new]


def candidates(blobs: DataFrame) -> DataFrame:
    """``(a, b, crowd)``: pairs of classes that share a signature, and the members of crowds.

    Where more than ``CROWD`` classes share one, ``crowd`` is its name, ``a`` a member, and ``b`` the first.
    """

    def work(group: pa.Table) -> pa.Table:
        classes = [np.frombuffer(x, np.int64) for x in group.column("classes").to_pylist()]
        counts = [np.frombuffer(x, np.uint32) for x in group.column("counts").to_pylist()]
        owner = np.concatenate([np.repeat(c, n) for c, n in zip(classes, counts, strict=True)])
        sig = np.concatenate([from_low_bytes(x) for x in group.column("sigs").to_pylist()])
        order = np.lexsort((owner, sig))
        sig, owner = sig[order], owner[order]
        new = np.ones(len(sig), bool)
        new[1:] = (sig[1:] != sig[:-1]) | (owner[1:] != owner[:-1])
        sig, owner = sig[new], owner[new]
        start = np.flatnonzero(np.append(True, sig[1:] != sig[:-1])[: len(sig)])
        size = np.diff(np.append(start, len(sig)))
        each = np.repeat(size, size)
        few = (each > 1) & (each <= CROWD)
        a, b = distinct_pairs(*pairs_of_groups(sig[few], owner[few]))
        many = each > CROWD
        lead = np.repeat(owner[start], size)[many]
        bucket = group.column("bucket")[0].as_py()
        name = (mix(sig[many] + (U64(bucket) << U64(48)))).view(np.int64)
        crowd = pa.concat_arrays([pa.nulls(len(a), pa.int64()), pa.array(name, pa.int64())])
        return pa.table([pa.array(np.concatenate([a, owner[many]]), pa.int64()), pa.array(np.concatenate([b, lead]), pa.int64()), crowd], ["a", "b", "crowd"])

    return blobs.groupBy("bucket").applyInArrow(work, "a bigint, b bigint, crowd bigint")


def folded(sketches: list[bytes], size: int) -> np.ndarray:
    """Sketches of ``size`` bytes or more, as rows of 64-bit words, folded to ``size`` bytes."""
    rows = np.frombuffer(b"".join(sketches), np.uint8).reshape(len(sketches), -1)
    while rows.shape[1] > size:
        half = rows.shape[1] // 2
        rows = rows[:, :half] ^ rows[:, half:]
    return np.ascontiguousarray(rows).view(np.uint64)


def close_pairs(
    label: np.ndarray, n: np.ndarray, sketches: list[bytes], num: int, den: int, side: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """The places of all pairs unlike in label (and in side, if given) whose sizes and sketches allow the threshold."""
    wide = np.array([len(x) for x in sketches])
    left, right = [], []
    for small in np.unique(wide).tolist():
        ours = np.flatnonzero(wide == small)
        rest = np.flatnonzero(wide >= small)
        a, b = folded([sketches[i] for i in ours], small), np.zeros((len(rest), small // 8), np.uint64)
        for size in np.unique(wide[rest]).tolist():
            at = np.flatnonzero(wide[rest] == size)
            b[at] = folded([sketches[i] for i in rest[at]], small)
        for i, row in zip(ours.tolist(), a, strict=True):
            ok = (label[rest] != label[i]) & ((wide[rest] > small) | (rest > i))
            if side is not None:
                ok &= side[rest] != side[i]
            ok &= np.minimum(n[rest], n[i]) * den >= num * np.maximum(n[rest], n[i])
            at = np.flatnonzero(ok)
            near = np.bitwise_count(b[at] ^ row).sum(axis=1) <= (den - num) * (n[rest[at]] + n[i]) // (den + num)
            right.append(rest[at[near]])
            left.append(np.full(len(right[-1]), i))
    return np.concatenate(left), np.concatenate(right)


def across(crowds: DataFrame, labels: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """``(a, b)``: pairs of a crowd's members that lie in different components so far, and whose
    sizes and sketches do not rule them out.

    Crowds of close copies have much the same members and so the same first one, by which they are
    grouped: a member travels once with the names of its crowds, and a pair is found once.
    """
    members = crowds.groupBy(F.col("b").alias("first"), "a").agg(F.collect_set("crowd").alias("crowds"))
    labelled = members.join(labels.withColumnRenamed("node", "a"), "a", "left").select("first", "a", "crowds", F.coalesce("label", "a").alias("label"))
    # Crowds within one component have no pair left.
    open_ = labelled.groupBy("first").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("size"))
    open_ = open_.where("low <> high").select("first", F.ceil(F.col("size") / CROWD_BLOCK).alias("blocks"))
    known = classes.select(F.col("class").alias("a"), "n", "sketch")

    def work(group: pa.Table) -> pa.Table:
        member, label, n, own, i, j = (group.column(c).to_numpy() for c in ("a", "label", "n", "own", "i", "j"))
        side = own if i[0] != j[0] else None
        sketches, names = group.column("sketch").to_pylist(), group.column("crowds").combine_chunks()
        crowd, at = np.unique(names.flatten().to_numpy(), return_inverse=True)
        at, row = at.reshape(-1), np.repeat(np.arange(len(member)), names.value_lengths().to_numpy())
        order = np.argsort(at, kind="stable")
        sizes = np.bincount(at, minlength=len(crowd))
        # Whichever takes fewer comparisons: all members at once, or crowd by crowd.
        if len(member) ** 2 <= (sizes**2).sum():
            together = [np.arange(len(member))]
        else:
            together = np.split(row[order], np.cumsum(sizes)[:-1])
        left, right = [], []
        for who in together:
            if len(np.unique(label[who])) > 1:
                a, b = close_pairs(label[who], n[who], [sketches[k] for k in who.tolist()], num, den, None if side is None else side[who])
                left.append(member[who[a]])
                right.append(member[who[b]])
        a, b = distinct_pairs(np.concatenate(left), np.concatenate(right)) if left else (member[:0], member[:0])
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    dealt = labelled.join(open_, "first").withColumn("own", F.pmod(F.xxhash64("a"), "blocks"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    dealt = dealt.select("first", "a", "crowds", "label", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    return dealt.join(known, "a").groupBy("first", "i", "j").applyInArrow(work, "a bigint, b bigint")


def verify(pairs: DataFrame, classes: DataFrame, docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """``(a, b, shared, of)``: the pairs of classes that reach the threshold, with the sizes of intersection and union."""

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            small, large = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
            total = small + large
            most = (den - num) * total // (den + num)
            keep = np.minimum(small, large) * den >= num * np.maximum(small, large)
            x, y = batch.column("s_a"), batch.column("s_b")
            for i in np.flatnonzero(keep).tolist():
                keep[i] = sketch_distance(x[i].as_py(), y[i].as_py()) <= most[i]
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    for side in ("a", "b"):
        own = classes.select(F.col("class").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"s_{side}"))
        pairs = pairs.join(own, side)
    left = cut_lineage(pairs.select("a", "b", "n_a", "n_b", "s_a", "s_b").mapInArrow(alike, "a bigint, b bigint"))
    wanted = left.select(F.explode(F.array("a", "b")).alias("class")).distinct().join(classes, "class").select("class", "th", F.col("doc_id").alias("_id"))
    wanted = cut_lineage(wanted)
    if is_small(wanted.select("th")):
        wanted = F.broadcast(wanted)
    texts = docs.select("doc_id", "text").join(
        wanted, (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("th")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    )

    def expand(block: pa.RecordBatch) -> pa.RecordBatch:
        sets, first = shingle_sets(block.column("text"), n)
        values = [sets[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
        return pa.record_batch([block.column("class"), pa.array(values, pa.binary())], ["class", "items"])

    sets = cut_lineage(map_blocks(texts.select("class", "text"), expand, "class bigint, items binary", ROWS_BYTES).groupBy("class").agg(F.first("items").alias("items")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared, of = [], []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                p, q = np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                shared.append(both)
                of.append(len(p) + len(q) - both)
            keep = np.array(shared, np.int64) * den >= num * np.array(of, np.int64)
            out = [batch.column("a"), batch.column("b"), pa.array(shared, pa.int64()), pa.array(of, pa.int64())]
            yield pa.record_batch(out, ["a", "b", "shared", "of"]).filter(pa.array(keep))

    both = left.join(sets.select(F.col("class").alias("a"), F.col("items").alias("x")), "a")
    both = both.join(sets.select(F.col("class").alias("b"), F.col("items").alias("y")), "b")
    return cut_lineage(both.select("a", "b", "x", "y").mapInArrow(count, "a bigint, b bigint, shared bigint, of bigint"))


def similar(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(members, links, labels)``: ``(doc_id, th, n_shingles, class)`` of each document; the links ``(a, b,
    shared, of)`` between classes that were counted out; and ``(node, label)``, the components of linked classes.

    Two texts link when ``den`` times the size of their intersection reaches ``num`` times that
    of their union. Links join every component; where many classes share signatures, not each
    pair within a component is among them. Tables are written when called.
    """
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, chars // CHARS_PER_BUCKET)
    members = cut_lineage(mark(docs, n))
    # Texts of a class have equal sets and so equal sketches; the least id and text stand for it.
    classes = cut_lineage(
        members.where("n_shingles > 0").groupBy("class").agg(
            F.min(F.struct("doc_id", "th")).alias("one"), F.max("n_shingles").alias("n"), F.max("sketch").alias("sketch")
        ).select("class", "one.doc_id", "one.th", "n", "sketch")
    )
    found = cut_lineage(candidates(sign(docs, n, num, den, min(buckets, 1 << 16))))
    links = verify(found.where("a <> b").select("a", "b"), classes, docs, n, num, den)
    labels = components(links.select("a", "b"))
    crowds = found.where("crowd IS NOT NULL").select("crowd", "a", "b")
    if not crowds.isEmpty():
        more = verify(across(crowds, labels, classes, num, den), classes, docs, n, num, den)
        links = links.unionByName(more).distinct()
        labels = components(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(more.select("a", "b")))
    return members.select("doc_id", "th", "n_shingles", "class"), links, labels


def near_duplicates(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of each document."""
    members, _, labels = similar(docs, n, num, den)
    # Documents without words stand alone; null labels name no component.
    classes = members.where("n_shingles > 0").groupBy("class").agg(F.min("doc_id").alias("least"))
    named = classes.join(labels.withColumnRenamed("node", "class"), "class", "left").select("class", "least", F.coalesce("label", "class").alias("label"))
    ids = named.groupBy("label").agg(F.min("least").alias("component_id"))
    of = named.join(ids, "label").select(F.col("class").alias("_class"), "component_id")
    alone = F.col("n_shingles") == 0
    joined = members.join(of, (F.col("class") == F.col("_class")) & ~alone, "left")
    return joined.select("doc_id", "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def op1_jaccard(spark, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of three-word shingles are alike by 0.9 or more."""
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), 3, 90, 100)


def representatives(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``(doc_id, th, alone)``: of each component the least id, null ids last, and of equal ids the least
    hash of a text; and each document without words, which is ``alone``."""
    members, _, labels = similar(docs, n, num, den)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th")).alias("least")
    classes = members.where("n_shingles > 0").groupBy("class").agg(least)
    named = classes.join(labels.withColumnRenamed("node", "class"), "class", "left").select("least", F.coalesce("label", "class").alias("label"))
    first = named.groupBy("label").agg(F.min("least").alias("least")).select("least.doc_id", "least.th", F.lit(False).alias("alone"))
    wordless = members.where("n_shingles = 0").select("doc_id", "th", F.lit(True).alias("alone")).distinct()
    return first.unionByName(wordless)


@keeps_columns
def one_of_each(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of five-word shingle sets alike by 0.8 or more, one document, of least id.

    Rows are told apart by id and text, so a null or repeated id joins no unlike texts. Of
    documents without words only rows alike in all columns go.
    """
    kept = representatives(docs.select("doc_id", "text"))
    kept = kept.select(F.col("doc_id").alias("_id"), F.col("th").alias("_kept"), "alone")
    rows = docs.withColumn("_th", F.xxhash64(F.coalesce("text", F.lit(""))))
    rows = rows.join(kept, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_th") == F.col("_kept")))
    # A hash skips nulls, so it also takes which columns are null.
    whole = F.xxhash64(*docs.columns, *(F.col(c).isNull() for c in docs.columns))
    rows = rows.withColumn("_row", F.when(F.col("alone"), whole).otherwise(0))
    return rows.dropDuplicates(["doc_id", "_th", "_row"]).select(*docs.columns)


SQL = r"""
    WITH RECURSIVE words AS (
        SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents
    ), sets AS (
        SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
            ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS s FROM words
    ), items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets
    ), shared AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common, any_value(a.n) AS na, any_value(b.n) AS nb
        FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2
    ), links AS (
        SELECT a, b FROM shared WHERE 100 * common >= 90 * (na + nb - common)
        UNION SELECT b, a FROM shared WHERE 100 * common >= 90 * (na + nb - common)
    ), reached AS (
        SELECT doc_id AS a, doc_id AS b FROM sets
        UNION SELECT reached.a, links.b FROM reached JOIN links ON links.a = reached.b
    )
    SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id
    FROM sets JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY 1) USING (doc_id)"""
