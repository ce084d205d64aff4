"""Phrase collocations by stripes.

A stripe belongs to a prefix of words in one language and counts the words that follow it.
Blocks of texts give partial stripes, and stripes of one prefix are merged elementwise, a
word at a time. From the merged stripes come the extensions of a prefix (phrases one word
longer), its total (the sum of its stripe, which also counts an end as "other"), and the
maximum by which a longer phrase may subsume it; the same for a word put in front, from
the extensions by their last words.

Stripes are made for prefixes of one, two and three words in turn. A phrase is only as frequent
as the phrases within it, so a stripe is made for prefixes that were frequent before, and
words whose addition ends on a phrase that was not are "other". Blocks know frequent phrases by a
sieve of ``SIEVE_BITS`` bits, whatever their number: what it lets pass wrongly is
counted and then dropped by its count. The stripe of a frequent prefix is cut by its next words
into parts of some ``HOT_FLOOR`` occurrences, or one in ``HOT_KEYS`` of all; there are fewer than ``HOT_KEYS`` such prefixes.

A phrase stands as the 64-bit hashes of its words, eight bytes each; two words share one with
a chance of 2**-64. Counts are whole numbers, and products are decimals of 38 digits.

Defined results: a null language is ``und``; null and empty texts have no words; copies
count each time; other columns take no part; an empty table has no phrases.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textgraph.llm.hashing import FOLD, PRIME, U64, as_bytes, mix, runs, span_hashes
from textgraph.llm.tables import map_blocks, table
from textgraph.operators.terms import is_small
from textgraph.scratch import cut_lineage

LONGEST = 4
LEAST = 30
COVER = 80
TOP = 2000
SCALE = 2_000_000
SIEVE_BITS = 1 << 26
SLICE_BITS = 1 << 18
HOT_KEYS = 10_000
HOT_FLOOR = 100_000
BLOCK_BYTES = 4 << 20
PIECES = 64

# What ends a piece, and what besides parts words.
_STOP = np.zeros(256, bool)
_STOP[[*b".,;:!?", 10, 11, 12, 13]] = True
_APART = _STOP.copy()
_APART[[0x20, 9]] = True


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(data, start, end, text, more)`` of the words of all texts, A-Z lowered: their bytes, the text
    each is of, and whether the next word is of the same piece."""
    data, starts = as_bytes(texts)
    data = FOLD[data]
    start, end, first = runs(~_APART[data], starts)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    piece = np.cumsum(_STOP[data], dtype=np.int32)[start] if len(start) else start
    more = np.zeros(len(start), bool)
    more[:-1] = (piece[1:] == piece[:-1]) & (text[1:] == text[:-1])
    return data, start, end, text, more


def languages(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct languages of a block, their hashes, and the one of each row."""
    coded = batch.column("lang").cast(pa.large_string()).fill_null("und").dictionary_encode()
    data, starts = as_bytes(coded.dictionary)
    return coded.dictionary, span_hashes(data, starts[:-1], starts[1:]), coded.indices.to_numpy()


def longer(ids: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Ids of phrases (at first, of languages) with one more word."""
    return mix(ids * PRIME + word)


def cut_out(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The spans of ``data`` as strings."""
    sizes = end - start
    ends = np.cumsum(sizes)
    at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - (ends - sizes), sizes)
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data[at])])


def word_counts(docs: DataFrame) -> DataFrame:
    """``(lang, word, f)`` of all words, and for each language a row without word for all of them."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, start, end, text, _ = tokens(batch.column("text"))
        langs, salts, of = languages(batch)
        lang = of[text]
        _, at, many = np.unique(longer(salts[lang], span_hashes(data, start, end)), return_index=True, return_counts=True)
        words = pa.concat_arrays([cut_out(data, start[at], end[at]), pa.nulls(len(langs), pa.large_string())])
        totals = np.bincount(lang, minlength=len(langs))
        code = pa.array(np.concatenate([lang[at], np.arange(len(langs))]))
        cols = [langs.take(code).cast(pa.string()), words.cast(pa.string()), pa.array(np.concatenate([many, totals]), pa.int64())]
        return pa.record_batch(cols, ["lang", "word", "f"])

    counts = map_blocks(docs.select("lang", "text"), work, "lang string, word string, f bigint", BLOCK_BYTES)
    return counts.groupBy("lang", "word").agg(F.sum("f").alias("f"))


def keyed(words: DataFrame) -> DataFrame:
    """``(lang, word, key, f)``: words with the hash they stand as."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = as_bytes(batch.column("word"))
            h = span_hashes(data, starts[:-1], starts[1:])
            yield pa.record_batch([batch.column("lang"), batch.column("word"), binaries(h[:, None]), batch.column("f")], ["lang", "word", "key", "f"])

    return words.select("lang", "word", "f").mapInArrow(work, "lang string, word string, key binary, f bigint")


def binaries(h: np.ndarray) -> pa.Array:
    """Rows of hashes as bytes."""
    width = 8 * h.shape[1]
    offsets = (np.arange(len(h) + 1) * width).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(h), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(h))])


def phrase_ids(langs: pa.Array, keys: pa.Array, words: int) -> np.ndarray:
    """The ids of phrases given as bytes, of so many words each."""
    coded = langs.cast(pa.large_string()).dictionary_encode()
    data, starts = as_bytes(coded.dictionary)
    ids = span_hashes(data, starts[:-1], starts[1:])[coded.indices.to_numpy()]
    h = np.frombuffer(b"".join(keys.to_pylist()), U64).reshape(len(keys), words)
    for i in range(words):
        ids = longer(ids, h[:, i])
    return ids


def sieve_places(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return ids & U64(SIEVE_BITS - 1), (ids >> U64(32)) & U64(SIEVE_BITS - 1)


def sieve_of(frequent: DataFrame, words: int) -> np.ndarray:
    """A bit for each of two places of every frequent phrase; ``SIEVE_BITS // 8`` bytes whatever their number."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.concatenate(sieve_places(phrase_ids(batch.column("lang"), batch.column("key"), words)))
            yield pa.record_batch([pa.array((at // U64(SLICE_BITS)).astype(np.int32)), pa.array((at % U64(SLICE_BITS)).astype(np.int32))], ["slice", "bit"])

    def bits(group: pa.Table) -> pa.Table:
        out = np.zeros(SLICE_BITS, bool)
        out[group.column("bit").to_numpy()] = True
        return pa.table({"slice": group.column("slice")[:1], "bits": pa.array([np.packbits(out, bitorder="little").tobytes()])})

    at = frequent.select("lang", "key").mapInArrow(places, "slice int, bit int").distinct()
    sieve = np.zeros(SIEVE_BITS // 8, np.uint8)
    for row in at.groupBy("slice").applyInArrow(bits, "slice int, bits binary").collect():
        sieve[row.slice * SLICE_BITS // 8 :][: SLICE_BITS // 8] = np.frombuffer(row.bits, np.uint8)
    return sieve


def passes(sieve: np.ndarray, ids: np.ndarray) -> np.ndarray:
    a, b = sieve_places(ids)
    return ((sieve[a >> U64(3)] >> (a & U64(7)).astype(np.uint8)) & (sieve[b >> U64(3)] >> (b & U64(7)).astype(np.uint8)) & np.uint8(1)).astype(bool)


def hot_prefixes(frequent: DataFrame, words: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids, sorted, and numbers of parts of the prefixes with more occurrences than a task should merge."""
    total = frequent.agg(F.sum("f")).first()[0] or 0
    bar = max(floor, total / HOT_KEYS)
    # Fewer than HOT_KEYS rows, as each has more than one part in HOT_KEYS of all.
    hot = frequent.where(F.col("f") > bar).select("lang", "key", "f").toArrow()
    if not hot.num_rows:
        return np.zeros(0, U64), np.zeros(0, U64)
    ids = phrase_ids(hot.column("lang").combine_chunks(), hot.column("key").combine_chunks(), words)
    parts = np.array([math.ceil(f / bar) for f in hot.column("f").to_pylist()], U64)
    order = np.argsort(ids)
    return ids[order], parts[order]


# What a stripe holds for each next word; a block has fewer words than a count can tell.
ENTRY = np.dtype([("next", "<u8"), ("many", "<u4")])
PARTIAL = "prefix_id bigint, part bigint, stripe binary"


def partial_stripes(docs: DataFrame, words: int, sieve: np.ndarray, hot: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """The stripes of prefixes of so many words, block by block; the next word 0 is "other"."""
    shared = docs.sparkSession.sparkContext.broadcast((sieve, *hot))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sieve, hot_ids, hot_parts = shared.value
        data, start, end, text, more = tokens(batch.column("text"))
        langs, salts, of = languages(batch)
        h = span_hashes(data, start, end)
        lang = of[text]
        n = len(h)
        # Phrases of so many words that start at each word.
        ids, whole = longer(salts[lang], h), np.ones(n, bool)
        for i in range(1, words):
            ids[: n - i] = longer(ids[: n - i], h[i:])
            whole[: n - i] &= more[i - 1 : n - 1]
            whole[max(0, n - i) :] = False
        whole &= passes(sieve, ids)
        # A phrase goes on if its piece does, and the phrase that starts a word later is frequent too.
        on = np.zeros(n, bool)
        on[: n - words] = more[words - 1 : n - 1] & whole[1 : n - words + 1]
        at = np.flatnonzero(whole)
        prefix = ids[at]
        following = np.where(on[at], h[np.minimum(at + words, n - 1)], U64(0))
        _, first, many = np.unique(longer(prefix, following), return_index=True, return_counts=True)
        prefix, following = prefix[first], following[first]
        part = np.zeros(len(prefix), U64)
        if len(hot_ids):
            where = np.minimum(np.searchsorted(hot_ids, prefix), len(hot_ids) - 1)
            cut = hot_ids[where] == prefix
            part[cut] = following[cut] % hot_parts[where[cut]]
        order = np.lexsort((part, prefix))
        prefix, part = prefix[order], part[order]
        stripe = np.empty(len(prefix), ENTRY)
        stripe["next"], stripe["many"] = following[order], many[order]
        new = np.flatnonzero(np.concatenate([np.ones(min(1, len(prefix)), bool), (prefix[1:] != prefix[:-1]) | (part[1:] != part[:-1])]))
        cols = [pa.array(prefix[new].view(np.int64)), pa.array(part[new].astype(np.int64)), packed(stripe, np.append(new, len(prefix)))]
        return pa.record_batch(cols, ["prefix_id", "part", "stripe"])

    return map_blocks(docs.select("lang", "text"), work, PARTIAL, BLOCK_BYTES)


def packed(entries: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Lists of entries as bytes."""
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer((offsets * ENTRY.itemsize).astype(np.int32)), pa.py_buffer(entries.tobytes())])


def unpacked(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The entries of all lists end to end, and the length of each list."""
    lists = lists.cast(pa.large_binary())
    starts = np.frombuffer(lists.buffers()[1], np.int64, len(lists) + 1, lists.offset * 8)
    data = np.frombuffer(lists.buffers()[2] or b"", np.uint8)[starts[0] : starts[-1]]
    return data.view(ENTRY), np.diff(starts) // ENTRY.itemsize


STRIPES = "prefix_id bigint, total bigint, next array<binary>, f array<bigint>"
# A stripe in the making: its prefix and part, and its words with their counts so far.
Open = tuple[int, int, np.ndarray, np.ndarray]


def merge_stripes(partial: DataFrame, frequent: DataFrame, words: int, least: int) -> DataFrame:
    """``(lang, prefix, total, next, f)``: stripes merged by word, then less the words counted under ``least``.

    A prefix that was cut has a row for each part. Rows come sorted, so a task holds a batch
    of them and the stripe that it ends in. They carry the id of their prefix alone: its language and words
    come from the ``frequent`` phrases once it is merged, and one that passed the sieve wrongly has none.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Open | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            done, held = merged(batch, held, least)
            yield done
        if held is not None:
            yield finished(np.array(held[:1]), np.zeros(len(held[2]), np.int64), held[2], held[3], least)

    key = ["prefix_id", "part"]
    stripes = partial.repartition(*key).sortWithinPartitions(*key).mapInArrow(work, STRIPES)
    return stripes.join(identified(frequent, words), "prefix_id").select("lang", "prefix", "total", "next", "f")


def identified(frequent: DataFrame, words: int) -> DataFrame:
    """``(prefix_id, lang, prefix)`` of phrases of so many words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = phrase_ids(batch.column("lang"), batch.column("key"), words)
            yield pa.record_batch([pa.array(ids.view(np.int64)), batch.column("lang"), batch.column("key")], ["prefix_id", "lang", "prefix"])

    return frequent.select("lang", "key").mapInArrow(work, "prefix_id bigint, lang string, prefix binary")


def merged(batch: pa.RecordBatch, held: Open | None, least: int) -> tuple[pa.RecordBatch, Open]:
    """The finished stripes of ``held`` and a batch, and the last one, which may go on."""
    ids, part = batch.column("prefix_id").to_numpy(), batch.column("part").to_numpy()
    stripe, sizes = unpacked(batch.column("stripe"))
    word, many = stripe["next"].astype(U64), stripe["many"].astype(np.int64)
    if held is not None:
        ids, part = np.append(held[0], ids), np.append(held[1], part)
        word, many, sizes = np.concatenate([held[2], word]), np.concatenate([held[3], many]), np.append(len(held[2]), sizes)
    new = np.concatenate([[True], (ids[1:] != ids[:-1]) | (part[1:] != part[:-1])])
    key = np.repeat(np.cumsum(new) - 1, sizes)
    order = np.lexsort((word, key))
    key, word, many = key[order], word[order], many[order]
    lead = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (word[1:] != word[:-1])]))
    key, word, many = key[lead], word[lead], np.add.reduceat(many, lead)
    first = np.flatnonzero(new)
    stay = key == len(first) - 1
    open_ = int(ids[-1]), int(part[-1]), word[stay], many[stay]
    return finished(ids[first[:-1]], key[~stay], word[~stay], many[~stay], least), open_


def finished(ids: np.ndarray, key: np.ndarray, word: np.ndarray, many: np.ndarray, least: int) -> pa.RecordBatch:
    total = np.zeros(len(ids), np.int64)
    np.add.at(total, key, many)
    kept = (many >= least) & (word != 0)
    key, word, many = key[kept], word[kept], many[kept]
    offsets = pa.array(np.searchsorted(key, np.arange(len(ids) + 1)), pa.int32())
    cols = [pa.array(ids, pa.int64()), pa.array(total), pa.ListArray.from_arrays(offsets, binaries(word[:, None])), pa.ListArray.from_arrays(offsets, pa.array(many))]
    return pa.record_batch(cols, ["prefix_id", "total", "next", "f"])


def extensions(stripes: DataFrame) -> DataFrame:
    """``(lang, key, f)``: the phrases that stripes lead to."""
    each = stripes.select("lang", "prefix", F.inline(F.arrays_zip("next", "f")))
    return each.select("lang", F.concat("prefix", "next").alias("key"), "f")


def totals(stripes: DataFrame) -> DataFrame:
    """``(lang, key, f)`` of the prefixes themselves."""
    return stripes.groupBy("lang", F.col("prefix").alias("key")).agg(F.sum("total").alias("f"))


def maxima(stripes: DataFrame) -> DataFrame:
    """``(lang, key, most)``: how often the most frequent phrase occurs that is one word longer, at either end."""
    after = stripes.select("lang", F.col("prefix").alias("key"), F.array_max("f").alias("most"))
    before = extensions(stripes).select("lang", F.expr("substring(key, 9)").alias("key"), F.col("f").alias("most"))
    return after.unionByName(before).groupBy("lang", "key").agg(F.max("most").alias("most"))


def whole(col: str) -> Column:
    return F.col(col).cast("decimal(20, 0)")


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, cover: int = COVER, hot_floor: int = HOT_FLOOR) -> DataFrame:
    """``(lang, phrase, a, l, r, n, score)`` of all phrases of 2 to ``longest`` words that occur ``least`` times
    and that no longer phrase covers to ``cover`` percent.

    Reads the texts once for each number of words up to ``longest``, while there are frequent phrases.
    """
    counts = cut_lineage(word_counts(docs).where(F.col("word").isNull() | (F.col("f") >= least)))
    words = cut_lineage(keyed(counts.where("word IS NOT NULL")))
    frequent, made = words.select("lang", "key", "f"), []
    for size in range(1, longest):
        if size > 1 and not frequent.limit(1).count():
            break
        sieve, hot = sieve_of(frequent, size), hot_prefixes(frequent, size, hot_floor)
        made.append(cut_lineage(merge_stripes(partial_stripes(docs, size, sieve, hot), frequent, size, least)))
        frequent = extensions(made[-1])
    union = lambda frames: reduce(DataFrame.unionByName, frames)
    found, known = union([extensions(s) for s in made]), union([totals(s) for s in made])
    covered = union([maxima(s) for s in made])
    kept = found.withColumnRenamed("f", "a").join(covered, ["lang", "key"], "left")
    kept = kept.where(F.col("most").isNull() | (whole("most") * 100 < whole("a") * cover)).select("lang", "key", "a")
    # Cut after each word but the last, and look both parts up.
    size = F.octet_length("key") / F.lit(8)
    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), (size - 1).cast("int"))))
    cuts = cuts.withColumns({"first": F.expr("substring(key, 1, 8 * k)"), "rest": F.expr("substring(key, 8 * k + 1)")})
    cuts = cuts.join(known.select("lang", F.col("key").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(known.select("lang", F.col("key").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    cuts = cuts.withColumn("score", F.expr(f"cast(a AS decimal(20, 0)) * {SCALE} div (cast(l AS decimal(20, 0)) + r)"))
    scored = cuts.groupBy("lang", "key", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # A phrase in words.
    spelled = scored.select("*", F.posexplode(F.expr("transform(sequence(0, octet_length(key) div 8 - 1), i -> substring(key, 8 * i + 1, 8))")).alias("at", "word_key"))
    spelled = spelled.join(words.select("lang", F.col("key").alias("word_key"), "word"), ["lang", "word_key"])
    spelled = spelled.groupBy("lang", "key", "a", "cut").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("spelled"))
    sums = cut_lineage(counts.where("word IS NULL").select("lang", F.col("f").alias("n")))
    # Joined by shuffle, one language could hold all phrases.
    sums = F.broadcast(sums) if is_small(sums) else sums
    rows = spelled.select("lang", F.array_join("spelled.word", " ").alias("phrase"), "a", "cut.l", "cut.r", "cut.score")
    return rows.join(sums, "lang").select("lang", "phrase", "a", "l", "r", "n", "score")


def best(phrases: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of each language, with their ``rank``: first those of each of ``PIECES`` pieces of it."""
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    pieces = phrases.withColumn("piece", F.pmod(F.xxhash64("phrase"), F.lit(PIECES)))
    pieces = pieces.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "piece").orderBy(*order))).where(F.col("rank") <= top)
    ranked = pieces.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_phrases(spark, sf_dir: str) -> DataFrame:
    """The best phrases of each language of all documents."""
    return best(collocations(table(spark, sf_dir, "documents")))


SQL = rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
split AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM split GROUP BY lang),
grams AS (
    SELECT lang, m, w[i : i + m - 1] AS p FROM (
        SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM split, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(w) >= m)),
freq AS (SELECT lang, m, p, count(*) AS f FROM grams GROUP BY lang, m, p HAVING count(*) >= {LEAST}),
longer AS (
    SELECT lang, p, max(f) AS most FROM (
        SELECT lang, f, p[i : i + k - 1] AS p FROM (
            SELECT lang, p, f, m, k, unnest(range(1, m - k + 2)) AS i FROM freq, (SELECT unnest([2, 3]) AS k) WHERE k < m))
    GROUP BY lang, p),
kept AS (
    SELECT c.lang AS lang, c.p AS p, c.m AS m, c.f AS a FROM freq c LEFT JOIN longer x ON c.lang = x.lang AND c.p = x.p
    WHERE c.m >= 2 AND (x.most IS NULL OR 100::HUGEINT * x.most < {COVER}::HUGEINT * c.f)),
cuts AS (
    SELECT *, p[1 : k] AS first, p[k + 1 : m] AS rest FROM (SELECT *, unnest(range(1, m)) AS k FROM kept)),
scored AS (
    SELECT c.lang AS lang, c.p AS p, c.a AS a, c.k AS k, x.f AS l, y.f AS r, ({SCALE}::HUGEINT * c.a // (x.f + y.f))::BIGINT AS score
    FROM cuts c JOIN freq x ON c.lang = x.lang AND c.first = x.p JOIN freq y ON c.lang = y.lang AND c.rest = y.p),
low AS (SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, k) AS i FROM scored),
ranked AS (
    SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, score,
        row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(p, ' '))) AS rank FROM low WHERE i = 1)
SELECT r.lang AS lang, rank, phrase, a, l, r, n, score FROM ranked r JOIN totals t ON r.lang = t.lang WHERE rank <= {TOP}"""
