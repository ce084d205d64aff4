"""Byte-level BPE: encoding by ranked merges, and decoding.

A text is split by the tokenizer's pattern, and each piece is encoded by itself. The words
that the most blocks of the table share, ``SHARED`` at most, are encoded once for all
blocks and broadcast. Blocks of texts become one row each: their other distinct pieces ("words"),
and the pieces of each text as numbers of words. Spark's higher-order functions encode the words:
a fold over its bytes that merges, round by round, the adjacent pair of least rank,
looked up in a map of ranks. Decoding joins the bytes of the tokens' pieces, from an
array. Last, a block's rows are laid out again as one row per text.

The map of ranks is an array with two places for each pair of tokens, as a lookup in a
map column is a scan. Pieces stand as Latin-1 characters, one for each byte. These tables
are scalar subqueries over one row: as literals they would be in each description of a plan,
of which the driver keeps many. A word of more than ``LONG`` bytes merges all pairs of the least rank in one
round, leftmost first, so it takes as many rounds as there are distinct merges.

The shared words only save work: a word of a block that is not among them is encoded there by
the same columns, so results do not depend on which are shared.

Defined results: null and empty texts have no tokens; no special tokens are made; null, tied and
repeated ids are carried along; other columns take no part; an empty table has no rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textgraph.llm.hashing import as_bytes, blocks, give_back
from textgraph.llm.tables import map_blocks, table
from textgraph.scratch import cut_lineage

# Odd numbers, each about as large as half the table of pairs.
MODULI = (129_949, 134_857)
# Short words have places of six bits.
LONG = 64
# An entry of a short word: the bits of its id, of its place, and the rank of a pair that has none.
ID, PLACE, NONE = 0x1FFFF, 0x3F << 17, 0x1FFFF << 23
BLOCK_BYTES = 8 << 20
# Pieces of so many segments are Python strings at once, and texts of so many pieces go out together.
SEGMENTS, PIECES = 10_000, 1 << 18
# The pattern whose matches are cut apart by ``segments``, and the bytes behind a space that it cuts before:
# the first ones of code points below U+0800 that are no white space.
SPACED = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LETTERS = "^ ?[A-Za-zà-öø-ÿ]+$"
_BEGINS = np.zeros(256, bool)
_BEGINS[0x21:0x7F] = _BEGINS[0xC3:0xE0] = True
# At some 40 bytes a word with its ids, at most 16 MB.
SHARED = 400_000
SHARED_BYTES = 40
WORDS_PER_ROW = 5000


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a tiktoken file."""
    lines = Path(path).read_bytes().splitlines()
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line)}


def pair_table(ranks: dict[bytes, int]) -> np.ndarray:
    """The map from pairs of tokens to the rank of both together, as slots that hold ``pair << 17 | rank``.

    A pair lies at its remainder by the first or by the second of ``MODULI``, the second
    behind the first: to enter one, whatever holds its slot moves to its other slot.
    """
    slots = [-1] * sum(MODULI)
    for piece, rank in ranks.items():
        for i in range(1, len(piece)):
            left, right = ranks.get(piece[:i]), ranks.get(piece[i:])
            if left is None or right is None:
                continue
            entry, side = (left << 16 | right) << 17 | rank, 0
            for _ in range(500):
                at = (entry >> 17) % MODULI[side] + side * MODULI[0]
                entry, slots[at] = slots[at], entry
                if entry < 0:
                    break
                side = 1 - side
            else:
                raise ValueError("the table of pairs is too full")
    return np.array(slots, np.int64)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array_repeat(value, 1), body), F.lit(0))


class Codec:
    """Columns that encode and decode words by one table of ranks; ids are ranks, below 65536."""

    def __init__(self, ranks: dict[bytes, int]):
        if max(ranks.values()) >= 1 << 16 or any(bytes([i]) not in ranks for i in range(256)):
            raise ValueError("ids must be below 65536 and every byte must have one")
        by_id = [""] * (max(ranks.values()) + 1)
        for piece, rank in ranks.items():
            by_id[rank] = piece.decode("latin-1")
        both = [ranks.get(bytes([i, j])) for i in range(256) for j in range(256)]
        self.tables = {
            "slots": pa.array(pair_table(ranks)),
            "bytes": pa.array([ranks[bytes([i])] for i in range(256)], pa.int64()),
            "pairs": pa.array([NONE if r is None else r << 23 for r in both], pa.int64()),
            "pieces": pa.array(by_id, pa.string()),
        }

    def code(self, rows: DataFrame, *keep: str) -> DataFrame:
        """``(*keep, token_ids, decoded)`` of rows with lists of ``words``, each an array of its bytes."""
        row = rows.sparkSession.createDataFrame(pa.table({name: one_list(values) for name, values in self.tables.items()}))
        # Spark takes no subquery in a higher-order function, but one in a column that is read once it puts there itself.
        merges, pieces = ([row.select(name).scalar().alias(name) for name in names] for names in (("slots", "bytes", "pairs"), ("pieces",)))
        coded = rows.select(*keep, "words", *merges).select(*keep, self.encode_words(F.col("words")).alias("token_ids"))
        return coded.select(*keep, "token_ids", *pieces).select(*keep, "token_ids", self.decode_words(F.col("token_ids")).alias("decoded"))

    # ``t`` below is one struct of the tables, or the table of pieces.

    def encode_words(self, words: Column) -> Column:
        """The token ids of words, each an array of its bytes."""
        return let(F.struct("slots", "bytes", "pairs"), lambda t: F.transform(words, lambda w: self.encode(w, t)))

    def decode_words(self, words: Column) -> Column:
        """The bytes of words of token ids."""
        return let(F.col("pieces"), lambda t: F.transform(words, lambda ids: F.encode(self.decode(ids, t), "ISO-8859-1")))

    def rank(self, left: Column, right: Column, t: Column) -> Column:
        """The rank of two parts together; null where there is none, or one part is null."""
        first, second = (F.lit(p).cast("bigint") for p in MODULI)

        pair = F.shiftleft(left, 16) + right
        a, b = F.get(t["slots"], pair % first), F.get(t["slots"], pair % second + first)
        return F.when(F.shiftright(a, 17) == pair, a).when(F.shiftright(b, 17) == pair, b).bitwiseAND(F.lit(ID))

    def ranks(self, parts: Column, t: Column) -> Column:
        """For each part, the rank of it and the next together; null where there is none."""
        return F.transform(parts, lambda part, i: self.rank(part, F.get(parts, i + 1), t))

    def entries(self, word: Column, t: Column) -> Column:
        """Each byte as an entry ``rank << 23 | place << 17 | id``, with the rank of it and the next together.

        Entries of one word differ, and the least is the leftmost of those with the least rank.
        """

        def entry(b: Column, i: Column) -> Column:
            rank = F.coalesce(F.get(t["pairs"], b * 256 + F.get(word, i + 1)), F.lit(NONE))
            return rank + F.shiftleft(i, 17) + F.get(t["bytes"], b)

        return F.transform(word, entry)

    def merge_first(self, entries: Column, t: Column) -> Column:
        """Entries with the leftmost pair of least rank merged; only the ranks beside it are looked up."""

        def part(i: Column) -> Column:
            return F.get(entries, i).bitwiseAND(F.lit(ID))

        def ranked(rank: Column) -> Column:
            return F.coalesce(F.shiftleft(rank, 23), F.lit(NONE))

        def merged(at: Column, least: Column) -> Column:
            # ``at`` is the place of the right part of the pair; its rank is the id of both together.
            whole = F.shiftright(least, 23)

            def kept(x: Column, i: Column) -> Column:
                both = ranked(self.rank(whole, part(at + 1), t)) + least.bitwiseAND(F.lit(PLACE)) + whole
                before = ranked(self.rank(x.bitwiseAND(F.lit(ID)), whole, t)) + x.bitwiseAND(F.lit(PLACE | ID))
                beside = F.when(i == at - 1, both).when(i == at - 2, before)
                return F.when((i > at) | (i < at - 2), x).otherwise(beside)

            return F.filter(F.transform(entries, kept), lambda x: x.isNotNull())

        def step(least: Column) -> Column:
            at = F.array_position(entries, least).cast("int")
            return F.when(least >= NONE, entries).otherwise(let(at, lambda i: merged(i, least)))

        return let(F.array_min(entries), step)

    def merge_all(self, state: Column, t: Column) -> Column:
        """One round on ``(parts, done)``: every pair of least rank is merged, of overlapping ones the leftmost."""
        parts = state["parts"]

        def merged(r: Column, least: Column) -> Column:
            flags = F.array_join(F.transform(r, lambda x: F.when(x == least, "1").otherwise("0")), "")
            return let(F.split(F.regexp_replace(flags, "11", "10"), ""), lambda flag: chosen(flag, least))

        def chosen(flag: Column, least: Column) -> Column:
            def part(p: Column, i: Column) -> Column:
                before = F.coalesce(F.get(flag, i - 1) == "1", F.lit(False))
                return F.when(before, F.lit(None).cast("bigint")).when(F.get(flag, i) == "1", least).otherwise(p)

            return F.filter(F.transform(parts, part), lambda p: p.isNotNull())

        def step(r: Column, least: Column) -> Column:
            return F.struct(F.when(least.isNull(), parts).otherwise(merged(r, least)).alias("parts"), least.isNull().alias("done"))

        done = F.struct(parts.alias("parts"), F.lit(True).alias("done"))
        return F.when(state["done"], done).otherwise(let(self.ranks(parts, t), lambda r: let(F.array_min(r), lambda least: step(r, least))))

    def encode(self, word: Column, t: Column) -> Column:
        """The token ids of a word, given as an array of its bytes."""
        start = F.transform(word, lambda b: F.get(t["bytes"], b))
        rounds = F.sequence(F.lit(2), F.size(word))
        ids = lambda entries: F.transform(entries, lambda x: x.bitwiseAND(F.lit(ID)))
        short = F.aggregate(rounds, self.entries(word, t), lambda e, _: self.merge_first(e, t), ids)
        state = F.struct(start.alias("parts"), F.lit(False).alias("done"))
        long = F.aggregate(rounds, state, lambda s, _: self.merge_all(s, t), lambda s: s["parts"])
        return F.when(F.size(word) < 2, start).when(F.size(word) > LONG, long).otherwise(short).cast("array<int>")

    def decode(self, ids: Column, t: Column) -> Column:
        """The bytes of token ids, as Latin-1 characters."""
        return F.array_join(F.transform(ids, lambda i: F.get(t, i)), "")


BLOCK = "ids array<{id}>, sizes binary, codes binary, words array<array<int>>"


def byte_lists(words: pa.Array) -> pa.ListArray:
    """Each word as a list of its bytes."""
    data, at = as_bytes(words)
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(data.astype(np.int32)))


def one_list(values: pa.Array) -> pa.ListArray:
    """All values as the list of one row."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def common_words(docs: DataFrame, most: int = SHARED, size: int = BLOCK_BYTES) -> DataFrame:
    """``(word)``: words of letters after a space that more than one block holds, those of the most blocks; at most ``most``."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        import pyarrow.compute as pc

        texts = pc.fill_null(batch.column("text").cast(pa.large_string()), "")
        runs = pc.split_pattern(texts, " ").flatten().dictionary_encode().dictionary
        fit = pc.and_(pc.match_substring_regex(runs, "^[A-Za-zà-öø-ÿ]+$"), pc.less_equal(pc.binary_length(runs), SHARED_BYTES))
        return pa.record_batch([runs.filter(fit).cast(pa.string())], ["word"])

    held = cut_lineage(map_blocks(docs.select("text"), work, "word string", size).groupBy("word").agg(F.count("*").alias("blocks")).where("blocks > 1"))
    # No more rows than a word has numbers of blocks; only the bar comes to the driver.
    tally = held.groupBy("blocks").agg(F.count("*").alias("n"))
    above = F.sum("n").over(Window.orderBy(F.desc("blocks")))
    bar = tally.withColumn("above", above).where(F.col("above") <= most).agg(F.min("blocks")).first()[0]
    return held.where(F.col("blocks") >= F.lit(bar)).select(F.concat(F.lit(" "), "word").alias("word"))


@dataclass(frozen=True)
class Words:
    """Encoded words: their texts, the token ids of all end to end, and the bytes that these decode to."""

    texts: pa.Array
    offsets: np.ndarray
    ids: np.ndarray
    starts: np.ndarray
    data: np.ndarray


def coded_words(lists: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(offsets, ids, starts, data)`` of words given as lists of ids and as bytes."""
    offsets = lists.offsets.to_numpy().astype(np.int32)
    ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
    starts = np.zeros(1, np.int32)
    if len(texts):
        starts = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[starts[0] : starts[-1]]
    return offsets - offsets[0], ids, starts - starts[0], data


def encode_shared(words: DataFrame, codec: Codec) -> Words:
    """The common words, encoded by rows of ``WORDS_PER_ROW`` and brought to the driver."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, WORDS_PER_ROW):
                some = batch.column("word").slice(i, WORDS_PER_ROW)
                yield pa.record_batch([one_list(some), one_list(byte_lists(some))], ["texts", "words"])

    rows = words.mapInArrow(work, "texts array<string>, words array<array<int>>")
    got = codec.code(rows, "texts").toArrow().combine_chunks()
    if not got.num_rows:
        none, start = np.zeros(0, np.int32), np.zeros(1, np.int32)
        return Words(pa.array([], pa.string()), start, none, start, none.astype(np.uint8))
    texts, lists, data = (got.column(c).combine_chunks().flatten() for c in ("texts", "token_ids", "decoded"))
    return Words(texts, *coded_words(lists, data))


def segments(data: np.ndarray, starts: np.ndarray, spaced: bool) -> tuple[np.ndarray, np.ndarray]:
    """``(at, first)``: where the segments of all texts start, and the end; text i has those from ``first[i]`` to ``first[i + 1]``.

    A text is one segment, or if ``spaced`` cut before each space that something else than white space follows. ``SPACED`` matches
    in segments what it matches in the text: it begins a match at such a space, which is no end of ``\\s+(?!\\S)``, and looks no further back.
    """
    cut = np.zeros(len(data), bool)
    full = np.diff(starts) > 0
    if spaced:
        cut[:-1] = (data[:-1] == 0x20) & _BEGINS[data[1:]]
        cut[starts[1:][full] - 1] = False
    cut[starts[:-1][full]] = True
    at = np.flatnonzero(cut)
    return np.append(at, len(data)), np.searchsorted(at, starts)


def split_pieces(texts: pa.Array, split, spaced: bool) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """``(sizes, codes, words)``: pieces of each text, the word that each piece is, and the distinct words.

    The pattern is matched once in each distinct segment of the texts.
    """
    import pyarrow.compute as pc

    data, starts = as_bytes(texts)
    at, first = segments(data, starts, spaced)
    coded = pa.Array.from_buffers(pa.string(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data)]).dictionary_encode()
    # Most segments are a word of letters, which is a piece by itself; they go before the others.
    whole = pc.match_substring_regex(coded.dictionary, LETTERS) if spaced else pa.repeat(False, len(coded.dictionary))
    rest = coded.dictionary.filter(pc.invert(whole))
    chunks = [coded.dictionary.filter(whole)]
    counts = [np.zeros(1, np.int64), np.ones(len(chunks[0]), np.int64)]
    for i in range(0, len(rest), SEGMENTS):
        found = [split.findall(x) for x in rest.slice(i, SEGMENTS).to_pylist()]
        counts.append(np.array([len(x) for x in found], np.int64))
        chunks.append(pa.array([p for x in found for p in x], pa.string()))
    pieces = pa.chunked_array(chunks, pa.string()).combine_chunks().dictionary_encode()
    whole = whole.to_numpy(zero_copy_only=False)
    place = np.where(whole, np.cumsum(whole), len(chunks[0]) + np.cumsum(~whole)) - 1
    codes, each = take_lists(np.cumsum(np.concatenate(counts)), pieces.indices.to_numpy(), place[coded.indices.to_numpy()])
    ends = np.concatenate([[0], np.cumsum(each, dtype=np.int64)])
    return np.diff(ends[first]).astype(np.int32), codes, pieces.dictionary


def pack(docs: DataFrame, pattern: str, shared, size: int = BLOCK_BYTES) -> DataFrame:
    """A row per block of texts: ids, pieces of each text, codes of all pieces, distinct words.

    Codes below the number of ``shared`` words (a broadcast) are theirs, and those from there on the block's own.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc
        import regex

        split = regex.compile(pattern)
        known = shared.value.texts
        for block in blocks(batches, size):
            sizes, codes, words = split_pieces(block.column("text"), split, pattern == SPACED)
            at = pc.index_in(words, value_set=known)
            own = pc.is_null(at)
            number = pc.fill_null(at, 0).to_numpy() + np.where(own, len(known) - 1 + np.cumsum(own), 0)
            codes = number.astype(np.int32)[codes]
            words = one_list(byte_lists(words.filter(own)))
            yield pa.record_batch([one_list(block.column("doc_id")), pa.array([sizes.tobytes()]), pa.array([codes.tobytes()]), words], ["ids", "sizes", "codes", "words"])
            del block, sizes, codes, words, at, own, number
            give_back()

    return docs.select("doc_id", "text").mapInArrow(work, BLOCK.format(id=id_type))


def take_lists(offsets: np.ndarray, values: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists that ``codes`` name, end to end, and the length of each."""
    sizes = np.diff(offsets)[codes]
    ends = np.cumsum(sizes, dtype=np.int64)
    at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(offsets[:-1][codes] - (ends - sizes), sizes)
    return values[at], sizes


def unpack(packed: DataFrame, shared) -> DataFrame:
    """``(doc_id, tokens, decoded)`` of blocks with ``token_ids`` and ``decoded`` of each word."""
    id_type = packed.schema["ids"].dataType.elementType.simpleString()

    def totals(sizes: np.ndarray, each: np.ndarray) -> np.ndarray:
        running = np.concatenate([[0], np.cumsum(each)])
        return running[np.concatenate([[0], np.cumsum(sizes)])]

    def behind(first: np.ndarray, then: np.ndarray) -> np.ndarray:
        return np.concatenate([first, then[1:] + first[-1]])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                ids = batch.column("ids")[i].values
                sizes = np.frombuffer(batch.column("sizes")[i].as_py(), np.int32)
                codes = np.frombuffer(batch.column("codes")[i].as_py(), np.int32)
                offsets, tokens, starts, data = coded_words(batch.column("token_ids")[i].values, batch.column("decoded")[i].values)
                offsets, tokens = behind(known.offsets, offsets), np.concatenate([known.ids, tokens])
                starts, data = behind(known.starts, starts), np.concatenate([known.data, data])
                # Texts go out in parts, as a block's bytes are many.
                ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
                a = 0
                while a < len(sizes):
                    b = max(a + 1, int(np.searchsorted(ends, ends[a] + PIECES, side="right")) - 1)
                    some = codes[ends[a] : ends[b]]
                    of, each = take_lists(offsets, tokens, some)
                    raw, wide = take_lists(starts, data, some)
                    tokens_at, bytes_at = totals(sizes[a:b], each), totals(sizes[a:b], wide)
                    of_tokens = pa.ListArray.from_arrays(pa.array(tokens_at, pa.int32()), pa.array(of, pa.int32()))
                    of_bytes = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(bytes_at.astype(np.int32)), pa.py_buffer(raw)])
                    yield pa.record_batch([ids.slice(a, b - a), of_tokens, of_bytes], ["doc_id", "tokens", "decoded"])
                    a = b
                del ids, sizes, codes, offsets, tokens, starts, data, ends, some, of, each, raw, wide, of_tokens, of_bytes
                give_back()

    return packed.mapInArrow(work, f"doc_id {id_type}, tokens array<int>, decoded binary")


def encode_decode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, most: int = SHARED, size: int = BLOCK_BYTES) -> DataFrame:
    """``(doc_id, tokens, decoded)``: the token ids of each text, and the bytes that they decode to.

    Reads the texts twice: for the words that blocks share, which are then encoded, and to encode.
    """
    codec = Codec(ranks)
    context = docs.sparkSession.sparkContext
    # At most ``most`` words of SHARED_BYTES and their ids.
    shared = context.broadcast(encode_shared(common_words(docs, most, size), codec))
    words = pack(docs, pattern, shared, size)
    # The driver's Python stays too.
    give_back()
    return unpack(codec.code(words, "ids", "sizes", "codes"), shared)


def digests(coded: DataFrame) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``."""
    line = F.concat_ws(" ", F.col("tokens").cast("array<string>"))
    return coded.select(
        "doc_id",
        F.size("tokens").cast("bigint").alias("n_tokens"),
        F.sha2(line.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def encode_documents(spark, docs: DataFrame, sf_dir: str, vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """Digests of the tokens of all texts, by a public vocabulary."""
    import public_tokenizers

    return digests(encode_decode(docs, read_ranks(public_tokenizers.path(vocabulary)), public_tokenizers.PATTERN))


def op2_bpe(spark, sf_dir: str) -> DataFrame:
    """Tokens of all documents, and what they decode to."""
    return encode_documents(spark, table(spark, sf_dir, "documents"), sf_dir)
