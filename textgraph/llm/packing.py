"""Packing token streams into windows by order-preserving dynamic programming.

The documents of a task stand end to end in their order, each its tokens and an end id.
Windows of at most ``WINDOW`` tokens cover this stream; a window is padded to full length,
unless its length is a power of two. It may be cut after a document for nothing, after a
sentence for ``SENTENCE`` and at other tokens for ``ANYWHERE``, penalties in padded tokens;
the latter only where no other cut is near, or at the end of a task. Of all ways to cut, dynamic programming
takes the cheapest: the best cost up to a cut is the least ``cost + place`` among the
cuts one window back, which a monotone queue holds ready, or that of a cut a power of two back.

A task packs block after block. What the cheapest way puts into its last ``HORIZON`` tokens is
not settled yet and starts the next block, so memory is bounded by a block and its longest
text. There is no shuffle: a task only packs its own rows, in their order.

Tokens: the tokenizer's pieces never reach over a space or a line end, so each distinct run
between them is encoded once while it is remembered, of at most ``REMEMBERED`` runs.

Defined results: null and empty texts are the end id alone; null, repeated and tied ids are
carried along; other columns take no part; an empty table has no pieces. A sequence is named
by its task and its number there.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from textgraph.llm.hashing import blocks
from textgraph.llm.tables import table

WINDOW = 2048
END = 1
SENTENCE = 4
ANYWHERE = 32
# Without a cut among so many tokens, there is one after each of so many.
BARE, EVERY = 64, 32
HORIZON = 8 * WINDOW
BLOCK_BYTES = 6 << 20
REMEMBERED = 800_000
TASK_BITS = 36
# Small letters, of which any number together are one word to the tokenizer.
LETTER = "[a-zà-öø-ÿ]"
CLOSING = r"[.!?…。！？][)\]\"'»”’]*\n?$|\n$"


class Runs:
    """Token ids of runs of text without space or line end."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.ids = np.zeros(0, np.uint32)
        self.first = np.zeros(1, np.int64)
        self.closes = np.zeros(0, bool)

    def encode(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of ``runs`` end to end, and how many each has."""
        each = [e.ids for e in self.tokenizer.encode_batch_fast(runs, add_special_tokens=False)]
        sizes = np.fromiter(map(len, each), np.int64, len(each))
        return np.fromiter((i for x in each for i in x), np.uint32, int(sizes.sum())), sizes

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode``, for words of letters: many go in one text, as a token that ends a word tells them apart."""
        ids, _ = self.encode([" ".join(words[i : i + 256]) for i in range(0, len(words), 256)])
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        return ids, np.diff(ends, prepend=0)

    def add(self, runs: pa.Array) -> None:
        words = pc.match_substring_regex(runs, f"^{LETTER}+$")
        for kind, encode in ((words, self.encode_words), (pc.invert(words), self.encode)):
            given = runs.filter(kind)
            ids, sizes = encode(given.to_pylist())
            self.known = pa.concat_arrays([self.known, given])
            self.ids = np.concatenate([self.ids, ids])
            self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(sizes)])
            closing = pc.match_substring_regex(given, CLOSING)
            self.closes = np.concatenate([self.closes, closing.to_numpy(zero_copy_only=False)])

    def places(self, runs: pa.Array) -> np.ndarray:
        """Where each of the distinct ``runs`` is kept."""
        if len(self.known) + len(runs) > REMEMBERED:
            self.forget()
        new = runs.filter(pc.is_null(pc.index_in(runs, value_set=self.known)))
        if len(new):
            self.add(new)
        return pc.index_in(runs, value_set=self.known).to_numpy()


@cache
def runs_of(path: str) -> Runs:
    return Runs(path)


def take_ranges(values: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``values[first[i] : first[i] + sizes[i]]`` for all i, end to end."""
    ends = np.cumsum(sizes)
    return values[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first - (ends - sizes), sizes)]


def encoded(texts: pa.Array, runs: Runs, end: int = END) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(ids, sizes, sentences)``: the tokens of all texts, each with its end id, how many each
    text has, and the places in ``ids`` after a sentence."""
    lines = pc.fill_null(texts.cast(pa.large_string()), "")
    if not pc.any(pc.match_substring(lines, "<|")).as_py():
        # The tokenizer lowers letters itself, but for its special tokens, and always cuts between a letter and a stop.
        # Lowered last, on a fresh array: the kernel reads a slice's offsets as if they started at 0.
        lines = pc.ascii_lower(pc.replace_substring_regex(lines, f"([A-Z]|{LETTER})([.,;:!?])", r"\1 \2"))
    # A line end stays with the run before it, where it closes a sentence.
    split = pc.split_pattern(pc.replace_substring(lines, "\n", "\n "), " ")
    coded = split.flatten().dictionary_encode()
    at = runs.places(coded.dictionary)[coded.indices.to_numpy()]
    many = np.diff(split.offsets.to_numpy())
    texts_of = np.repeat(np.arange(len(many)), many)
    # The end id is a run of its own.
    sizes = (runs.first[1:] - runs.first[:-1])[at]
    sums = np.concatenate([[0], np.cumsum(sizes)])
    bounds = np.concatenate([[0], np.cumsum(many)])
    per_text = sums[bounds[1:]] - sums[bounds[:-1]] + 1
    body = take_ranges(runs.ids, runs.first[:-1][at], sizes)
    ids = np.insert(body, sums[bounds[1:]], np.uint32(end)) if len(many) else body
    closing = runs.closes[at] & (sizes > 0)
    return ids, per_text, np.unique((sums[1:] + texts_of)[closing])


def cuts_of(total: int, documents: np.ndarray, sentences: np.ndarray, last: bool, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Places where a stream of ``total`` tokens may be cut, from 0 to ``total``, and their penalties."""
    known = np.unique(np.concatenate([[0, total], documents, sentences]))
    gap = np.diff(known)
    bare = np.flatnonzero(gap > min(BARE, window))
    step = min(EVERY, window)
    many = (gap[bare] - 1) // step
    extra = np.repeat(known[bare], many) + step * (np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many) + 1)
    if last:
        extra = np.concatenate([extra, np.arange(max(0, total - 2 * window), total)])
    places = np.unique(np.concatenate([known, extra])).astype(np.int64)
    penalty = np.full(len(places), ANYWHERE, np.int64)
    penalty[np.searchsorted(places, sentences)] = SENTENCE
    penalty[np.searchsorted(places, documents)] = 0
    penalty[[0, -1]] = 0
    return places, penalty


def cheapest(places: np.ndarray, penalty: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """The places of the cheapest way to cut, the first and the last included."""
    n = len(places)
    if n < 2:
        return places
    # The cuts that lie a power of two before another.
    index = np.full(int(places[-1]) + 1, -1, np.int32)
    index[places] = np.arange(n)
    later, earlier = [], []
    power = 1 << (window.bit_length() - 1)
    while power:
        from_ = np.flatnonzero(places >= power)
        to = index[places[from_] - power]
        later.append(from_[to >= 0])
        earlier.append(to[to >= 0])
        power >>= 1
    j_of = np.concatenate(later)
    order = np.argsort(j_of, kind="stable")
    first = np.searchsorted(j_of[order], np.arange(n + 1)).tolist()
    exact = np.concatenate(earlier)[order].tolist()
    place, fee = places.tolist(), penalty.tolist()
    cost, back, key = [0] * n, [0] * n, [0] * n
    key[0] = place[0]
    queue, head = [0], 0
    for j in range(1, n):
        here = place[j]
        least = here - window
        while place[queue[head]] < least:
            head += 1
        best = queue[head]
        c = key[best] - least
        for i in exact[first[j] : first[j + 1]]:
            if cost[i] < c:
                c, best = cost[i], i
        c += fee[j]
        cost[j], back[j] = c, best
        key[j] = k = c + here
        while len(queue) > head and key[queue[-1]] >= k:
            queue.pop()
        queue.append(j)
    way = [n - 1]
    while way[-1]:
        way.append(back[way[-1]])
    return places[way[::-1]]


PIECES = "doc_id {id}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


class Stream:
    """The documents of a task that are not laid out yet."""

    def __init__(self, task: int, window: int, end: int):
        self.window, self.end, self.next = window, end, task << TASK_BITS
        self.ids = np.zeros(0, np.uint32)
        self.sentences = np.zeros(0, np.int64)
        # By document: the row's id, all its tokens, and those laid out before.
        self.docs: pa.Array | None = None
        self.tokens = self.before = self.sizes = np.zeros(0, np.int64)

    def add(self, docs: pa.Array, ids: np.ndarray, sizes: np.ndarray, sentences: np.ndarray) -> None:
        self.sentences = np.concatenate([self.sentences, sentences + len(self.ids)])
        self.ids = np.concatenate([self.ids, ids])
        self.docs = docs if self.docs is None else pa.concat_arrays([self.docs, docs])
        self.tokens = np.concatenate([self.tokens, sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.before = np.concatenate([self.before, np.zeros(len(sizes), np.int64)])

    def pieces(self, last: bool) -> pa.RecordBatch | None:
        """Windows that are settled, as pieces; all of them when no more documents come."""
        total = len(self.ids)
        if not total:
            return None
        ends = np.cumsum(self.sizes)
        places, penalty = cuts_of(total, ends, self.sentences, last, self.window)
        way = cheapest(places, penalty, self.window)
        if not last:
            way = way[way <= max(0, total - HORIZON)]
        if len(way) < 2:
            return None
        settled = int(way[-1])
        starts = ends - self.sizes
        at = np.union1d(way[:-1], starts[starts < settled])
        to = np.append(at[1:], settled)
        doc = np.searchsorted(ends, at, side="right")
        sequence = np.searchsorted(way, at, side="right") - 1
        data = memoryview(self.ids.astype("<u4").tobytes())
        crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(at.tolist(), to.tolist(), strict=True)]
        cols = [
            self.docs.take(pa.array(doc)), at - starts[doc] + self.before[doc], to - at, np.array(crc, np.int64),
            self.tokens[doc], self.next + sequence, at - way[sequence],
        ]
        self.next += len(way) - 1
        # The rest of a document that is cut here keeps its place in it.
        left = int(np.searchsorted(ends, settled, side="right"))
        cut = max(0, settled - int(starts[left])) if left < len(ends) else 0
        self.docs, self.tokens, self.sizes, self.before = self.docs.slice(left), self.tokens[left:], self.sizes[left:].copy(), self.before[left:].copy()
        if cut:
            self.sizes[0] -= cut
            self.before[0] += cut
        self.ids = self.ids[settled:]
        self.sentences = self.sentences[self.sentences > settled] - settled
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        return pa.record_batch([c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in cols], names)


def pack(docs: DataFrame, path: str, window: int = WINDOW, end: int = END, size: int = BLOCK_BYTES) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``: a row for each piece of a document.

    ``path`` is a file of the tokenizers library that every worker has; its tokens must not reach over spaces.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = runs_of(path)
        stream = Stream(TaskContext.get().partitionId(), window, end)
        for block in blocks(batches, size):
            stream.add(block.column("doc_id"), *encoded(block.column("text"), runs, end))
            if (out := stream.pieces(False)) is not None:
                yield out
        if (out := stream.pieces(True)) is not None:
            yield out

    return docs.select("doc_id", "text").mapInArrow(work, PIECES.format(id=id_type))


def op12_packing(spark, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
