"""Language-model scores by deleted interpolation.

A bigram, a unigram and a uniform estimate are mixed with weights that depend on how
often the context was seen, by powers of 2. The weights are learnt by
expectation-maximisation on a part of the training texts that is held out of the
counts for it; then counts are taken of all training texts.

Texts are packed into blocks, and a block asks once for each of its distinct words
and bigrams. Requests meet by ranges of their hash, are summed there over all blocks
of training texts, and the counts go back in the order of the request. So a frequent
word costs a range one row per block, and no task needs the vocabulary.

Tokens are words ``[^\\x20\\x09-\\x0D]+`` with A-Z lowered, then one end, which is also
the context of a first token. Words are held by 64-bit hashes. Null texts are empty
and have the end alone. Rows with a null id are scored, not learnt from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgraph.llm.hashing import U64, blocks, mix, word_hashes
from textgraph.llm.tables import fold, table
from textgraph.scratch import cut_lineage

END = U64(0xE5D)
STEP = U64(0xD1342543DE82EF95)
BLOCK_BYTES = 8 << 20
HASH_BYTES = 2 << 20
CHARS_PER_RANGE = 16 << 20
LEAST_RANGES = 64
CONTEXTS = 24
GRID = 0.25
KEPT, DELETED, UNSEEN = 0, 1, 2


def pressed(a: np.ndarray) -> bytes:
    """Bytes of one place side by side, then zstandard: small numbers take little."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T).tobytes())


def unpressed(data: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    wide = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(wide, -1).T).reshape(-1).view(kind)


def packed(docs: DataFrame) -> DataFrame:
    """``(block, role, ids, starts, data)``: texts of one role each, compressed."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        waiting: dict[int, list[pa.RecordBatch]] = {KEPT: [], DELETED: [], UNSEEN: []}
        size = dict.fromkeys(waiting, 0)
        for small in blocks(batches, HASH_BYTES):
            roles = small.column("role")
            for role in waiting:
                part = small.filter(pc.equal(roles, role))
                if part.num_rows:
                    waiting[role].append(part)
                    size[role] += part.nbytes
                if size[role] >= BLOCK_BYTES:
                    yield row(number, role, waiting[role])
                    number, waiting[role], size[role] = number + 1, [], 0
        for role, parts in waiting.items():
            if parts:
                yield row(number, role, parts)
                number += 1

    def row(number: int, role: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(parts).combine_chunks()
        text = whole.column("text").combine_chunks().cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(text.buffers()[1], np.int64, len(text) + 1, text.offset * 8)
        data = bytes(text.buffers()[2] or b"")[offsets[0] : offsets[-1]]
        ids = whole.column("doc_id").combine_chunks()
        return pa.record_batch(
            [
                pa.array([number], pa.int64()),
                pa.array([role], pa.int32()),
                pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                pa.array([pressed((offsets - offsets[0]).astype(np.int64))]),
                pa.array([zstandard.ZstdCompressor(level=3).compress(data)]),
            ],
            ["block", "role", "ids", "starts", "data"],
        )

    return docs.select("doc_id", "role", "text").mapInArrow(work, f"block bigint, role int, ids array<{id_type}>, starts binary, data binary")


def tokens_of(starts: bytes, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(words, contexts, first)``: the tokens of each text with its end, and what stands before each."""
    offsets = unpressed(starts, np.int64)
    raw = zstandard.ZstdDecompressor().decompress(data, max_output_size=int(offsets[-1]) + 1)
    texts = pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
    parts, sizes, at = [], [], 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + HASH_BYTES, side="right")) - 1)
        words, first = word_hashes(texts.slice(at, to - at))
        parts.append(words)
        sizes.append(np.diff(first))
        at = to
    words, many = np.concatenate(parts), np.concatenate(sizes)
    first = np.concatenate([[0], np.cumsum(many + 1)])
    tokens = np.full(first[-1], END, U64)
    inside = np.ones(first[-1], bool)
    inside[first[1:] - 1] = False
    tokens[inside] = words
    contexts = np.full(first[-1], END, U64)
    contexts[1:] = tokens[:-1]
    return tokens, contexts, first


def keys_of(tokens: np.ndarray, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return tokens, mix(contexts * STEP + tokens)


def range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Rises with the key."""
    return (((keys >> U64(32)) * U64(ranges)) >> U64(32)).astype(np.int64)


def requests(packs: DataFrame, ranges: int) -> DataFrame:
    """``(part, block, role, keys, counts)``: the distinct words (parts from 0) and bigrams (from ``ranges``) of each block."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block, role, starts, data = (batch.column(c)[i].as_py() for c in ("block", "role", "starts", "data"))
                tokens, contexts, _ = tokens_of(starts, data)
                rows = []
                for kind, keys in enumerate(keys_of(tokens, contexts)):
                    keys, counts = np.unique(keys, return_counts=True)
                    counts = counts.astype(np.uint32)
                    edges = np.searchsorted(range_of(keys, ranges), np.arange(ranges + 1))
                    for part, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
                        if b > a:
                            rows.append((kind * ranges + part, block, role, pressed(np.diff(keys[a:b], prepend=U64(0))), pressed(counts[a:b])))
                cols = zip(*rows, strict=True)
                kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
                yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["part", "block", "role", "keys", "counts"])

    return packs.select("block", "role", "starts", "data").mapInArrow(work, "part int, block bigint, role int, keys binary, counts binary")


def answers(asked: DataFrame, ranges: int) -> DataFrame:
    """``(block, part, seen, kept, total, distinct, kept_total, kept_distinct)``: counts in all training texts
    and in those kept, in the order of the request; and, where block is null, the sums of a range of words."""

    def work(group: pa.Table) -> pa.Table:
        part = group.column("part")[0].as_py()
        keys = [np.cumsum(unpressed(x, np.uint64), dtype=U64) for x in group.column("keys").to_pylist()]
        counts = [unpressed(x, np.uint32).astype(np.int64) for x in group.column("counts").to_pylist()]
        role = group.column("role").to_pylist()
        which, back = np.unique(np.concatenate(keys), return_inverse=True)
        ends = np.cumsum([len(k) for k in keys])
        spans = [back[e - len(k) : e] for k, e in zip(keys, ends, strict=True)]
        kept, deleted = np.zeros(len(which), np.int64), np.zeros(len(which), np.int64)
        for r, at, n in zip(role, spans, counts, strict=True):
            if r != UNSEEN:  # keys of one block are distinct
                (kept if r == KEPT else deleted)[at] += n
        seen = kept + deleted
        rows = [(b, part, pressed(seen[at].astype(np.uint64)), pressed(kept[at].astype(np.uint64)), 0, 0, 0, 0) for b, at in zip(group.column("block").to_pylist(), spans, strict=True)]
        if part < ranges:
            rows.append((None, part, b"", b"", int(seen.sum()), int((seen > 0).sum()), int(kept.sum()), int((kept > 0).sum())))
        kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), *[pa.int64()] * 4)
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ANSWER)

    return asked.groupBy("part").applyInArrow(work, "block bigint, part int, seen binary, kept binary, total bigint, distinct bigint, kept_total bigint, kept_distinct bigint")


ANSWER = ["block", "part", "seen", "kept", "total", "distinct", "kept_total", "kept_distinct"]


def counted(pack: pa.Table, answer: pa.Table, ranges: int, column: str) -> tuple[np.ndarray, ...]:
    """Of one block ``(words, contexts, bigrams, first)``: the counts of each token, of what
    stands before it, and of both."""
    tokens, contexts, first = tokens_of(pack.column("starts")[0].as_py(), pack.column("data")[0].as_py())
    parts = answer.column("part").to_numpy()
    order = np.argsort(parts)
    cols = answer.column(column).to_pylist()
    tables = []
    for low, high in ((0, ranges), (ranges, 2 * ranges)):
        found = [unpressed(cols[i], np.uint64) for i in order if low <= parts[i] < high]
        tables.append(np.concatenate(found).astype(np.float64))
    words, bigrams = keys_of(tokens, contexts)
    known, at = np.unique(words, return_inverse=True)
    c_word = tables[0][at]
    c_context = tables[0][np.searchsorted(known, contexts)]
    _, at = np.unique(bigrams, return_inverse=True)
    return c_word, c_context, tables[1][at], first


def context_bucket(count: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(count)[1], CONTEXTS - 1)


def estimates(c_word: np.ndarray, c_context: np.ndarray, c_both: np.ndarray, total: int, distinct: int) -> np.ndarray:
    """The uniform, unigram and bigram estimates of each token."""
    return np.stack([np.full(len(c_word), 1 / (distinct + 1)), c_word / max(total, 1), c_both / np.maximum(c_context, 1)])


def learn(cells: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Mixture weights by context bucket, by expectation-maximisation; ``cells`` has rows of
    (bucket, tokens, uniform, unigram, bigram)."""
    bucket = cells[:, 0].astype(int)
    weights = np.tile(np.array([0.1, 0.5, 0.4]), (CONTEXTS, 1))
    weights[0] = (0.2, 0.8, 0.0)
    seen = np.bincount(bucket, cells[:, 1], CONTEXTS) > 0
    for _ in range(rounds):
        share = weights[bucket] * cells[:, 2:]
        share *= (cells[:, 1] / share.sum(axis=1))[:, None]
        sums = np.stack([np.bincount(bucket, share[:, j], CONTEXTS) for j in range(3)], axis=1) + np.array([0.5, 0.5, 0.0])
        weights[seen] = (sums / sums.sum(axis=1, keepdims=True))[seen]
    return weights


def score_texts(docs: DataFrame, role: Column) -> DataFrame:
    """``(doc_id, n_tokens, n_known, train_tokens, base_score, score)`` of each row.

    ``role`` says of a row whether it is kept for counts, deleted from them while weights
    are learnt, or unseen. Blocks and counts are written as tables when called.
    """
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    ranges = max(LEAST_RANGES, chars // CHARS_PER_RANGE)
    packs = cut_lineage(packed(docs.select("doc_id", role.alias("role"), "text")))
    replies = cut_lineage(answers(requests(packs, ranges), ranges))
    sums = replies.where("block IS NULL").agg(*(F.sum(c).alias(c) for c in ANSWER[4:])).first()
    total, distinct, kept_total, kept_distinct = (int(x or 0) for x in sums)
    back = replies.where("block IS NOT NULL").select("block", "part", "seen", "kept")

    def cells(pack: pa.Table, answer: pa.Table) -> pa.Table:
        c_word, c_context, c_both, _ = counted(pack, answer, ranges, "kept")
        p = estimates(c_word, c_context, c_both, kept_total, kept_distinct)
        bucket = context_bucket(c_context)
        q = np.round(np.log(np.maximum(p[1:], 1e-300) / p[0]) / GRID).clip(-200, 200)
        key = (bucket * 401 + q[0] + 200) * 401 + q[1] + 200
        which, at = np.unique(key.astype(np.int64), return_inverse=True)
        sums = [np.bincount(at, x) for x in (np.ones(len(at)), *p)]
        return pa.table([pa.array(which), *map(pa.array, sums)], ["cell", "n", "p0", "p1", "p2"])

    def both(packs: DataFrame, work, schema: str) -> DataFrame:
        return packs.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(work, schema)

    held = packs.where(F.col("role") == DELETED).select("block", "starts", "data")
    some = held.select("block")
    grid = held.groupBy("block").cogroup(back.join(some, "block", "left_semi").groupBy("block")).applyInArrow(cells, "cell bigint, n double, p0 double, p1 double, p2 double")
    # A cell is a context bucket and two rounded logarithms: their number has a fixed bound.
    found = grid.groupBy("cell").agg(*(F.sum(c).alias(c) for c in ("n", "p0", "p1", "p2"))).toPandas().sort_values("cell").to_numpy()
    if len(found):
        found[:, 2:] /= found[:, 1:2]
        found[:, 0] = found[:, 0] // (401 * 401)
    weights = learn(found.reshape(-1, 5))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def score(pack: pa.Table, answer: pa.Table) -> pa.Table:
        c_word, c_context, c_both, first = counted(pack, answer, ranges, "seen")
        p = estimates(c_word, c_context, c_both, total, distinct)
        mixed = np.log10((weights[context_bucket(c_context)].T * p).sum(axis=0))
        base = np.log10((c_word + 1) / (total + distinct + 1))
        cols = [np.diff(first), np.add.reduceat((c_word > 0).astype(np.int64), first[:-1]), np.full(len(first) - 1, total)]
        sums = [np.add.reduceat(x, first[:-1]) for x in (base, mixed)]
        ids = pack.column("ids").combine_chunks().flatten()
        return pa.table([ids, *(pa.array(x, pa.int64()) for x in cols), *map(pa.array, sums)], ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    schema = f"doc_id {id_type}, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return both(packs.select("block", "ids", "starts", "data"), score, schema)


FOLDS, HELD_OUT_FOLD, DELETED_FOLD = 7, 2, 3


def op5_lm(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents; the model learns from six of seven folds of ids."""
    of = fold("doc_id", FOLDS)
    role = F.when(of == HELD_OUT_FOLD, UNSEEN).when(of == DELETED_FOLD, DELETED).when(of.isNull(), UNSEEN).otherwise(KEPT)
    scored = score_texts(table(spark, sf_dir, "documents"), role)
    held_out = F.coalesce(of == HELD_OUT_FOLD, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score")
