"""Text quality by random-indexing word vectors and a two-layer network.

A token is a run of letters (as written), or a run of other signs that are no spaces.
Each token has a sparse random index vector, which its hash gives, and a word vector:
the sum of the index vectors of the tokens before and after it over all documents,
scaled to length 1. Tokens share ``SLOTS`` vectors by hash, so the table has a fixed
size. A document's features are the mean and the spread of its word vectors, how
alike neighbouring ones are, and its length.

The network is trained in numpy on at most ``SAMPLE_ROWS`` labelled rows, those of
least hash of their id; a fifth of them sets the temperature that its logits are
divided by. Null and empty texts have features of zeros and are scored like others.
Without labels of both kinds every score is the share of ones, or 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgraph.llm.hashing import U64, as_bytes, blocks, mix, runs, span_hashes
from textgraph.llm.tables import BLOCK_BYTES, fold, map_blocks, table

SLOTS, DIMS, SIGNS = 8192, 48, 2
SLICES = 32
SAMPLE_ROWS = 16_000
HIDDEN = 24
CHUNK = 1 << 17
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = _LETTER[65:91] = _LETTER[128:] = True
_SIGN = ~_LETTER
_SIGN[[0x20, 9, 10, 11, 12, 13]] = False


def token_slots(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(slot, first)`` of the tokens of each text, in order."""
    data, starts = as_bytes(texts)
    a, b = (runs(kind[data], starts) for kind in (_LETTER, _SIGN))
    start, end = np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])
    order = np.argsort(start, kind="stable")
    start, end = start[order], end[order]
    return (span_hashes(data, start, end) & U64(SLOTS - 1)).astype(np.int64), np.searchsorted(start, starts)


def index_vectors() -> np.ndarray:
    """The places of the ``SIGNS`` ones and the ``SIGNS`` minus ones of each slot's index vector."""
    h = mix(np.arange(SLOTS, dtype=U64) + U64(77))
    return np.stack([((h >> U64(12 * i)) % U64(DIMS)).astype(np.int64) for i in range(2 * SIGNS)], axis=1)


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The word vector of each slot, from all documents."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = index_vectors()
        sums = np.zeros(SLOTS * DIMS, np.int64)
        for block in blocks(batches, BLOCK_BYTES):
            slot, first = token_slots(block.column("text"))
            near = np.ones(max(len(slot) - 1, 0), bool)
            near[first[1:-1][(first[1:-1] > 0) & (first[1:-1] < len(slot))] - 1] = False
            left, right = slot[:-1][near], slot[1:][near]
            for to, of in ((left, right), (right, left)):
                for i in range(2 * SIGNS):
                    sums += np.bincount(to * DIMS + places[of, i], minlength=SLOTS * DIMS) * (1 if i < SIGNS else -1)
        parts = [x.tobytes() for x in np.split(sums, SLICES)]
        yield pa.record_batch([pa.array(range(SLICES), pa.int32()), pa.array(parts)], ["slice", "sums"])

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_buffer(), np.int64) for x in group.column("sums"))
        return pa.table([group.column("slice").slice(0, 1), pa.array([total.tobytes()])], ["slice", "sums"])

    schema = "slice int, sums binary"
    found = docs.select("text").mapInArrow(work, schema).groupBy("slice").applyInArrow(add, schema).collect()
    sums = np.zeros((SLICES, SLOTS * DIMS // SLICES))
    for row in found:
        sums[row["slice"]] = np.frombuffer(bytes(row["sums"]), np.int64)
    vectors = sums.reshape(SLOTS, DIMS)
    vectors = vectors - vectors.sum(axis=0) / max(1, np.count_nonzero(np.abs(vectors).sum(axis=1)))
    return (vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """The features of each text."""
    slot, first = token_slots(texts)
    n = np.diff(first)
    rows = len(n)
    mean, square, alike = np.zeros((rows, DIMS)), np.zeros((rows, DIMS)), np.zeros(rows)
    row = np.repeat(np.arange(rows), n)
    for a in range(0, len(slot), CHUNK):
        b = min(a + CHUNK, len(slot))
        v = vectors[slot[a:b]]
        here = row[a:b]
        edge = np.flatnonzero(np.diff(here, prepend=-1))
        mean[here[edge]] += np.add.reduceat(v, edge)
        square[here[edge]] += np.add.reduceat(v * v, edge)
        if a:
            v = np.concatenate([vectors[slot[a - 1 : a]], v])
            here = row[a - 1 : b]
        same = here[1:] == here[:-1]
        alike += np.bincount(here[1:][same], (v[1:] * v[:-1]).sum(axis=1)[same], rows)
    size = np.maximum(n, 1)[:, None]
    mean, square = mean / size, square / size
    spread = np.sqrt(np.maximum(square - mean * mean, 0))
    return np.column_stack([mean, spread, alike / np.maximum(n - 1, 1), np.log1p(n)]).astype(np.float32)


@dataclass(frozen=True)
class QualityModel:
    vectors: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    layers: tuple[np.ndarray, ...]
    temperature: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = logits((x - self.centre) / self.scale, self.layers) / self.temperature
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def logits(x: np.ndarray, layers: tuple[np.ndarray, ...]) -> np.ndarray:
    w1, b1, w2, b2 = layers
    return np.tanh(x @ w1 + b1) @ w2 + b2


def train(x: np.ndarray, y: np.ndarray, epochs: int = 30, rate: float = 0.01, decay: float = 1e-3) -> tuple[np.ndarray, ...]:
    """Two layers by Adam on the cross entropy, from a fixed start."""
    rng = np.random.default_rng(5)
    layers = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(())]
    m, v, step = [0.0 * w for w in layers], [0.0 * w for w in layers], 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for a in range(0, len(x), 256):
            at = order[a : a + 256]
            h = np.tanh(x[at] @ layers[0] + layers[1])
            e = (1 / (1 + np.exp(-(h @ layers[2] + layers[3]))) - y[at]) / len(at)
            back = e[:, None] * layers[2] * (1 - h * h)
            grads = [x[at].T @ back + decay * layers[0], back.sum(axis=0), h.T @ e + decay * layers[2], e.sum()]
            step += 1
            for i, g in enumerate(grads):
                m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.999 * v[i] + 0.001 * g * g
                layers[i] = layers[i] - rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    return tuple(layers)


def fit(docs: DataFrame, labels: DataFrame, train_rows: Column, rows: int = SAMPLE_ROWS) -> QualityModel:
    """Word vectors of all of ``docs``, and a network for the labelled rows that ``train_rows`` keeps."""
    vectors = word_vectors(docs)
    marked = labels.where(F.col("quality").isin(0, 1) & F.coalesce(train_rows, F.lit(False)))
    marked = marked.groupBy("doc_id").agg(F.max("quality").cast("int").alias("label"))
    some = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    sample = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").select("text", "label")

    def features(block: pa.RecordBatch) -> pa.RecordBatch:
        x = pooled(block.column("text"), vectors)
        return pa.record_batch([block.column("label"), pa.array([r.tobytes() for r in x], pa.binary())], ["label", "x"])

    found = map_blocks(sample, features, "label int, x binary").toPandas()
    width = 2 * DIMS + 2
    x = np.frombuffer(b"".join(bytes(b) for b in found["x"]), np.float32).reshape(-1, width).astype(float)
    y = found["label"].to_numpy(float)
    # Rows come in any order; the fit must not depend on it.
    order = np.lexsort((*x.T[:4], y))
    x, y = x[order], y[order]
    if len(set(y)) < 2:
        share = np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99)
        none = (np.zeros((width, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), np.array(np.log(share / (1 - share))))
        return QualityModel(vectors, np.zeros(width), np.ones(width), none, 1.0)
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = (x - centre) / scale
    kept = np.arange(len(y)) % 5 != 0
    layers = train(z[kept], y[kept])
    raw = logits(z[~kept], layers)
    temperatures = np.exp(np.linspace(-1.5, 2, 60))
    loss = [np.logaddexp(0, np.where(y[~kept] == 1, -raw, raw) / t).mean() for t in temperatures]
    return QualityModel(vectors, centre, scale, layers, float(temperatures[int(np.argmin(loss))]))


def score_rows(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``(doc_id, score)``."""

    def work(block: pa.RecordBatch) -> pa.RecordBatch:
        p = model.probability(pooled(block.column("text"), model.vectors))
        return pa.record_batch([block.column("doc_id"), pa.array(p, pa.float64())], ["doc_id", "score"])

    return map_blocks(docs.select("doc_id", "text"), work, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


FOLDS, HELD_OUT_FOLD, THRESHOLD = 5, 0, 0.3


def op6_quality(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents; labels are learnt from four of five folds of ids."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = score_rows(docs, fit(docs, labels, fold("doc_id", FOLDS) != HELD_OUT_FOLD))
    held_out = F.coalesce(fold("doc_id", FOLDS) == HELD_OUT_FOLD, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held_out, "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
