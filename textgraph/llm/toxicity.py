"""Toxic passages by maximum-scoring segments.

Tokens are runs of letters, lowered. A token scores the log-odds of its rate in
toxic against clean training texts under a Dirichlet prior. The prior of a token
is centred on the odds of its first ``PREFIXES`` bytes, so an inflection that
training has not seen scores as its stem. In toxic texts a token counts once for
each token before it, so copies of one text count once.

Odds below ``LEAST_ODDS``, and negative ones, count as unknown.

A linear scan (Ruzzo and Tompa) finds every maximal segment of a text. Its score
S is held against the extreme-value law of chance segments of clean texts, by
which ``lambda * S - ln(K n)`` is how far it stands out; a text's evidence is the
sum over its segments that do, and a logistic curve makes a probability of it.

Null and empty texts have no segment and score as texts without evidence. A
null id takes part in scoring; without labels of both kinds every score is 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgraph.llm.hashing import FOLD, as_bytes, code_points, letter_spans, span_hashes
from textgraph.llm.tables import fold, keeps_columns, map_blocks, table

PREFIXES = (5, 7)
PRIOR = 3.0
LEAST_COUNT = 3
LEAST_ODDS = 2.0
DRIFT = 0.05
SAMPLE_ROWS = 20_000
MODEL_TOKENS = 200_000
# Rows are scored by themselves, so a small block will do.
SCORED_BYTES = 1 << 20
K = 1.0


@dataclass(frozen=True)
class ToxicModel:
    """Hashes of tokens or prefixes and what they score (three sorted tables,
    longest first), the law of chance segments, and the logistic curve."""

    keys: tuple[np.ndarray, ...]
    odds: tuple[np.ndarray, ...]
    rate: float
    slope: float
    shift: float


def token_hashes(texts: pa.Array) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all tokens whole and by prefix, longest first, then text and byte ranges."""
    data, starts = as_bytes(texts)
    start, end, first = letter_spans(data, starts)
    low = FOLD[data]
    levels = [span_hashes(low, start, end)]
    for n in sorted(PREFIXES, reverse=True):
        levels.append(span_hashes(low, start, np.minimum(end, start + n)))
    return levels, first, start, end, starts


def training_rows(docs: DataFrame, labels: DataFrame, label: str, train: Column, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``(text, label)``: at most ``rows`` of each label, those of least hash of id."""
    marked = labels.where(F.col(label).isin(0, 1) & F.coalesce(train, F.lit(False))).select("doc_id", F.col(label).cast("int").alias("label"))
    marked = marked.groupBy("doc_id").agg(F.max("label").alias("label"))
    order = F.xxhash64("doc_id")
    some = [marked.where(F.col("label") == y).orderBy(order, "doc_id").limit(rows) for y in (0, 1)]
    return docs.select("doc_id", "text").join(F.broadcast(some[0].unionByName(some[1])), "doc_id").select("text", "label")


def fit(docs: DataFrame, labels: DataFrame, train: Column, rows: int = SAMPLE_ROWS) -> ToxicModel:
    """A model of the labelled rows that ``train`` keeps, on a sample of bounded size."""
    sample = training_rows(docs, labels, "toxic", train, rows)

    def count(block: pa.RecordBatch) -> pa.RecordBatch:
        toxic = block.column("label").to_numpy() == 1
        levels, first, *_ = token_hashes(block.column("text"))
        of = np.repeat(toxic, np.diff(first))
        before = np.zeros(len(of), np.uint64)
        before[1:] = levels[0][:-1]
        before[first[:-1][np.diff(first) > 0]] = 1
        out = []
        for i, keys in enumerate(levels):
            order = np.lexsort((before[of], keys[of]))
            pairs = np.stack([keys[of], before[of]])[:, order]
            pairs = pairs[:, np.append(True, (pairs[:, 1:] != pairs[:, :-1]).any(axis=0))[: len(order)]]
            clean, n = np.unique(keys[~of], return_counts=True)
            out.append((np.full(len(pairs[0]), i), pairs[0], pairs[1], np.zeros(len(pairs[0]), np.int64)))
            out.append((np.full(len(clean), i), clean, np.zeros_like(clean), n))
        level, key, left, n = (np.concatenate(x) for x in zip(*out, strict=True))
        return pa.record_batch([pa.array(level, pa.int32()), pa.array(key.view(np.int64)), pa.array(left.view(np.int64)), pa.array(n, pa.int64())], ["level", "key", "before", "clean"])

    # A row without a clean count is a pair of a toxic text.
    counted = map_blocks(sample, count, "level int, key bigint, before bigint, clean bigint")
    pairs = counted.groupBy("level", "key", "before").agg(F.sum("clean").alias("clean"))
    tokens = pairs.groupBy("level", "key").agg(F.count_if(F.col("clean") == 0).alias("toxic"), F.sum("clean").alias("clean"))
    totals = tokens.groupBy("level").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    total = {r["level"]: r for r in totals.collect()}
    if 0 not in total or not total[0]["toxic"] or not total[0]["clean"]:
        empty = (np.zeros(0, np.uint64),) * (1 + len(PREFIXES)), (np.zeros(0),) * (1 + len(PREFIXES))
        return ToxicModel(*empty, 1.0, 0.0, -np.inf)
    ratio = total[0]["toxic"] / total[0]["clean"]
    # No token is better than its counts with a parent of the same odds.
    listed = tokens.where(F.col("toxic") >= LEAST_COUNT).orderBy(F.desc(F.col("toxic") / (F.col("clean") + 1)), "level", "key").limit(MODEL_TOKENS)
    found = listed.where(F.col("toxic") / ratio > F.col("clean")).toPandas()
    keys, odds = [], []
    for level in range(1 + len(PREFIXES)):
        of = found[found["level"] == level].sort_values("key")
        value = np.log((of["toxic"].to_numpy() / ratio + PRIOR) / (of["clean"].to_numpy() + PRIOR))
        key = of["key"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(key)
        keys.append(key[order])
        odds.append(value[order])
    rate = chance_rate(sample.where("label = 0"), tuple(keys), tuple(odds))
    model = ToxicModel(tuple(keys), tuple(odds), rate, 1.0, 0.0)
    evidence = score_rows(sample, model, "label").toPandas()
    return ToxicModel(tuple(keys), tuple(odds), rate, *logistic(evidence["evidence"].to_numpy(), evidence["label"].to_numpy()))


def chance_rate(clean: DataFrame, keys: tuple[np.ndarray, ...], odds: tuple[np.ndarray, ...]) -> float:
    """Lambda of the extreme-value law: the positive root, at most 1, of
    ``mean(exp(lambda * s)) = 1`` over the scores s of the tokens of clean texts."""

    def count(block: pa.RecordBatch) -> pa.RecordBatch:
        levels, first, *_ = token_hashes(block.column("text"))
        score, n = np.unique(np.round(token_scores(levels, first, keys, odds), 2), return_counts=True)
        return pa.record_batch([pa.array(score), pa.array(n, pa.int64())], ["score", "n"])

    # Scores lie in a range of some 20 and are rounded to 0.01.
    counts = map_blocks(clean.select("text"), count, "score double, n bigint").groupBy("score").agg(F.sum("n").alias("n")).toPandas()
    scores, shares = counts["score"].to_numpy(), counts["n"].to_numpy() / max(1, counts["n"].sum())
    low, high = 0.0, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if (shares * np.exp(middle * scores)).sum() < 1 else (low, middle)
    return max(low, 0.05)


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of ``1 / (1 + exp(-(slope * z + shift)))`` with z = ln(1 + x), by Newton steps."""
    z = np.stack([np.log1p(x), np.ones(len(x))])
    w = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-(w @ z)))
        h = (z * (p * (1 - p))) @ z.T + 1e-3 * np.eye(2)
        w = np.clip(w + np.linalg.solve(h, z @ (y - p) - 1e-3 * w), -20, 20)
    return float(w[0]), float(w[1])


def token_scores(levels: list[np.ndarray], first: np.ndarray, all_keys: tuple[np.ndarray, ...], all_odds: tuple[np.ndarray, ...]) -> np.ndarray:
    """The log-odds of each token by its longest known form; -DRIFT where
    none reaches ``LEAST_ODDS``, and for a token that repeats the one before it in its text."""
    score = np.full(len(levels[0]), -DRIFT)
    for keys, odds, got in reversed(list(zip(all_keys, all_odds, levels, strict=True))):
        if len(keys):
            at = np.minimum(np.searchsorted(keys, got), len(keys) - 1)
            score = np.where(keys[at] == got, odds[at], score)
    again = np.zeros(len(score), bool)
    again[1:] = levels[0][1:] == levels[0][:-1]
    again[first[:-1][np.diff(first) > 0]] = False
    score[again] = -DRIFT
    return np.where(score >= LEAST_ODDS, score, -DRIFT)


def maximal_segments(at: list[int], score: list[float], drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(first, last, score)`` of a sequence whose tokens
    at the places ``at`` have positive scores and all others ``-drift``."""
    held: list[tuple[int, int, float, float]] = []  # first, last, sum before, sum behind
    total, next_at = 0.0, 0
    for place, gain in zip(at, score, strict=True):
        total -= drift * (place - next_at)
        next_at = place + 1
        first, left = place, total
        total += gain
        right = total
        while held:
            j = len(held) - 1
            while j >= 0 and held[j][2] >= left:
                j -= 1
            if j < 0 or held[j][3] >= right:
                break
            first, left = held[j][0], held[j][2]
            del held[j:]
        held.append((first, place, left, right))
    return [(a, b, right - left) for a, b, left, right in held]


def score_rows(docs: DataFrame, model: ToxicModel, *keep: str) -> DataFrame:
    """``(*keep, evidence, score, passages)`` of each row of ``docs``. Passages are
    ``(start, end, excess)`` of the segments that stand out, in code points, end exclusive."""
    fields = {f.name: f.dataType.simpleString() for f in docs.schema.fields}

    def work(block: pa.RecordBatch) -> pa.RecordBatch:
        text = block.column("text")
        levels, first, start, end, starts = token_hashes(text)
        score = token_scores(levels, first, model.keys, model.odds)
        hits = np.flatnonzero(score > 0)
        evidence = np.zeros(block.num_rows)
        passages: list[list[dict]] = [[] for _ in range(block.num_rows)]
        rows = np.searchsorted(first, hits, side="right") - 1
        edges = np.flatnonzero(np.diff(rows, prepend=-1, append=block.num_rows))
        points = code_points(as_bytes(text)[0]) if len(hits) else None
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            row = int(rows[a])
            base, n = int(first[row]), int(first[row + 1] - first[row])
            for x, y, total in maximal_segments((hits[a:b] - base).tolist(), score[hits[a:b]].tolist()):
                excess = model.rate * total - np.log(K * n)
                if excess > 0:
                    evidence[row] += excess
                    begin, stop = points[[start[base + x], end[base + y]]] - points[starts[row]]
                    passages[row].append({"start": int(begin), "end": int(stop), "excess": float(excess)})
        if np.isinf(model.shift):
            p = np.zeros(block.num_rows)
        else:
            p = 1 / (1 + np.exp(-(model.slope * np.log1p(evidence) + model.shift)))
        kept = [block.column(c) for c in keep]
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("excess", pa.float64())]))
        return pa.record_batch([*kept, pa.array(evidence), pa.array(p), pa.array(passages, span)], [*keep, "evidence", "score", "passages"])

    schema = ", ".join([*(f"`{c}` {fields[c]}" for c in keep), "evidence double, score double, passages array<struct<start:bigint,end:bigint,excess:double>>"])
    return map_blocks(docs.select(*dict.fromkeys([*keep, "text"])), work, schema, SCORED_BYTES)


HELD_OUT_FOLD, FOLDS, THRESHOLD = 1, 3, 0.7


def is_training() -> Column:
    return fold("doc_id", FOLDS) != HELD_OUT_FOLD


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents; labels are learnt from two of three folds of ids."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = score_rows(docs, fit(docs, labels, is_training()), "doc_id")
    return scored.select(
        "doc_id",
        F.coalesce(fold("doc_id", FOLDS) == HELD_OUT_FOLD, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "passages",
    )


@keeps_columns
def drop_toxic(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that do not score ``THRESHOLD`` or more, all columns kept."""
    given = table(spark, sf_dir, "documents")
    model = fit(given, table(spark, sf_dir, "labels"), is_training())
    return score_rows(docs, model, *docs.columns).where(F.col("score") < THRESHOLD).select(*docs.columns)
