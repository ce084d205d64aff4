"""Exact top-k search by inner product, with block-at-a-time pruning.

Vectors of whole numbers lie in blocks: ranges of ``BLOCK`` rows in an order that
puts vectors with the same large components side by side. A block is one row with
its ids, its forward index (all components of its rows) and the least and greatest
value of each component. For a query the sum of the greatest possible products of
all components bounds every score in a block. Blocks are visited by falling bound
until that is below the kth score so far; a block of equal bound is still scored,
as a tie may have a smaller id.

Queries travel in groups of ``GROUP`` to shards of ``SHARD`` blocks each, so a task
holds one group and one shard; the shards' answers are merged by query.

Vectors that are null, empty or hold null or non-finite components take no part,
nor do null ids. Rows with the query's own id are not its candidates. Vectors of
unlike length are filled up with zeros.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textgraph.llm.tables import table
from textgraph.scratch import cut_lineage

BLOCK = 64
GROUP = 512
SHARD = 64
LEADING = 3
EXACT = float(1 << 53)


def whole_vectors(df: DataFrame, id_col: str, vector: str, scale: int = 1024) -> DataFrame:
    """``(id, v)`` with ``floor(scale * x)`` for each component x, for the vectors that take part."""
    x = F.col(vector)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    rows = df.where(F.col(id_col).isNotNull() & (F.size(x) > 0) & finite)
    return rows.select(F.col(id_col).cast("bigint").alias("id"), F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("v"))


def order_key(v: Column) -> Column:
    """The signed places of the largest components: neighbours by it are alike in those."""
    ranked = F.slice(F.array_sort(F.transform(v, lambda c, i: F.struct((-F.abs(c)).alias("size"), i.alias("i"), (c < 0).alias("sign")))), 1, LEADING)
    return F.transform(ranked, lambda r: F.struct(r["i"], r["sign"]))


def every(n: int) -> Column:
    """One copy of a row for each number below n."""
    return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))


def matrix(pdf: pd.DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids and vectors of rows, by id."""
    pdf = pdf.sort_values("id", kind="stable")
    m = np.zeros((len(pdf), dims), np.int64)
    for i, v in enumerate(pdf["v"]):
        m[i, : len(v)] = v
    return pdf["id"].to_numpy(np.int64), m


def packed(rows: DataFrame, dims: int, size: int) -> DataFrame:
    """``(ids, rows, least, most)``: blocks of ``size`` rows, cut within ordered partitions."""

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for pdf in batches:
            held.append(pdf)
            n += len(pdf)
            if n >= 32 * size:
                whole = pd.concat(held)
                yield from cut(whole.iloc[: n // size * size])
                held, n = [whole.iloc[n // size * size :]], n % size
        if n:
            yield from cut(pd.concat(held))

    def cut(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
        out = []
        for a in range(0, len(pdf), size):
            ids, m = matrix(pdf.iloc[a : a + size], dims)
            out.append((ids.tobytes(), m.tobytes(), m.min(axis=0).tobytes(), m.max(axis=0).tobytes()))
        yield pd.DataFrame(out, columns=["ids", "rows", "least", "most"])

    rows = rows.withColumn("_key", order_key(F.col("v")))
    rows = rows.repartitionByRange("_key", "id").sortWithinPartitions("_key", "id")
    return rows.select("id", "v").mapInPandas(task, "ids binary, rows binary, least binary, most binary")


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products: in floating point where no sum can leave its whole numbers."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * rows.shape[1]
    if most < EXACT:
        return (queries.astype(float) @ rows.T.astype(float)).astype(np.int64)
    return queries @ rows.T


def best_of_shard(q_ids: np.ndarray, q: np.ndarray, blocks: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """``(ids, scores, scored)``: the k best candidates of each query, ties to smaller ids; -1 where
    there are fewer. ``scored`` counts pairs of a query and a block that was not pruned."""
    least, most = (np.stack([b[i] for b in blocks]) for i in (2, 3))
    bound = products(np.maximum(q, 0), most) + products(np.minimum(q, 0), least)
    order = np.argsort(-bound, axis=1, kind="stable")
    low = np.iinfo(np.int64).min
    ids, scores = np.full((len(q), k), -1, np.int64), np.full((len(q), k), low, np.int64)
    empty = np.ones((len(q), k), bool)
    scored = 0
    for step in range(len(blocks)):
        block = order[:, step]
        open_ = (bound[np.arange(len(q)), block] >= scores[:, -1]) | empty[:, -1]
        if not open_.any():
            break
        for b in np.unique(block[open_]):
            at = np.flatnonzero(open_ & (block == b))
            b_ids, rows = blocks[b][0], blocks[b][1]
            scored += len(at)
            got = np.concatenate([scores[at], products(q[at], rows)], axis=1)
            who = np.concatenate([ids[at], np.broadcast_to(b_ids, (len(at), len(b_ids)))], axis=1)
            none = np.concatenate([empty[at], q_ids[at][:, None] == b_ids[None, :]], axis=1)
            best = np.lexsort((who, -got.astype(float) if np.abs(got[~none]).max(initial=0) < EXACT else ~got, none), axis=1)[:, :k]
            pick = np.arange(len(at))[:, None], best
            scores[at], ids[at], empty[at] = np.where(none[pick], low, got[pick]), np.where(none[pick], -1, who[pick]), none[pick]
    return np.where(empty, -1, ids), scores, scored


def top_k(rows: DataFrame, queries: DataFrame, k: int = 10, block: int = BLOCK, group: int = GROUP, shard: int = SHARD) -> DataFrame:
    """``(query_id, rank, id, score)``: the k rows of greatest inner product for each query.

    Both tables are ``(id, v)``. The index is written as a table; some counts and the
    writing run when called.
    """
    width = F.max(F.size("v"))
    dims = max(rows.agg(width).first()[0] or 0, queries.agg(width).first()[0] or 0)
    if not dims:
        return rows.sparkSession.createDataFrame([], "query_id bigint, rank int, id bigint, score bigint")
    index = cut_lineage(packed(rows, dims, block))
    shards = max(1, -(-index.count() // shard))
    groups = max(1, -(-queries.count() // group))

    def gather(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, m = matrix(pdf, dims)
        return pd.DataFrame({"group": [pdf["group"].iloc[0]], "q_ids": [ids.tobytes()], "q_rows": [m.tobytes()]})

    asked = queries.withColumn("group", F.pmod(F.xxhash64("id"), F.lit(groups)))
    asked = asked.groupBy("group").applyInPandas(gather, "group bigint, q_ids binary, q_rows binary")
    # Each group of queries meets each shard once; neither side is held whole anywhere.
    pairs = asked.withColumn("shard", every(shards))
    spread = index.withColumn("shard", F.pmod(F.xxhash64("ids"), F.lit(shards))).withColumn("group", every(groups))

    def answer(key: tuple, data: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        if not len(data) or not len(ask):
            return pd.DataFrame({"query_id": [], "id": [], "score": []}).astype("int64")
        q_ids = np.frombuffer(ask["q_ids"].iloc[0], np.int64)
        q = np.frombuffer(ask["q_rows"].iloc[0], np.int64).reshape(-1, dims)
        of = data.sort_values("ids")
        blocks = [
            (np.frombuffer(i, np.int64), np.frombuffer(r, np.int64).reshape(-1, dims), np.frombuffer(a, np.int64), np.frombuffer(b, np.int64))
            for i, r, a, b in zip(of["ids"], of["rows"], of["least"], of["most"], strict=True)
        ]
        ids, scores, _ = best_of_shard(q_ids, q, blocks, k)
        real = scores != np.iinfo(np.int64).min
        return pd.DataFrame({"query_id": np.repeat(q_ids, k).reshape(len(q), k)[real], "id": ids[real], "score": scores[real]})

    found = spread.groupBy("group", "shard").cogroup(pairs.groupBy("group", "shard")).applyInPandas(answer, "query_id bigint, id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "id", "score")


def op3_top_k(spark, sf_dir: str) -> DataFrame:
    """The 10 vectors of greatest inner product for every hundredth vector."""
    rows = whole_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    found = top_k(rows, rows.where(F.col("id") % 100 == 0))
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


SQL = """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
        WHERE vec_id IS NOT NULL AND len(embedding) > 0
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
        FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored
    )
    SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 10"""
