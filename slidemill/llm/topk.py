"""Exact top-k inner products by MaxScore over sharded postings."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def matrix(rows: pd.Series, width: int) -> np.ndarray:
    """Integer rows padded with zeros to ``width``."""
    out = np.zeros((len(rows), width), np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def maxscore(query: np.ndarray, ids: np.ndarray, columns: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, own: int, block: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """The k best (score, id) of one shard for one query; ties go to smaller ids.

    ``columns[d]`` is the postings list of term d: its value for every id, in id order. A term's contribution is
    counted above its least value in the shard, so it is never negative and ``bound`` is its most. Terms whose
    bounds together cannot lift a vector to the k-th best score are non-essential: postings of the others are
    traversed block by block, and the non-essential ones are probed, largest bound first, only for the ids that can
    still compete.
    """
    least = np.minimum(query * low, query * high)
    bound = np.maximum(query * low, query * high) - least
    order = np.argsort(-bound, kind="stable")
    order = order[bound[order] > 0]
    rest = np.append(np.cumsum(bound[order][::-1])[::-1], 0)  # what the terms from here on can add
    base = int(least.sum())
    best_s, best_i = np.empty(0, np.int64), np.empty(0, np.int64)
    for at in range(0, len(ids), block):
        end = min(at + block, len(ids))
        alive = np.arange(at, end)
        alive = alive[ids[alive] != own]
        score = np.full(len(alive), base, np.int64)
        full = len(best_s) >= k
        floor = int(best_s[-1]) if full else None
        essential = int(np.searchsorted(-rest, -(floor - base), side="right")) if full else len(order)
        essential = min(max(essential, 1), len(order))
        for d in order[:essential]:
            score += query[d] * columns[d][alive] - least[d]
        for j in range(essential, len(order)):
            keep = score + rest[j] >= floor
            if not keep.all():
                alive, score = alive[keep], score[keep]
            if not len(alive):
                break
            d = order[j]
            score = score + query[d] * columns[d][alive] - least[d]
        if full:
            keep = score >= floor
            alive, score = alive[keep], score[keep]
        if len(alive):
            best_s, best_i = np.concatenate([best_s, score]), np.concatenate([best_i, ids[alive]])
            top = np.lexsort((best_i, -best_s))[:k]
            best_s, best_i = best_s[top], best_i[top]
    return best_s, best_i


def top_k(vectors: DataFrame, k: int = 10, query_every: int = 100, scale: int = 1024, shard_rows: int = 8192, block_rows: int = 8192) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best integer inner products of every query.

    Queries are the rows whose ``vec_id`` is divisible by ``query_every``; candidates are all rows with another
    ``vec_id``. Components become ``floor(scale * x)``. Rows with a null id, a null vector, or a null or non-finite
    component take no part; shorter vectors count as padded with zeros; rows that repeat a ``vec_id`` count once
    (smallest vector). Ties rank by smaller ``vec_id``; an empty table gives no rows; other columns are not read.

    Vectors are hashed to shards of about ``shard_rows`` and queries to blocks of about ``block_rows``; each
    (shard, block) pair is one bounded group. With ``m`` queries over ``n`` rows that moves ``n m (1 / shard_rows + 1 /
    block_rows)`` vectors, so both are as large as a task can hold; per-shard winners are merged by a window whose partial limit
    runs before the shuffle. Nothing is broadcast or collected but two counts.
    """
    ok = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    whole = (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
        .where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ok)
        .select("vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("v"))
    )
    is_query = F.pmod("vec_id", F.lit(query_every)) == 0
    n, m = whole.agg(F.count(F.lit(1)), F.count(F.when(is_query, 1))).first()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-m // block_rows))
    spread = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    cands = whole.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")).withColumn("block", spread(blocks))
    asked = whole.where(is_query).withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).withColumn("shard", spread(shards))

    def search(queries: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple] = []
        if len(queries) and len(shard):
            once = lambda df: df.assign(t=[tuple(x) for x in df.v]).sort_values(["vec_id", "t"]).drop_duplicates("vec_id")
            if shard.vec_id.duplicated().any():
                shard = once(shard)
            if queries.vec_id.duplicated().any():
                queries = once(queries)
            shard = shard.sort_values("vec_id")
            width = max(shard.v.map(len).max(), queries.v.map(len).max())
            ids, columns = shard.vec_id.to_numpy(), np.ascontiguousarray(matrix(shard.v, width).T)
            low, high = columns.min(1, initial=0) if not width else columns.min(1), columns.max(1, initial=0) if not width else columns.max(1)
            for own, query in zip(queries.vec_id.to_numpy(), matrix(queries.v, width), strict=True):
                scores, best = maxscore(query, ids, columns, low, high, k, own)
                found.extend((own, i, s) for s, i in zip(scores, best, strict=True))
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")

    per_shard = asked.groupBy("shard", "block").cogroup(cands.groupBy("shard", "block")).applyInPandas(search, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return per_shard.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 10
"""
