"""Exact top-k inner product search by MaxScore over shards.

A component is a term, its posting list the shard's column. In a shard every term has a lowest and a highest contribution to
a query's score. Terms are sorted by the difference; those whose differences together cannot lift a row from below the
current k-th score are non-essential. Essential columns are summed for all rows of a chunk; the others are probed, widest
first, only for rows that can still reach the k-th score. The shards' lists are merged by a ranking per query.

Vectors and queries are dealt into shards and blocks of bounded size; a task sees one block of queries and one shard.

Defined cases: vectors that are null or hold null or non-finite components, and rows without an id, take no part; shorter
vectors count as ended by zeros; a row is never its own query's candidate, nor is another row of the same id; ties go to
the smaller id; repeated rows are candidates of their own; repeated equal query rows count once; other columns are ignored.
Components must stay below 2^26 in size after scaling.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

SHARD_ROWS, BLOCK_QUERIES, CHUNK = 8192, 256, 512


def scaled(vectors: DataFrame, factor: int = 1024, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, v): whole vectors as integers floor(factor * x)."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    v = F.col(vector)
    return vectors.where(F.col(key).isNotNull() & v.isNotNull() & ~F.exists(v, bad)).select(
        F.col(key).cast("long").alias("id"), F.transform(v, lambda x: F.floor(x.cast("double") * factor).cast("long")).alias("v"))


def _matrix(rows: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), dtype=np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def maxscore(query: np.ndarray, own: int, ids: np.ndarray, rows: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best (ids, scores) of one shard. low, high: each column's least and greatest value."""
    at_low, at_high = query * low, query * high
    least, reach = np.minimum(at_low, at_high), np.abs(at_high - at_low)
    order = np.argsort(-reach, kind="stable")
    best_id, best = np.empty(0, np.int64), np.empty(0, np.int64)
    # rest[j], base[j]: what the terms order[j:] can add at most over their least, and their least.
    rest = np.append(np.cumsum(reach[order][::-1])[::-1], 0)
    base = np.append(np.cumsum(least[order][::-1])[::-1], 0)
    for start in range(0, len(ids), CHUNK):
        at = np.arange(start, min(start + CHUNK, len(ids)))
        at = at[ids[at] != own]
        bound = best[-1] if len(best) == k else None
        # non-essential: order[split:], the longest tail whose contributions alone cannot reach the bound
        split = len(order) if bound is None else int(np.searchsorted(-(base[0] + rest), -bound, side="right"))
        essential = order[: max(1, split)] if len(order) else order
        score = rows[np.ix_(at, essential)] @ query[essential]
        done = len(essential)
        while done < len(order) and len(at):
            alive = score + base[done] + rest[done] >= bound
            at, score = at[alive], score[alive]
            more = order[done : done + 8]
            score = score + rows[np.ix_(at, more)] @ query[more]
            done += len(more)
        best_id, best = np.append(best_id, ids[at]), np.append(best, score)
        keep = np.lexsort((best_id, -best))[:k]
        best_id, best = best_id[keep], best[keep]
    return best_id, best


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """vectors, queries: (id, v) as ``scaled`` gives them. Returns query_id, rank from 1, vec_id, score."""
    vectors, queries = materialize(vectors), materialize(queries.dropDuplicates(["id", "v"]).withColumn("q", F.xxhash64("v")))
    shards, blocks = (max(1, -(-x.count() // n)) for x, n in ((vectors, SHARD_ROWS), (queries, BLOCK_QUERIES)))

    def dealt(key: Column, n: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")

    def copies(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = queries.select("id", "q", "v", dealt(F.col("id"), blocks).alias("block"), copies(shards).alias("shard"))
    right = vectors.select("id", "v", dealt(F.col("id"), shards).alias("shard"), copies(blocks).alias("block"))

    def search(asked: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found: list[pd.DataFrame] = []
        if len(asked) and len(rows):
            width = max(max(map(len, asked["v"])), max(map(len, rows["v"])))
            matrix, ids = _matrix(rows["v"], width), rows["id"].to_numpy(np.int64)
            low, high = matrix.min(axis=0), matrix.max(axis=0)
            for own, print_, query in zip(asked["id"], asked["q"], _matrix(asked["v"], width), strict=True):
                best_id, best = maxscore(query, own, ids, matrix, low, high, k)
                found.append(pd.DataFrame({"query_id": own, "q": print_, "vec_id": best_id, "score": best}))
        return pd.concat(found) if found else pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query_id", "q", "vec_id", "score")})

    parts = left.groupBy("block", "shard").cogroup(right.groupBy("block", "shard")).applyInPandas(
        search, "query_id long, q long, vec_id long, score long")
    order = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id")
    return parts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
