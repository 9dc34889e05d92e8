"""Exact top-k search by integer inner product with MaxScore.

Terms are dimensions; a term's posting list holds every vector's integer component in it.
Per shard of candidates and per query the terms are ordered by their score bound, the largest
product the shard allows.  The longest prefix of low-bound terms whose bounds together stay
below the current k-th best score is *non-essential*: a vector that gains only from those
cannot enter the result.  Essential postings are traversed for the whole shard, vectors whose
partial score plus the bounds still open fall short are dropped, and the non-essential terms are
probed one after another, highest bound first, only for the vectors still competitive.  The
per-shard results are merged by one ranking per query, so the answer is exact.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabforge.llm.common import table, written

RESULT = "query_id long, query_key long, vec_id long, score long"
_EXACT = float(1 << 53)
_LONG = float(1 << 62)


def quantise(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """``(vec_id, q)`` with q = floor(scale * component) as longs.

    Vectors that are null or hold a null, NaN or infinite component take no part, nor do rows
    without a vec_id.  Exact repeats of a row count once.  An empty vector scores 0 everywhere,
    and a vector shorter than another has 0 in the missing components.
    """
    x = F.col("embedding")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return (
        vectors.where(F.col("vec_id").isNotNull() & x.isNotNull())
        .where(~bad)
        .select(F.col("vec_id").cast("long").alias("vec_id"),
                F.transform(x, lambda v: F.floor(F.lit(scale) * v.cast("double")).cast("long")).alias("q"))
        .groupBy("vec_id", "q").agg(F.lit(1).alias("_n")).drop("_n")
    )


class Shard:
    """Posting lists of one shard of candidates: a row per term, sorted by vec_id within."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.post = ids[order], np.ascontiguousarray(vectors[order].T)
        self.high = self.post.max(axis=1, initial=0) if len(ids) else np.zeros(self.post.shape[0], self.post.dtype)
        self.low = self.post.min(axis=1, initial=0) if len(ids) else self.high
        self.widest = max(float(np.abs(self.high).max(initial=0)), float(np.abs(self.low).max(initial=0)))

    def top(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """vec_ids and scores of the k best candidates, ties to the smaller vec_id."""
        post, high, low = self.post, self.high, self.low
        if self.widest * float(np.abs(query).max(initial=0)) * max(1, len(query)) >= _EXACT:
            post, high, low = post.astype(np.int64), high.astype(np.int64), low.astype(np.int64)
        else:
            query = query.astype(post.dtype)
        bound = np.maximum(query * high, query * low)  # never below 0: both include the 0 of a missing component
        terms = np.argsort(bound, kind="stable")
        rest = np.concatenate([np.zeros(1, bound.dtype), np.cumsum(bound[terms])])  # bounds of the first t terms
        own = self.ids == query_id
        # A first threshold: the exact scores of the vectors that do best on the strongest terms.
        lead = terms[-8:]
        partial = query[lead] @ post[lead]
        partial[own] = np.iinfo(np.int64).min if partial.dtype == np.int64 else -np.inf
        some = min(len(self.ids), 4 * k + 1)
        seeds = np.argpartition(-partial, some - 1)[:some] if some else np.zeros(0, np.int64)
        seeds = seeds[~own[seeds]]
        seeded = query @ post[:, seeds]
        floor = np.partition(seeded, len(seeded) - k)[len(seeded) - k] if len(seeded) >= k else None
        # Terms below ``first`` are non-essential; with no threshold yet all are essential.
        first = 0 if floor is None else int(np.searchsorted(rest, floor, side="left")) - 1
        first = max(0, min(first, len(terms)))
        essential = terms[first:]
        score = query[essential] @ post[essential]
        alive = np.flatnonzero(~own if floor is None else ~own & (score + rest[first] >= floor))
        score = score[alive]
        for t in range(first - 1, -1, -1):
            if not len(alive):
                break
            score = score + query[terms[t]] * post[terms[t], alive]
            if len(score) > k:
                floor = max(floor, np.partition(score, len(score) - k)[len(score) - k] + self._least(query, high, low, terms[:t]))
            keep = score + rest[t] >= floor
            alive, score = alive[keep], score[keep]
        best = np.lexsort((self.ids[alive], -score))[:k]
        return self.ids[alive[best]], score[best].astype(np.int64)

    @staticmethod
    def _least(query: np.ndarray, high: np.ndarray, low: np.ndarray, terms: np.ndarray):
        """The least the terms not probed yet can add."""
        return np.minimum(query[terms] * high[terms], query[terms] * low[terms]).sum()


def _matrix(rows: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.int64)
    for i, v in enumerate(rows):
        out[i, : len(v)] = v
    return out


def topk(vectors: DataFrame, queries: DataFrame, k: int = 10, shard_rows: int = 4096, query_block: int = 512) -> DataFrame:
    """The k best candidates of each query: ``query_id, query_key, rank, vec_id, score``.

    ``vectors`` and ``queries`` are ``(vec_id, q)`` tables of :func:`quantise`.  A query's own
    vec_id is no candidate of it.  Candidates are dealt into shards of about ``shard_rows`` and
    queries into blocks of about ``query_block`` by hash; one task holds one shard and one block.
    Two different vectors under one vec_id are two queries (``query_key`` tells them apart).
    Raises where a score could leave 64 bits: the greatest component of one side times the greatest
    sum of magnitudes of the other bounds every score and every sum on the way to it.
    """
    size = F.transform("q", lambda v: F.abs(v.cast("double")))
    (n, most, total), (m, asked_most, asked_total) = (
        df.agg(F.count(F.lit(1)), F.coalesce(F.max(F.array_max(size)), F.lit(0.0)), F.coalesce(F.max(F.aggregate(size, F.lit(0.0), lambda s, v: s + v)), F.lit(0.0))).first()
        for df in (vectors, queries))
    if min(most * asked_total, total * asked_most) >= _LONG:
        raise ValueError("scores of these vectors may not fit 64 bits; scale them down")
    shards, blocks = max(1, math.ceil(n / shard_rows)), max(1, math.ceil(m / query_block))
    deal = lambda df, salt, count: F.pmod(F.xxhash64(F.lit(salt), "vec_id", "q"), F.lit(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    left = vectors.select("vec_id", "q", deal(vectors, "shard", shards).alias("shard"), every(blocks).alias("block"))
    right = queries.select("vec_id", "q", every(shards).alias("shard"), deal(queries, "block", blocks).alias("block"), F.xxhash64("vec_id", "q").alias("query_key"))

    def search(key: tuple, c: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"query_id": [], "query_key": [], "vec_id": [], "score": []}, dtype="int64")
        if not len(c) or not len(q):
            return none
        width = max(1, max(map(len, c["q"])), max(map(len, q["q"])))
        dense, asked = _matrix(c["q"], width), _matrix(q["q"], width)
        if float(np.abs(dense).max(initial=0)) < _EXACT:
            dense = dense.astype(np.float64)
        shard, out = Shard(c["vec_id"].to_numpy(np.int64), dense), []
        for qid, qkey, vector in zip(q["vec_id"], q["query_key"], asked, strict=True):
            ids, scores = shard.top(qid, vector, k)
            out.append(pd.DataFrame({"query_id": qid, "query_key": qkey, "vec_id": ids, "score": scores}))
        return pd.concat(out) if out else none

    found = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInPandas(search, RESULT)
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def query(spark, sf_dir: str) -> DataFrame:
    """op2: every vector whose vec_id is divisible by 100 against all others."""
    vectors = written(quantise(table(spark, sf_dir, "embeddings")), "op2-vectors")
    return topk(vectors, vectors.where(F.col("vec_id") % 100 == 0)).select("query_id", "rank", "vec_id", "score")


SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, a.q AS aq, b.vec_id AS vec_id,
         coalesce(CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: coalesce(z[1], 0) * coalesce(z[2], 0))) AS BIGINT), 0) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id, aq ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 10
"""
