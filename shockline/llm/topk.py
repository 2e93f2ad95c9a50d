"""Exact top-k inner products by aggregation without random access (operator 5).

Each dimension of a block of candidates is a list sorted by value, read from the top for a positive
query component and from the bottom for a negative one. All lists are read to a common depth, which grows
so that each step reads half of what is left. At a depth a candidate's score lies between a lower bound (unread
components at the worst value of their list) and an upper bound (unread components at the value that the list
would give next). Candidates whose upper bound is below the k-th best lower bound are out for good. A query stops
reading when every candidate that is left has been met in all lists, so that both its bounds are its score: no
row is looked up out of turn. The bounds of a block of queries are matrix products while many
candidates are left, and products of each query with its own few after that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

#: Candidates and queries that meet in a task, and queries whose bounds are one product.
CANDIDATES, QUERIES, STEP = 4096, 2048, 256
#: Share of (query, candidate) pairs from which on each query goes on alone.
FEW = 0.1


class SortedLists:
    """A block of candidates, and the lists of its dimensions."""

    def __init__(self, vectors: np.ndarray):
        self.rows = vectors
        self.sorted = np.sort(vectors, axis=0)

    def depths(self) -> Iterator[int]:
        """Entries of a list that are unread: half of them, a quarter, and so on down to none."""
        unread = len(self.rows)
        while unread:
            unread //= 2
            yield unread

    def at(self, unread: int) -> tuple[np.ndarray, ...]:
        """Candidates as read so far: for the upper bounds from the top and the bottom, then for the lower ones."""
        n, x, s = len(self.rows), self.rows, self.sorted
        top, low = s[min(unread, n - 1)], s[max(n - 1 - unread, 0)]  # the last values read; equal ones are read with them
        each = np.arange(x.shape[1])
        below = s[np.maximum((x < top).sum(axis=0) - 1, 0), each]
        above = s[np.minimum((x <= low).sum(axis=0), n - 1), each]
        seen_top, seen_low = x >= top, x <= low
        return np.where(seen_top, x, below), np.where(seen_low, x, above), np.where(seen_top, x, s[0]), np.where(seen_low, x, s[-1])


def kth_best(lower: np.ndarray, k: int) -> np.ndarray:
    return np.partition(lower, lower.shape[-1] - k, axis=-1)[..., lower.shape[-1] - k]


def block_top(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, lists: SortedLists, k: int, log: list | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """query position, candidate position, score: each query's k best of the block, ties to the smaller id.

    log: gets the number of unread entries of a list and of candidates left for each query that stops.
    """
    plus, minus = np.maximum(q, 0), np.minimum(q, 0)
    live = q_ids[:, None] != ids
    left, found = {i: np.flatnonzero(live[i]) for i in range(len(q))}, {}
    dense = True
    for unread in lists.depths():
        up_top, up_low, lo_top, lo_low = lists.at(unread)
        if dense:
            upper, lower = plus @ up_top.T + minus @ up_low.T, plus @ lo_top.T + minus @ lo_low.T
            lower[~live] = lower.min(initial=0) - 1
            if k < len(ids):
                live &= upper >= kth_best(lower, k)[:, None]
            left, dense = {i: np.flatnonzero(live[i]) for i in left}, live.mean() > FEW
        for i, own in list(left.items()):
            if dense:
                up, lo = upper[i, own], lower[i, own]
            else:
                up, lo = up_top[own] @ plus[i] + up_low[own] @ minus[i], lo_top[own] @ plus[i] + lo_low[own] @ minus[i]
                if k < len(own):
                    stay = up >= kth_best(lo, k)
                    left[i], up, lo = own[stay], up[stay], lo[stay]
            if (up == lo).all():
                found[i] = left.pop(i), lo
                if log is not None:
                    log.append((unread, len(lo)))
        if not left:
            break
        live[list(found)] = False
    out = []
    for i, (own, score) in found.items():
        order = np.lexsort((ids[own], -score))[:k]
        out.append((np.full(len(order), i), own[order], score[order]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def quantized(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """vec_id, v (array<long> of floor(scale * x)): one row for each id with a whole, finite vector.

    Null ids, null or empty vectors, and vectors with null or non-finite components go. Rows that
    repeat an id count once, with the smallest vector. Further columns are ignored.
    """
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    v = v.where("vec_id is not null and size(e) > 0 and forall(e, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    v = v.select("vec_id", F.transform("e", lambda x: F.floor(x * scale)).alias("v"))
    return v.groupBy("vec_id").agg(F.min("v").alias("v"))


def exact_type(q: np.ndarray, x: np.ndarray) -> type:
    """The fastest type in which these inner products have no rounding; plain integers beyond all of them."""
    most = q.shape[1] * max(1, int(np.abs(q.astype(object)).max(initial=0)) * int(np.abs(x.astype(object)).max(initial=0)))
    return np.float32 if most < 2**23 else np.float64 if most < 2**52 else object


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, candidates: int = CANDIDATES, per_task: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products of each query over all other vectors.

    vectors and queries as quantized() returns them; a query meets the vectors of its own length
    whose id is another. Ties go to the smaller vec_id. Blocks of queries meet blocks of candidates.
    """
    n, m = vectors.count(), queries.count()
    blocks, groups = max(1, -(-n // candidates)), max(1, -(-m // per_task))

    def meet(key: tuple, q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        made = []
        if len(q) and len(c):
            q_ids, ids = q["vec_id"].to_numpy(), c["vec_id"].to_numpy()
            a, b = np.stack(q["v"].to_numpy()), np.stack(c["v"].to_numpy())
            kind = exact_type(a, b)
            a, lists = a.astype(kind), SortedLists(b.astype(kind))
            for at in range(0, len(a), STEP):
                i, j, s = block_top(q_ids[at : at + STEP], a[at : at + STEP], ids, lists, k)
                made.append(pd.DataFrame({"query_id": q_ids[at + i], "vec_id": ids[j], "score": s.astype(np.int64)}))
        return pd.concat(made) if made else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype=np.int64)

    def dealt(rows: DataFrame, own: str, count: int, other: str, others: int) -> DataFrame:
        rows = rows.withColumn("size", F.size("v")).withColumn(own, F.pmod(F.xxhash64("vec_id"), F.lit(count)))
        return rows.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long"))))

    left = dealt(queries, "qb", groups, "cb", blocks).groupBy("size", "qb", "cb")
    right = dealt(vectors, "cb", blocks, "qb", groups).groupBy("size", "qb", "cb")
    near = left.cogroup(right).applyInPandas(meet, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = written(quantized(table(spark, sf_dir, "embeddings")), "quantized")
    return top_k(v, v.where("vec_id % 20 = 0"))


ORACLE = """
WITH v AS (
  SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
