"""Exact top-k by inner product with multi-resolution segment statistics.

A vector's segments (1, 4, then 16 equal parts) each have a mean and a
deviation.  For one segment of length l the squared distance is at least
l * ((difference of means)^2 + (difference of deviations)^2), so the sum over
the segments is a lower bound of the whole distance, tighter from level to
level; with the norms it is an upper bound of the inner product.  A block of
rows meets a block of queries level by level; rows that no query's bound lets
reach its k-th best score so far drop out, and exact scores are computed for the
survivors.

Rows and queries are dealt to blocks by hash, each query block goes to every row
block by an equi-join, each pair of blocks is one small matrix, and only k rows
for each query and row block are merged.  Scores are exact integers.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SEGMENTS = (1, 4, 16)
ROW_BLOCK = 4096
QUERY_BLOCK = 256


def _levels(v: np.ndarray) -> list[np.ndarray]:
    """For each level the means and deviations, scaled so that plain products of
    two vectors' statistics add up to a bound of their inner product."""
    made = []
    for parts in SEGMENTS:
        cuts = np.array_split(v, min(parts, v.shape[1]), axis=1)
        stats = [f(c, axis=1) * np.sqrt(c.shape[1]) for c in cuts for f in (np.mean, np.std)]
        made.append(np.stack(stats, axis=1))
    return made


def best(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray,
         k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query number, row id, score) of each query's k best among ``rows``."""
    exact = np.float64 if max(np.abs(queries).max(initial=0), np.abs(rows).max(initial=0)) ** 2 \
        * rows.shape[1] < 2 ** 52 else object
    q, x = queries.astype(float), rows.astype(float)
    q_levels, x_levels = _levels(q), _levels(x)
    # coarse first: the rows that promise most give the thresholds
    bound = q_levels[0] @ x_levels[0].T
    norm = np.argsort(-np.sqrt((x ** 2).sum(axis=1)), kind="stable")[:max(4 * k, 64)]
    seen = (queries.astype(exact) @ rows[norm].astype(exact).T).astype(float)
    seen[query_ids[:, None] == row_ids[norm][None, :]] = -np.inf
    least = (np.partition(seen, -k, axis=1)[:, -k] if seen.shape[1] >= k
             else np.full(len(q), -np.inf))
    slack = 1e-9 * (1 + np.abs(bound))
    alive = bound + slack >= least[:, None]
    for a, b in zip(q_levels[1:], x_levels[1:], strict=True):
        left = np.flatnonzero(alive.any(axis=0))
        bound = a @ b[left].T
        alive[:, left] &= bound + 1e-9 * (1 + np.abs(bound)) >= least[:, None]
    left = np.flatnonzero(alive.any(axis=0))
    score = queries.astype(exact) @ rows[left].astype(exact).T
    out = []
    for i in range(len(queries)):
        at = np.flatnonzero(alive[i, left] & (row_ids[left] != query_ids[i]))
        s, ids = score[i, at].astype(np.int64), row_ids[left][at]
        order = np.lexsort((ids, -s))[:k]
        out.append((np.full(len(order), i), ids[order], s[order]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def top_k(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id",
          vector_col: str = "embedding", scale: float = 64.0) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: for each query the ``k``
    highest inner products of floor(scale * component), ties to the smaller id.

    Rows with a null id, a null vector, or a null or non-finite component take no
    part, nor does a row with its query's own id; only vectors of one length
    meet.  Exactly repeated rows count once.  Few candidates give fewer rows."""
    def whole(df: DataFrame) -> DataFrame:
        v = F.col(vector_col)
        good = (F.col(id_col).isNotNull() & v.isNotNull() & (F.size(v) > 0)
                & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x)
                           & (F.abs(x.cast("double")) < float("inf"))))
        return (df.where(F.coalesce(good, F.lit(False))).select(
            F.col(id_col).cast("long").alias("id"),
            F.transform(v, lambda x: F.floor(x.cast("double") * scale)).alias("v"))
            .distinct().withColumn("dim", F.size("v")))

    rows, asked = whole(vectors), whole(queries)
    blocks = max(1, -(-rows.count() // ROW_BLOCK))
    parts = max(1, -(-asked.count() // QUERY_BLOCK))
    packed = (rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
              .groupBy("dim", "block").agg(F.collect_list(F.struct("id", "v")).alias("rows")))
    sent = (asked.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)))
            .groupBy("dim", "part").agg(F.collect_list(F.struct("id", "v")).alias("queries"))
            .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"),
                                                      F.lit(blocks - 1).cast("long")))))

    def meet(batches):
        for batch in batches:
            for some, given in zip(batch["queries"], batch["rows"], strict=True):
                if not len(some) or not len(given):
                    continue
                q_ids = np.array([r["id"] for r in some])
                ids = np.array([r["id"] for r in given])
                q = np.array([r["v"] for r in some])
                at, found, score = best(q, q_ids, np.array([r["v"] for r in given]), ids, k)
                yield pd.DataFrame({"query_id": q_ids[at], "vec_id": found, "score": score})

    met = sent.join(packed, ["dim", "block"]).select("queries", "rows")
    each = met.mapInPandas(meet, "query_id long, vec_id long, score long").distinct()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
