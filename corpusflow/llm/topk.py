"""Exact top-k search by inner product over integer vectors, by pivot-table elimination.

Vectors x are lifted by one coordinate sqrt(M^2 - |x|^2) (M the largest norm; 0 for queries), which
turns the largest inner product into the smallest distance. Distances of all rows to a few pivots
are tabulated once per block; the largest difference of two rows' entries bounds their distance
from below, so an inner product from above. Candidates are evaluated in the order of that bound
until the bound is below the k-th best score: exact at any size.

Defined results: vectors that are null, empty or hold null or non-finite components, and rows with
a null id, take no part; only vectors of equal length are compared; rows with the query's own id
are not its candidates; a repeated candidate counts as often as it comes, a query id once (its smallest vector);
ties go to the smaller id; fewer candidates than k give them all; empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import cut_lineage, prepare


def finite(vec: str) -> Column:
    """True for a non-empty vector without null or non-finite components."""
    return F.coalesce((F.size(vec) > 0) & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def quantised(vectors: DataFrame, id_col: str, vec_col: str, scale: int = 1024) -> DataFrame:
    """``id`` and ``y`` = floor(scale * x) of every vector that takes part."""
    double = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("x"))
    return double.where(finite("x") & F.col("id").isNotNull()).select(
        "id", F.transform("x", lambda x: F.floor(x * F.lit(float(scale))).cast("long")).alias("y"))


def choose_pivots(sample: np.ndarray, m: int) -> np.ndarray:
    """Rows of the sample, each the farthest from those before (the first: from the mean)."""
    dist = ((sample - sample.mean(axis=0)) ** 2).sum(axis=1)
    chosen = []
    for _ in range(min(m, len(sample))):
        at = int(dist.argmax())
        chosen.append(at)
        dist = np.minimum(dist, ((sample - sample[at]) ** 2).sum(axis=1)) if len(chosen) > 1 else ((sample - sample[at]) ** 2).sum(axis=1)
    return sample[chosen]


def lifted(y: np.ndarray, most: float) -> np.ndarray:
    return np.column_stack([y, np.sqrt(np.maximum(most - (y * y).sum(axis=1), 0.0))])


def search_block(q_ids, q, c_ids, c, pivots, most: float, k: int, chunk: int = 256):
    """Local top-k of every query among one block's candidates: (query ids, ids, scores, evaluated)."""
    exact = np.float64 if most < 2**52 else np.int64
    qf, cf = q.astype(float), c.astype(float)
    qe, ce = q.astype(exact), c.astype(exact)

    def table(points):
        sq = (points**2).sum(axis=1)[:, None] + (pivots**2).sum(axis=1)[None, :] - 2 * points @ pivots.T
        return np.sqrt(np.maximum(sq, 0.0))

    c_table = table(lifted(cf, most))
    q_table = table(np.column_stack([qf, np.zeros(len(qf))]))
    margin = 1e-6 * (most + 1)
    out, evaluated = [], 0
    for i in range(len(q)):
        low = np.maximum(np.abs(c_table - q_table[i]).max(axis=1) - 1e-6 * np.sqrt(most + 1), 0.0)
        bound = ((qf[i] ** 2).sum() + most - low**2) / 2 + margin
        order = np.argsort(-bound, kind="stable")
        best_s, best_i = np.empty(0, exact), np.empty(0, np.int64)
        for at in range(0, len(order), chunk):
            if len(best_s) >= k and bound[order[at]] < best_s[-1]:
                break
            these = order[at:at + chunk]
            these = these[c_ids[these] != q_ids[i]]
            evaluated += len(these)
            best_s, best_i = np.concatenate([best_s, ce[these] @ qe[i]]), np.concatenate([best_i, c_ids[these]])
            top = np.lexsort((best_i, -best_s))[:k]
            best_s, best_i = best_s[top], best_i[top]
        out.append((np.full(len(best_i), q_ids[i]), best_i, best_s.astype(np.int64)))
    return *(np.concatenate(x) for x in zip(*out)), evaluated


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 10, pivots: int = 32, sample_rows: int = 1024,
          block_rows: int = 8192, query_rows: int = 2048) -> DataFrame:
    """The k best candidates of every query: query_id, rank, vec_id, score.

    Both sides have ``id`` and an integer vector ``y``. Pivots come from at most ``sample_rows``
    rows. Candidates and queries are dealt to blocks by a hash of the id; every pair of a query
    block and a candidate block is one bounded group, whose k best per query go on.
    """
    prepare(queries.sparkSession)
    candidates = cut_lineage(candidates.withColumn("dim", F.size("y")))
    queries = cut_lineage(queries.groupBy("id").agg(F.min("y").alias("y")).withColumn("dim", F.size("y")))
    norm = F.aggregate("y", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    n, most_c = candidates.agg(F.count(F.lit(1)), F.max(norm)).first()
    nq, most_q = queries.agg(F.count(F.lit(1)), F.max(norm)).first()
    most = max(most_c or 0.0, most_q or 0.0)
    sample: dict[int, list] = {}
    for r in candidates.orderBy(F.xxhash64("id"), "id").limit(sample_rows).collect():
        sample.setdefault(r["dim"], []).append(r["y"])
    chosen = {d: choose_pivots(lifted(np.array(rows, dtype=float), most), pivots) for d, rows in sample.items()}
    c_blocks, q_blocks = max(1, -(-n // block_rows)), max(1, -(-nq // query_rows))
    key = ["dim", "cb", "qb"]
    left = (queries.withColumn("qb", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(q_blocks)))
            .withColumn("cb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(c_blocks - 1).cast("long")))))
    right = (candidates.withColumn("cb", F.pmod(F.xxhash64("id"), F.lit(c_blocks)))
             .withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(q_blocks - 1).cast("long")))))

    def pair(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(c):
            return pd.DataFrame({"query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64), "score": np.empty(0, np.int64)})
        dim = int(q["dim"].iloc[0])
        table = chosen.get(dim, np.zeros((1, dim + 1)))  # without a sampled row of this length, the origin
        qi, ci, s, _ = search_block(q["id"].to_numpy(), np.stack(q["y"]), c["id"].to_numpy(), np.stack(c["y"]), table, most, k)
        return pd.DataFrame({"query_id": qi, "vec_id": ci, "score": s})

    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(pair, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
