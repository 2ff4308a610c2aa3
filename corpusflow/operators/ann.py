"""V3, approximate mode: locality-sensitive hashing of unit vectors, exact re-scoring.

Every table cuts the sphere by a few planes through the origin; the sides a vector lies on
are its bucket. A query probes its own bucket of each table and those across its nearest
planes. Points and probes meet in an equi-join on the bucket, on ids alone; each pair that
met is scored once, exactly, so a row is right wherever it is found, and only recall is
approximate. The planes follow from a rule (signs by the digest of table, plane and
dimension), so an index can be stored and extended, and SQL can give the same rows.

More tables and probes raise recall, more planes a table lower the pairs that are scored.
Recall is high at little cost where near points are much nearer than others; among vectors
without structure the same recall takes a larger share of all pairs (measured in the README).
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship_package
from .vectors import scorable

TABLES, PLANES, PROBES = 24, 8, 6


@functools.lru_cache(maxsize=16)
def planes(dim: int, tables: int, per_table: int) -> np.ndarray:
    """Columns of +1 / -1 (``dim`` x ``tables * per_table``) by the parity of a digest's first digit."""
    sign = lambda t, p, d: 1.0 if int(hashlib.md5(f"{t}-{p}-{d}".encode()).hexdigest()[0], 16) % 2 == 0 else -1.0
    return np.array([[sign(t, p, d) for t in range(tables) for p in range(per_table)] for d in range(dim)])


def _buckets(vectors: pd.Series, tables: int, per_table: int, probes: int) -> pd.Series:
    """Bucket numbers (the table above the sides) of each vector, with those of its probes."""
    out: list = [None] * len(vectors)
    by_dim: dict[int, list[int]] = {}
    for i, v in enumerate(vectors):
        by_dim.setdefault(len(v), []).append(i)
    weight = 1 << np.arange(per_table)
    above = np.arange(tables, dtype=np.int64)[None, :] << 32
    for dim, rows in by_dim.items():
        x = np.stack([np.asarray(vectors.iat[i], dtype=np.float64) for i in rows])
        side = (x @ planes(dim, tables, per_table)).reshape(len(rows), tables, per_table)
        own = (side >= 0) @ weight
        nearest = np.argsort(np.abs(side), axis=2)[:, :, :probes]
        found = [above + own] + [above + (own ^ weight[nearest[:, :, k]]) for k in range(min(probes, per_table))]
        for i, keys in zip(rows, np.concatenate(found, axis=1)):
            out[i] = keys
    return pd.Series(out, dtype=object)


def _hashed(vec: str, tables: int, per_table: int, probes: int):
    @F.pandas_udf("array<bigint>")
    def buckets(v: pd.Series) -> pd.Series:
        return _buckets(v, tables, per_table, probes)

    return buckets(F.col(vec))


def lsh_index(points: DataFrame, id_col: str = "point_id", vec_col: str = "embedding",
              tables: int = TABLES, per_table: int = PLANES) -> DataFrame:
    """The index: ``bucket, dim, id`` of every point that can be scored by cosine. It can be stored
    and appended to; the rule of the planes is fixed."""
    ship_package(points.sparkSession)
    able = points.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v")).where(scorable("v"))
    return able.select(F.explode(_hashed("v", tables, per_table, 0)).alias("bucket"), F.size("v").alias("dim"), "id")


def approx_topk(points: DataFrame, queries: DataFrame, k: int, id_col: str = "point_id", vec_col: str = "embedding",
                qid_col: str = "query_id", qvec_col: str = "embedding", index: DataFrame | None = None,
                tables: int = TABLES, per_table: int = PLANES, probes: int = PROBES) -> DataFrame:
    """At most ``k`` points per query by cosine among those that share a bucket with it, best first,
    ties by id: ``query_id, rank, <id_col>, score``. ``index``: a stored ``lsh_index`` of the same
    tables. Vectors that cannot be scored are in no result; point and query ids are unique."""
    ship_package(points.sparkSession)
    index = lsh_index(points, id_col, vec_col, tables, per_table) if index is None else index
    asked = queries.select(F.col(qid_col).alias("query_id"), F.col(qvec_col).cast("array<double>").alias("q")).where(scorable("q"))
    probed = asked.select("query_id", F.size("q").alias("dim"), F.explode(_hashed("q", tables, per_table, probes)).alias("bucket"))
    # ids alone meet in the buckets; a pair that meets in several tables is one
    met = probed.join(index, ["bucket", "dim"]).select("query_id", "id").distinct()
    pts = points.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    square = lambda c: F.aggregate(c, F.lit(0.0), lambda s, x: s + x * x)
    dot = F.aggregate(F.zip_with("q", "v", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    scored = met.join(asked, "query_id").join(pts, "id").select("query_id", "id", (dot / (F.sqrt(square("q")) * F.sqrt(square("v")))).alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("id").asc())
    return (scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(id_col), "score"))
