"""V1, V3, V4, K0, SC10, SC11, A2, A3: vector search and collection scans.

Exact nearest neighbours without a Cartesian product and without a collect:
queries are packed into blocks of bounded bytes, points into chunks, both as
rows holding one matrix. Every chunk meets every block through an equi-join on
(width, block, salt); Spark broadcasts the blocks when they are small by its own
size check, and the salt spreads them where they are not. A task scores a chunk
against slices of a block, keeps a running top-k per query and emits at most
``k`` rows per query and flush; ``row_number() <= k`` per query finishes (a
partial top-k before the shuffle). Payload columns are joined to the winners.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, ship_package

# Bytes of one query block's matrix, and of one slice of scores in a task.
BLOCK_BYTES = 8 * 1024 * 1024
SCORE_BYTES = 32 * 1024 * 1024
CHUNK_ROWS = 2048
# Running candidates a task holds before it passes them on.
HELD_ROWS = 1_000_000


def scorable(vec, metric: str = "cosine") -> Column:
    """A vector that can be scored: not empty, no NULL or non-finite value, and
    for cosine (V4) not zero. Others have no similarity and are left out."""
    v = F.col(vec) if isinstance(vec, str) else vec
    ok = (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    if metric == "cosine":
        ok = ok & F.exists(v, lambda x: x != 0)
    return F.coalesce(ok, F.lit(False))


def _best(cols, ids, scores, k):
    """At most ``k`` entries per query column, best score first, ties by id."""
    rank = np.empty(len(ids), dtype=np.int64)
    rank[np.argsort(ids, kind="stable")] = np.arange(len(ids))
    order = np.lexsort((rank, -scores, cols))
    cols = cols[order]
    first = np.flatnonzero(np.append(True, cols[1:] != cols[:-1]))
    place = np.arange(len(cols)) - np.repeat(first, np.diff(np.append(first, len(cols))))
    keep = order[place < k]
    return cols[place < k], ids[keep], scores[keep]


def _unit_rows(m):
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def _score_blocks(k, metric):
    def run(it):
        held: dict = {}  # block -> (its query ids, columns, ids, scores)

        def emit():
            for qids, cols, ids, scores in held.values():
                yield pd.DataFrame({"query_id": qids[cols], "id": ids, "score": scores})
            held.clear()

        for pdf in it:
            for row in pdf.itertuples(index=False):
                x = np.frombuffer(row.mat).reshape(-1, row.dim)
                q = np.frombuffer(row.qmat).reshape(-1, row.dim)
                ids, qids = np.asarray(row.ids), np.asarray(row.qids)
                if metric == "cosine":
                    x, q = _unit_rows(x), _unit_rows(q)
                kk, step = min(k, len(x)), max(1, SCORE_BYTES // (8 * len(x)))
                for at in range(0, len(q), step):
                    s = x @ q[at:at + step].T
                    low = np.partition(s, len(x) - kk, axis=0)[len(x) - kk]
                    r, c = np.nonzero(s >= low[None, :])  # ties kept
                    c2, i2, s2 = c + at, ids[r], s[r, c]
                    key = (row.dim, row.qb)
                    if key in held:
                        _, c0, i0, s0 = held[key]
                        c2, i2, s2 = np.concatenate([c0, c2]), np.concatenate([i0, i2]), np.concatenate([s0, s2])
                    held[key] = (qids, *_best(c2, i2, s2, k))
                if sum(len(h[1]) for h in held.values()) > HELD_ROWS:
                    yield from emit()
        yield from emit()

    return run


def topk_search(points: DataFrame, queries: DataFrame, k: int, id_col: str = "point_id",
                vec_col: str = "embedding", qid_col: str = "query_id", qvec_col: str = "embedding",
                metric: str = "cosine", payload: list[str] | None = None,
                block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """V3 / K0: the ``k`` best points per query, best first, ties by id.

    Returns ``query_id, rank, <id_col>, score, <payload...>``. Point ids are
    unique. Vectors that cannot be scored (``scorable``), or whose width is not
    the query's, are in no result.
    """
    payload = [c for c in payload or [] if c != id_col]
    spark = points.sparkSession
    ship_package(spark)
    qsel = queries.select(F.col(qid_col).alias("query_id"), F.col(qvec_col).cast("array<double>").alias("v"))
    # the query side is derived once (it may itself be an aggregate over the points)
    qsel = cut_lineage(qsel.where(scorable("v", metric)).withColumn("dim", F.size("v")))
    n_q, widest = qsel.agg(F.count(F.lit(1)), F.coalesce(F.max("dim"), F.lit(1))).first()
    n_blocks = max(1, -(-n_q * widest * 8 // block_bytes))
    salts = spark.sparkContext.defaultParallelism

    def typed(field, t):
        return T.StructField(field, t)

    id_type, qid_type = points.schema[id_col].dataType, qsel.schema["query_id"].dataType
    block_schema = T.StructType([typed("dim", T.IntegerType()), typed("qb", T.LongType()),
                                 typed("qids", T.ArrayType(qid_type)), typed("qmat", T.BinaryType())])
    chunk_schema = T.StructType([typed("dim", T.IntegerType()), typed("salt", T.IntegerType()),
                                 typed("ids", T.ArrayType(id_type)), typed("mat", T.BinaryType())])

    def block(pdf):
        return pd.DataFrame({"dim": pdf["dim"].iloc[:1], "qb": pdf["qb"].iloc[:1], "qids": [pdf["query_id"].tolist()],
                             "qmat": [np.stack(pdf["v"]).astype(np.float64).tobytes()]})

    def chunk(it):
        n = 0
        for pdf in it:
            for dim, own in pdf.groupby("dim"):
                for at in range(0, len(own), CHUNK_ROWS):
                    part = own.iloc[at:at + CHUNK_ROWS]
                    n += 1
                    yield pd.DataFrame({"dim": [dim], "salt": [n % salts], "ids": [part["id"].tolist()],
                                        "mat": [np.stack(part["v"]).astype(np.float64).tobytes()]})

    blocks = (qsel.withColumn("qb", F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)))
                  .groupBy("dim", "qb").applyInPandas(block, block_schema))
    blocks = blocks.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    pts = points.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    chunks = (pts.where(scorable("v", metric)).withColumn("dim", F.size("v")).mapInPandas(chunk, chunk_schema)
                 .withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long")))))
    pairs = chunks.join(blocks, ["dim", "qb", "salt"]).select("dim", "qb", "ids", "mat", "qids", "qmat")
    out = T.StructType([typed("query_id", qid_type), typed("id", id_type), typed("score", T.DoubleType())])
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("id").asc())
    ranked = (pairs.mapInPandas(_score_blocks(k, metric), out)
                   .withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
                   .select("query_id", "rank", F.col("id").alias(id_col), "score"))
    if payload:
        ranked = ranked.join(points.select(id_col, *payload), id_col)
    return ranked.select("query_id", "rank", id_col, "score", *payload)


# Groups a task sums before it passes its partial sums on.
MAX_GROUPS = 50_000


def centroids(points: DataFrame, group_col: str, vec_col: str = "embedding",
              mask: Column | None = None) -> DataFrame:
    """V1 over rows: masked mean of the vectors of each group, clamped
    denominator (M3), in long form ``(group, dim, value)``.

    Two phases: each task sums its rows per group with numpy (one
    vectorised add per Arrow batch) and emits one partial vector per group;
    only those partials are exploded and reduced per (group, dim). A group
    holding a third of all rows is therefore summed inside every task, never
    shipped whole, and no per-element hash aggregation runs on raw vectors.
    """
    ship_package(points.sparkSession)
    m = (mask if mask is not None else F.lit(1)).cast("double")
    src = points.select(F.col(group_col).alias("_g"), F.col(vec_col).alias("_v"), m.alias("_m"))
    gtype = points.schema[group_col].dataType
    part_schema = T.StructType([T.StructField("_g", gtype), T.StructField("_sum", T.ArrayType(T.DoubleType())),
                                T.StructField("_msum", T.DoubleType())])

    def partials(acc):
        out = pd.DataFrame({"_g": list(acc.keys()), "_sum": [v[0] for v in acc.values()],
                            "_msum": [v[1] for v in acc.values()]})
        acc.clear()
        return out

    def partial(it):
        acc: dict = {}
        for pdf in it:
            if pdf.empty:
                continue
            w = pdf["_m"].to_numpy(dtype=np.float64)
            for g, idx in pdf.groupby("_g", dropna=False, sort=False).indices.items():
                X = np.vstack([np.asarray(v, dtype=np.float64) for v in pdf["_v"].to_numpy()[idx]])
                s_, ms = (X * w[idx, None]).sum(axis=0), float(w[idx].sum())
                key = None if (isinstance(g, float) and np.isnan(g)) else g
                if key in acc:
                    acc[key][0] += s_
                    acc[key][1] += ms
                else:
                    acc[key] = [s_, ms]
            if len(acc) > MAX_GROUPS:  # many small groups (one per chunk): pass them on
                yield partials(acc)
        if acc:
            yield partials(acc)

    parts = src.mapInPandas(partial, part_schema)
    ex = parts.select("_g", "_msum", F.posexplode("_sum").alias("dim", "_s"))
    red = ex.groupBy("_g", "dim").agg(F.sum("_s").alias("_s"), F.sum("_msum").alias("_msum"))
    return red.select(F.col("_g").alias(group_col), "dim",
                      (F.col("_s") / F.greatest(F.col("_msum"), F.lit(1e-9))).alias("value"))


def centroid_vectors(long_form: DataFrame, group_col: str) -> DataFrame:
    """Long ``(group, dim, value)`` back to one ``ARRAY<DOUBLE>`` per group
    (each group holds ``dim`` rows: bounded by the vector width)."""
    g = long_form.groupBy(group_col).agg(F.array_sort(F.collect_list(F.struct("dim", "value"))).alias("_s"))
    return g.select(group_col, F.transform("_s", lambda s: s["value"]).alias("embedding"))


def scroll(points: DataFrame, source_col: str, source, id_col: str = "point_id",
           limit: int = 300, offset=None) -> DataFrame:
    """SC10 / L1: one page of a source's points in id order plus the next
    offset (keyset paging: the next call passes ``offset`` = that id).
    ``orderBy().limit()`` plans as TakeOrderedAndProject (per-task top-n)."""
    p = points.where(F.col(source_col) == source)
    if offset is not None:
        p = p.where(F.col(id_col) >= offset)
    # one scan: the windows run over the limit + 1 rows of the page
    page = p.orderBy(id_col).limit(limit + 1).withColumn("_rn", F.row_number().over(Window.orderBy(id_col)))
    after = F.max(F.when(F.col("_rn") > limit, F.col(id_col))).over(Window.partitionBy())
    return page.withColumn("next_offset", after).where(F.col("_rn") <= limit).drop("_rn")


def iter_pages(points: DataFrame, source_col: str, source, id_col: str = "point_id", limit: int = 300):
    """SC10 keyset walk: yields successive pages (DataFrames of at most
    ``limit`` rows) of one source in id order. Each step is a bounded top-n
    job; only the next offset (one scalar) comes back to the driver."""
    offset = None
    while True:
        page = cut_lineage(scroll(points, source_col, source, id_col=id_col, limit=limit, offset=offset))
        yield page.drop("next_offset")
        nxt = page.select(F.max("next_offset")).first()[0]
        if nxt is None:
            return
        offset = nxt


def page_index(points: DataFrame, source_col: str = "source", id_col: str = "point_id", limit: int = 300) -> DataFrame:
    """SC10 for whole sources: ``source, page`` (from 0), ``first_id, last_id, n_rows`` of every page of
    ``limit`` points in id order, from one pass over the ids.

    Ids are range-partitioned by (source, id), so a source of any size is spread over many tasks; a
    point's place is its rank within its part plus the rows of its source in the parts before, a prefix
    sum over one row per source and part. Ids are unique within a source; rows without one are in no
    page. The index has one row per page and can be stored; ``read_page`` then reads any page alone.
    """
    ids = points.select(F.col(source_col), F.col(id_col).alias("_id")).where(F.col("_id").isNotNull())
    ranged = cut_lineage(ids.repartitionByRange(source_col, "_id").withColumn("_part", F.spark_partition_id()))
    part = ranged.groupBy(source_col, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(source_col).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = part.select(F.col(source_col).alias("_s"), F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(source_col, "_part").orderBy("_id"))
    placed = ranged.withColumn("_rank", inside).join(offsets, F.col(source_col).eqNullSafe(F.col("_s")) & (F.col("_part") == F.col("_p")))
    page = F.floor((F.col("_before") + F.col("_rank") - 1) / limit).cast("bigint")
    return placed.groupBy(source_col, page.alias("page")).agg(F.min("_id").alias("first_id"), F.max("_id").alias("last_id"), F.count(F.lit(1)).alias("n_rows"))


def read_page(points: DataFrame, index: DataFrame, source, page: int, source_col: str = "source", id_col: str = "point_id") -> DataFrame:
    """One page of a source in id order: its bounds are looked up, then one pruned read (the source's
    folder, the id range pushed to the scan). A page that is not there is empty."""
    at = index.where((F.col(source_col) == source) & (F.col("page") == page)).select("first_id", "last_id").first()
    if at is None:
        return points.limit(0)
    return points.where((F.col(source_col) == source) & F.col(id_col).between(at["first_id"], at["last_id"])).orderBy(id_col)


def count_points(points: DataFrame) -> DataFrame:
    """SC11 / A3."""
    return points.agg(F.count(F.lit(1)).alias("n_points"))
