"""Embedding near-dedup by PCA-ordered tiled comparison.

Unit vectors are rotated onto principal axes, which leaves cosines as they are. Two tiles are
compared a slice of leading dimensions at a time: the partial products plus the product of the
suffix norms bounds the cosine, rows and columns that cannot reach the threshold are dropped after
each slice, and a pair of tiles without any is given up. What is left is decided by the cosine of
the vectors as given, in double precision. A cosine of t also bounds the difference of the first
coordinate by sqrt(2 - 2t), so tiles of cells farther apart than that are never paired. Tiles meet
in pairs of blocks of 16, which bounds what one group holds (two blocks of vectors) and how often a
tile is sent.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and
rows with a null label or id, link with nothing; only vectors of equal length are compared; equal
vectors of a label are one class, compared once and counted as often as they come (repeated rows
too); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import connected_components, cut_lineage, prepare
from .topk import finite

SLICES = 4


def principal_axes(sample: np.ndarray) -> np.ndarray:
    """Orthonormal columns by falling second moment of the unit vectors of a sample."""
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    _, axes = np.linalg.eigh(unit.T @ unit)
    return axes[:, ::-1]


def linked(a: np.ndarray, b: np.ndarray, axes: np.ndarray, threshold: float) -> np.ndarray:
    """Boolean matrix: cosine of row i of a and row j of b is at least the threshold."""
    na, nb = np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)
    ua, ub = (a / na[:, None]) @ axes, (b / nb[:, None]) @ axes
    out = np.zeros((len(a), len(b)), dtype=bool)
    rows, cols = np.arange(len(a)), np.arange(len(b))
    part = np.zeros(out.shape)
    cuts = np.linspace(0, a.shape[1], SLICES + 1).astype(int)
    for i, j in zip(cuts[:-1], cuts[1:]):
        part += ua[rows, i:j] @ ub[cols, i:j].T
        rest = np.linalg.norm(ua[rows, j:], axis=1)[:, None] * np.linalg.norm(ub[cols, j:], axis=1)[None, :]
        able = part + rest >= threshold - 1e-9
        r, c = able.any(axis=1), able.any(axis=0)
        if not r.any():
            return out
        part, rows, cols, able = part[np.ix_(r, c)], rows[r], cols[c], able[np.ix_(r, c)]
    exact = (a[rows] @ b[cols].T) / (na[rows][:, None] * nb[cols][None, :])
    out[np.ix_(rows, cols)] = able & (exact >= threshold)
    return out


def local_roots(adjacent: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest id that rows (ids a) and columns (ids b) reach within a bipartite adjacency."""
    none = np.iinfo(np.int64).max
    while True:
        to_a = np.minimum(a, np.where(adjacent, b[None, :], none).min(axis=1))
        to_b = np.minimum(b, np.where(adjacent, to_a[:, None], none).min(axis=0))
        if (to_a == a).all() and (to_b == b).all():
            return a, b
        a, b = to_a, to_b


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    threshold: float = 0.93, tile_rows: int = 512, block_tiles: int = 16, sample_rows: int = 4096) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id. The axes come from at most
    ``sample_rows`` vectors, which affects speed only."""
    spark = vectors.sparkSession
    prepare(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
                          F.col(vec_col).cast("array<double>").alias("v"))
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    able = F.coalesce(finite("v") & F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (square > 0) & (square < float("inf")), F.lit(False))
    classes = cut_lineage(rows.where(able).groupBy("label", "v").agg(F.min("vec_id").alias("cid"), F.count(F.lit(1)).alias("copies"))
                          .withColumn("dim", F.size("v")))
    sample: dict[int, list] = {}
    for r in classes.orderBy(F.xxhash64("cid"), "cid").limit(sample_rows).select("dim", "v").collect():
        sample.setdefault(r["dim"], []).append(r["v"])
    axes = {d: principal_axes(np.array(v)) for d, v in sample.items()}

    # cells of the first coordinate, each dealt to tiles of about tile_rows by a hash of the id
    width = float(np.sqrt(2 - 2 * threshold)) * (1 + 1e-9) + 1e-9
    first = F.lit(0.0)
    for d, a in axes.items():
        along = F.aggregate(F.zip_with("v", F.array(*map(F.lit, a[:, 0].tolist())), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
        first = F.when(F.col("dim") == d, along).otherwise(first)
    square_of_class = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    celled = classes.withColumn("cell", F.floor(first / F.sqrt(square_of_class) / width))
    group = ["label", "dim", "cell"]
    cells = cut_lineage(celled.groupBy(*group).agg(F.ceil(F.count(F.lit(1)) / tile_rows).cast("long").alias("tiles")))
    tile = celled.join(cells, group).withColumn("tile", F.pmod(F.xxhash64("cid"), F.col("tiles")))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        v = np.stack(pdf["v"])
        if np.array_equal(v.astype(np.float32), v):  # exactly as given, in half the bytes
            v = v.astype(np.float32)
        return pd.DataFrame({"label": pdf["label"].iloc[:1], "dim": pdf["dim"].iloc[:1], "cell": pdf["cell"].iloc[:1], "tile": pdf["tile"].iloc[:1],
                             "ids": [pdf["cid"].to_numpy(np.int64).tobytes()], "copies": [pdf["copies"].to_numpy(np.int64).tobytes()], "rows": [v.tobytes()]})

    label_type = rows.schema["label"].dataType.simpleString()
    tiles = cut_lineage(tile.groupBy(*group, "tile").applyInPandas(
        pack, f"label {label_type}, dim int, cell long, tile long, ids binary, copies binary, rows binary"))
    # blocks of tiles are paired, so a tile is sent once per pair of blocks, not once per pair of tiles
    tiles = tiles.withColumn("block", F.floor(F.col("tile") / block_tiles))
    blocks = cells.select(*group, F.ceil(F.col("tiles") / block_tiles).alias("blocks"))
    zero = F.lit(0).cast("long")
    spread = blocks.select(*group, "blocks", F.explode(F.sequence(zero, F.col("blocks") - 1)).alias("block"))
    same = spread.select(*group, "block", F.col("cell").alias("cell_b"), F.explode(F.sequence("block", F.col("blocks") - 1)).alias("block_b"))
    above = blocks.select("label", "dim", (F.col("cell") - 1).alias("cell"), F.col("blocks").alias("others"))
    beside = (spread.join(above, group)
              .select(*group, "block", (F.col("cell") + 1).alias("cell_b"), F.explode(F.sequence(zero, F.col("others") - 1)).alias("block_b")))
    pairs = same.unionByName(beside)
    pair = [*group, "block", "cell_b", "block_b"]
    payload = ["ids", "copies", "rows"]
    one = pairs.join(tiles, [*group, "block"]).select(*pair, F.lit(0).alias("side"), *payload)
    other = tiles.select("label", "dim", F.col("cell").alias("cell_b"), F.col("block").alias("block_b"), *payload)
    two = (pairs.where("cell <> cell_b or block <> block_b").join(other, ["label", "dim", "cell_b", "block_b"])
           .select(*pair, F.lit(1).alias("side"), *payload))

    def unpacked(f: pd.DataFrame, dim: int) -> list[tuple]:
        out = []
        for ids, copies, rows in zip(f["ids"], f["copies"], f["rows"]):
            ids, copies = np.frombuffer(ids, np.int64), np.frombuffer(copies, np.int64)
            kind = np.float32 if len(rows) == 4 * dim * len(ids) else np.float64
            out.append((ids, copies, np.frombuffer(rows, kind).reshape(len(ids), dim)))
        return out

    def compare(f: pd.DataFrame) -> pd.DataFrame:
        """All pairs of tiles of a pair of blocks (of one block with itself: each pair once)."""
        dim = int(f["dim"].iloc[0])
        left, right = (unpacked(f[f["side"] == k], dim) for k in (0, 1))
        turn = axes.get(dim, np.eye(dim))
        got: list[tuple] = []
        for i, (ia, ka, va) in enumerate(left):
            for j, (ib, kb, vb) in enumerate(right or left):
                own = not right and i == j
                if not right and j < i:
                    continue
                near = linked(va.astype(float), vb.astype(float), turn, threshold)
                if own:
                    near |= near.T
                    np.fill_diagonal(near, False)
                if not near.any():
                    continue
                root_a, root_b = local_roots(near, ia, ib)
                for ids, links, root in [(ia, near @ kb, root_a)] + ([] if own else [(ib, ka @ near, root_b)]):
                    got.append((ids[links > 0], links[links > 0], root[links > 0]))
        columns = [np.concatenate(x) for x in zip(*got)] if got else [np.empty(0, np.int64)] * 3
        return pd.DataFrame(dict(zip(("cid", "links", "root"), columns)))

    found = cut_lineage(one.unionByName(two).groupBy(*pair).applyInPandas(compare, "cid long, links long, root long"))
    counted = found.groupBy("cid").agg(F.sum("links").alias("links"))
    roots = connected_components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    decided = (classes.select("label", "v", "cid", "copies").join(counted, "cid", "left").join(roots, F.col("cid") == F.col("node"), "left")
               .select("label", "v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "cid").alias("component_id")))
    return (rows.where(able).join(decided, ["label", "v"]).select("vec_id", "n_links", "component_id")
            .unionByName(rows.where(~able).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))))
