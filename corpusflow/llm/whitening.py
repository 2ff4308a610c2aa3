"""Embedding whitening by Jacobi-Davidson.

The covariance is never formed. Vectors are centred exactly and multiplied where they lie: a product
of the covariance with a few columns is one job over blocks of rows, of which a ``width x columns``
sum is all that leaves a task, added up by a shuffle. The leading eigenvectors come from a search
space that is expanded by correction equations, solved for all wanted pairs in lock step by MINRES on
the projected operator, and from Rayleigh-Ritz in that space; a pair is locked, and deflated, when its
residual reaches double precision. The driver holds matrices as long as a vector is wide, no rows.

Defined results: a vector that is null, empty or holds a null, non-finite or huge component (2**40 or
more after scaling) has no row; a null id stays null; repeated rows count, and are returned, as often
as they come; of vectors of several widths the most frequent width is taken (ties: the widest), others
have no row; a component whose variance is rounding error (as when vectors are fewer than components,
or all alike) is left out, so a table without spread gives no rows, and so does an empty one; other
columns are ignored. A deviation that does not fit into a long is null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import prepare, written
from .topk import finite

EPS = float(np.finfo(float).eps)
HUGE = float(1 << 40)
BLOCK = pa.schema([("ids", pa.binary()), ("known", pa.binary()), ("x", pa.binary())])
SUMS = pa.schema([("at", pa.int32()), ("total", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("n", pa.int64())])
PART = pa.schema([("at", pa.int32()), ("part", pa.float64())])
ROWS = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
                  ("whitened", pa.float64()), ("explained", pa.float64())])


def integers(vectors: DataFrame, id_col: str, vec_col: str, scale: int, shift: int) -> DataFrame:
    """``id`` and ``x`` = floor(scale * component) + shift of every vector that takes part."""
    double = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    able = double.where(finite("v")).where(F.forall("v", lambda c: F.abs(c) < HUGE / scale))
    return able.select("id", F.transform("v", lambda c: F.floor(c * F.lit(float(scale))).cast("long") + shift).alias("x"))


def blocks_of(rows: DataFrame, width: int, block_rows: int) -> DataFrame:
    """Rows of ``width`` in blocks of a task's ``block_rows``: ids, which ids are known, the matrix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def block():
            ids = pa.concat_arrays([b.column(0) for b in held])
            x = np.concatenate([b.column(1).flatten().to_numpy(zero_copy_only=False) for b in held]).astype("<i8")
            known = np.array(ids.is_valid())
            return pa.RecordBatch.from_arrays(
                [pa.array([v.tobytes()], pa.binary()) for v in (ids.fill_null(0).to_numpy().astype("<i8"), known, x)], schema=BLOCK)

        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= block_rows:
                yield block()
                held, n = [], 0
        if n:
            yield block()

    return rows.where(F.size("x") == width).mapInArrow(run, "ids binary, known binary, x binary")


class Centred:
    """The rows of the blocks less their exact mean, as an operator: products with the covariance."""

    def __init__(self, blocks: DataFrame, width: int):
        self.blocks, self.width = blocks, width

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for raw in batch.column("x"):
                    x = np.frombuffer(raw.as_buffer(), "<i8").reshape(-1, width)
                    out = [np.arange(width), x.sum(axis=0), x.min(axis=0), x.max(axis=0), np.full(width, len(x))]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, SUMS)], schema=SUMS)

        found = (blocks.select("x").mapInArrow(sums, "at int, total long, low long, high long, n long").groupBy("at")
                 .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.min("low").alias("low"),
                      F.max("high").alias("high"), F.sum("n").alias("n")).collect())
        of = {r["at"]: r for r in found}
        self.n = of[0]["n"] if of else 0
        self.total = [int(of[j]["total"]) for j in range(width)] if of else []
        # the mean is whole + rest / n, in integers
        self.whole = np.array([t // self.n for t in self.total], dtype=np.int64)
        self.rest = np.array([t % self.n for t in self.total], dtype=np.int64)
        self.farthest = max((max(of[j]["high"] - w, w - of[j]["low"]) for j, w in enumerate(self.whole.tolist())), default=0)

    def matrix(self) -> Callable[[bytes], np.ndarray]:
        whole, rest, width = self.whole, self.rest / max(self.n, 1), self.width
        return lambda raw: (np.frombuffer(raw, "<i8").reshape(-1, width) - whole) - rest

    def total_over_blocks(self, part: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
        """Sum of ``part`` of every centred block: a task adds up its own blocks, a shuffle the tasks."""
        matrix = self.matrix()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size)
            for batch in batches:
                for raw in batch.column("x"):
                    total += part(matrix(raw.as_buffer())).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], schema=PART)

        out = np.zeros(size)
        for r in self.blocks.select("x").mapInArrow(run, "at int, part double").groupBy("at").agg(F.sum("part").alias("part")).collect():
            out[r["at"]] = r["part"]
        return out

    def covariance_times(self, z: np.ndarray) -> np.ndarray:
        n = self.n
        return self.total_over_blocks(lambda c: c.T @ (c @ z) / n, z.size).reshape(z.shape)

    def trace(self) -> float:
        n = self.n
        return float(self.total_over_blocks(lambda c: np.square(c).sum(axis=0) / n, self.width).sum())


def orthonormal(t: np.ndarray, against: np.ndarray) -> np.ndarray:
    """Orthonormal columns that span what ``t`` adds to the orthonormal columns ``against``."""
    kept = []
    for column in t.T:
        size = np.linalg.norm(column)
        for _ in range(3):  # twice is enough; the third is of rounding error alone
            column = column - against @ (against.T @ column)
            for k in kept:
                column = column - k * (k @ column)
        if size > 0 and np.linalg.norm(column) > 1e-10 * size:
            kept.append(column / np.linalg.norm(column))
    return np.array(kept).T.reshape(len(t), -1)


def minres(apply: Callable[[np.ndarray], np.ndarray], b: np.ndarray, steps: int, tol: float) -> np.ndarray:
    """MINRES for every column of ``b`` in lock step: one application of the operator a step.

    ``apply`` takes the current Lanczos vectors of all columns, each under its own shift. A column
    rests when its residual is below ``tol`` of its right side.
    """
    beta = np.linalg.norm(b, axis=0)
    safe = lambda v: np.where(v == 0, 1.0, v)
    x, v_old, v = np.zeros_like(b), np.zeros_like(b), b / safe(beta)
    w_old, w = np.zeros_like(b), np.zeros_like(b)
    c_old, c, s_old, s = (np.full(b.shape[1], q) for q in (1.0, 1.0, 0.0, 0.0))
    eta, before, start = beta.copy(), np.zeros(b.shape[1]), beta.copy()
    live = beta > 0
    for _ in range(steps):
        if not live.any():
            break
        p = apply(v)
        alpha = (v * p).sum(axis=0)
        p = p - alpha * v - before * v_old
        after = np.linalg.norm(p, axis=0)
        # the new column of the tridiagonal matrix under the last two rotations, and the next rotation
        delta, epsilon = c * alpha - c_old * s * before, s_old * before
        gamma, upper = np.hypot(delta, after), s * alpha + c_old * c * before
        c_new, s_new = np.where(gamma == 0, 1.0, delta / safe(gamma)), after / safe(gamma)
        direction = (v - epsilon * w_old - upper * w) / safe(gamma)
        x = x + np.where(live, c_new * eta, 0.0) * direction
        eta = -s_new * eta
        v_old, v, before = v, p / safe(after), after
        w_old, w, c_old, c, s_old, s = w, direction, c, c_new, s, s_new
        live = live & (np.abs(eta) > tol * start) & (after > 0) & (gamma > 0)
    return x


def jacobi_davidson(times: Callable[[np.ndarray], np.ndarray], width: int, k: int, inner: int = 5,
                    guard: int = 4, outer: int = 200, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and unit eigenvectors of a symmetric operator.

    Ends when every residual is at most ``width`` (16 at least) rounding errors of the largest
    eigenvalue. After ``outer`` expansions without that it raises.
    """
    most = min(width, 4 * (k + guard))
    locked, values = np.zeros((width, 0)), []
    space = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, min(width, k + guard))))[0]
    image = times(space)
    for turn in range(outer):
        theta, turned = np.linalg.eigh((h := space.T @ image) / 2 + h.T / 2)
        order = theta.argsort()[::-1]
        theta, space, image = theta[order], space @ turned[:, order], image @ turned[:, order]
        wanted = k - len(values)
        residual = image[:, :wanted] - space[:, :wanted] * theta[:wanted]
        size = np.linalg.norm(residual, axis=0)
        limit = max(width, 16) * EPS * max([*values[:1], theta[0], 0.0])
        done = 0
        while done < wanted and size[done] <= limit:
            done += 1
        if done:  # lock the leading pairs, in order
            locked, values = np.hstack([locked, space[:, :done]]), [*values, *theta[:done]]
            space, image, theta, residual, wanted = space[:, done:], image[:, done:], theta[done:], residual[:, done:], wanted - done
        if not wanted:
            order = np.argsort(values)[::-1]
            return np.array(values)[order], locked[:, order]
        ritz = np.hstack([locked, space[:, :wanted]])
        away = lambda t, q=ritz: t - q @ (q.T @ t)
        rhs, shift = -away(residual), theta[:wanted]
        t = minres(lambda p: away(times(away(p)) - away(p) * shift), rhs, inner, 2.0 ** -(turn + 1))
        if space.shape[1] + wanted > most:  # restart from the best Ritz vectors
            space, image = space[:, :wanted + guard], image[:, :wanted + guard]
        fresh = orthonormal(t, np.hstack([locked, space]))
        if not fresh.shape[1]:  # nothing new: the products of the space are taken anew, free of rounding
            space = orthonormal(space, locked)
            image = times(space)
            continue
        space, image = np.hstack([space, fresh]), np.hstack([image, times(fresh)])
    raise RuntimeError(f"{len(values)} of {k} eigenvectors after {outer} expansions")


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = 8,
           scale: int = 1024, shift: int = 100_000, block_rows: int = 4096) -> DataFrame:
    """One row per vector and component: vec_id, component (from 1), n, deviation (the sum of
    (n * x - S)**2 over dimensions, exact), whitened, explained and identity_error."""
    spark = vectors.sparkSession
    prepare(spark)
    empty = spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, "
                                      "explained double, identity_error double")
    rows = integers(vectors, id_col, vec_col, scale, shift)
    common = rows.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    if common is None:
        return empty
    width = common["width"]
    blocks = written(blocks_of(rows, width, block_rows), "whitening-blocks")
    centred = Centred(blocks, width)
    trace, n = centred.trace(), centred.n
    if trace <= 0:
        return empty
    value, vector = jacobi_davidson(centred.covariance_times, width, min(components, width))
    real = value > width * EPS * 64 * value[0]
    value, onto = value[real], vector[:, real] / np.sqrt(value[real])
    k = len(value)
    moments = centred.total_over_blocks(lambda c: np.vstack([(y := c @ onto).sum(axis=0), y.T @ y]) / n, (k + 1) * k).reshape(k + 1, k)
    error = float(np.abs(moments[1:] - np.outer(moments[0], moments[0]) - np.eye(k)).max())
    matrix, whole, rest, explained = centred.matrix(), centred.whole, centred.rest, value / trace
    # (n * x - S) = n * (x - whole) - rest; 64 bits hold the sum of squares if this bound does
    small = width * (n * (centred.farthest + 1)) ** 2 < 2**63

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, known, raw in zip(*(batch.column(c) for c in ("ids", "known", "x"))):
                off = np.frombuffer(raw.as_buffer(), "<i8").reshape(-1, width) - whole
                if small:
                    deviation = np.square(n * off - rest).sum(axis=1)
                    fits = np.ones(len(off), dtype=bool)
                else:
                    deviation = [sum((n * a - b) ** 2 for a, b in zip(row, rest.tolist())) for row in off.tolist()]
                    fits = np.array([v < 2**63 for v in deviation])
                    deviation = np.array([v if ok else 0 for v, ok in zip(deviation, fits)], dtype=np.int64)
                y, m = matrix(raw.as_buffer()) @ onto, len(off)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.frombuffer(ids.as_buffer(), "<i8"), k), mask=~np.repeat(np.frombuffer(known.as_buffer(), bool), k)),
                     pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                     pa.array(np.repeat(deviation, k), mask=~np.repeat(fits, k)), pa.array(y.ravel()),
                     pa.array(np.tile(explained, m))], schema=ROWS)

    out = blocks.mapInArrow(run, "vec_id long, component int, n long, deviation long, whitened double, explained double")
    return out.withColumn("identity_error", F.lit(error))
