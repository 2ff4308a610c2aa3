"""Array scalars in Catalyst: dot, norm, cosine (V4), softmax (M2), clamp (M3).

All accumulate in double. For wide vectors scanned against many queries the
numpy path in ``operators.vectors`` is faster; these are the row-wise forms.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dot(a, b) -> Column:
    prods = F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prods, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a, b) -> Column:
    """V4: ``a.b / (|a| |b|)``; NULL when a norm is zero."""
    den = norm(a) * norm(b)
    return F.when(den > 0, dot(a, b) / den)


def softmax_at(logits, k: int = 0) -> Column:
    """M2: ``softmax(logits)[k]`` computed stably (max subtracted)."""
    lg = F.transform(_c(logits), lambda x: x.cast("double"))
    m = F.array_max(lg)
    den = F.aggregate(lg, F.lit(0.0).cast("double"), lambda acc, x: acc + F.exp(x - m))
    return F.exp(F.element_at(lg, k + 1) - m) / den


def clamp_min(x, lo: float = 1e-9) -> Column:
    """M3: ``max(x, lo)``."""
    return F.greatest(_c(x), F.lit(lo))


def masked_mean_pool(states, mask) -> Column:
    """V1 (array form): ``sum_t(h_t * m_t) / max(sum_t m_t, 1e-9)`` per dim.

    ``states``: ARRAY<ARRAY<FLOAT>> [token][dim]; ``mask``: ARRAY<INT> [token].
    """
    st, mk = _c(states), _c(mask)
    zero = F.transform(F.element_at(st, 1), lambda x: F.lit(0.0).cast("double"))
    weighted = F.zip_with(st, mk, lambda h, m: F.struct(h.alias("h"), m.cast("double").alias("m")))
    # one pass over the tokens: the running sum of all dimensions at once
    sums = F.aggregate(weighted, zero, lambda acc, t: F.zip_with(acc, t["h"], lambda a, x: a + x.cast("double") * t["m"]))
    denom = clamp_min(F.aggregate(mk, F.lit(0.0).cast("double"), lambda a, m: a + m.cast("double")))
    return F.when(F.size(st) > 0, F.transform(sums, lambda s: s / denom))
