"""V2 / V2q: attach vectors from an injected embedder.

The embedder is a factory returning ``texts -> (n, dim) array``; it is built
once per task inside an iterator Arrow UDF and called on 128 rows at a time
(the reference's batch size) while Arrow batches stay large.
``hashing_embedder`` (Python) and ``md5_hashing_vectors`` (native) are
deterministic stand-ins for tests and the driver tables (feature hashing of
words); they are not language models.

A model that gives one state per token goes through ``pool_states`` (V1 over
V2): texts are cut at the model's limit, sorted by length within the Arrow
batch so that a model batch is padded to its own longest text only, and the
states are pooled under the attention mask in one array operation; the result
is a flat Arrow array, no object per row. ``digest_states`` is the
deterministic stand-in of such a model.
"""

from __future__ import annotations

import zlib
from functools import partial
from typing import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def hashing_embedder(dim: int = 64) -> Callable[[list[str]], np.ndarray]:
    """Signed feature hashing of lower-cased words, L2-normalised."""

    def embed(texts):
        out = np.zeros((len(texts), dim), dtype=np.float32)
        for i, t in enumerate(texts):
            for w in (t or "").lower().split():
                h = zlib.crc32(w.encode("utf-8"))
                out[i, h % dim] += 1.0 if (h >> 16) & 1 else -1.0
            n = np.linalg.norm(out[i])
            if n > 0:
                out[i] /= n
        return out

    return embed


def resolve(embedder):
    """An embedder factory, or the stand-in that was asked for by name (``hashing``
    or ``hashing:<width>``). There is no silent default model."""
    if isinstance(embedder, str) and embedder.split(":")[0] == "hashing":
        return partial(hashing_embedder, int(embedder.partition(":")[2] or 64))
    if callable(embedder):
        return embedder
    raise ValueError("name an embedder: a factory, or 'hashing' for the stand-in")


# Rows per model call (the reference's batch size); Arrow batches stay large.
MODEL_BATCH = 128


def embed_udf(factory: Callable[[], Callable[[list[str]], np.ndarray]], model_batch: int = MODEL_BATCH):
    """Iterator Arrow UDF ``text -> ARRAY<FLOAT>``; the model loads once per
    task and is called on ``model_batch`` rows at a time (padding inside a
    model batch is the model's concern)."""

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def _embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = factory()
        for s in batches:
            texts = s.fillna("").tolist()
            out = []
            for i in range(0, len(texts), model_batch):
                out.extend(np.asarray(v, dtype=np.float32) for v in model(texts[i:i + model_batch]))
            yield pd.Series(out)

    return _embed


def embed_column(df: DataFrame, text_col: str, factory, out_col: str = "embedding",
                 model_limit: int | None = None) -> DataFrame:
    """V2: ``df`` plus ``out_col`` (V2q is the same on a queries frame).

    With ``model_limit`` (the embedder's own input limit, in words here) a
    ``truncated`` flag reports chunks the model will cut, instead of hiding it.
    """
    from ..session import ship_package
    ship_package(df.sparkSession)
    out = df.withColumn(out_col, embed_udf(factory)(F.col(text_col)))
    if model_limit is not None:
        n = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit("[^ ]+"))
        out = out.withColumn("truncated", n > model_limit)
    return out


class TokenStates:
    """What ``pool_states`` asks of a model: ``tokens(text)`` ids of one text (all of them, or the first
    beyond the limit), ``limit`` the tokens it takes at most, ``states(ids, mask)`` an array (texts, tokens, width) for padded ids and their mask."""

    limit: int = 512
    width: int

    def tokens(self, text: str) -> list[int]:
        raise NotImplementedError

    def states(self, ids: np.ndarray, mask: np.ndarray) -> np.ndarray:
        raise NotImplementedError


class DigestStates(TokenStates):
    """Stand-in: a token is a word, its state the digits of its digest. Padding has a state, too, that
    a pooling without the mask would take in."""

    def __init__(self, width: int = 16, limit: int = 64):
        self.width, self.limit = width, limit
        self.number: dict[str, int] = {}
        self.table = np.full((1024, width), 100.0)  # number 0 is padding

    def tokens(self, text: str) -> list[int]:
        import hashlib
        ids = []
        for word in text.split()[:self.limit + 1]:  # one beyond the limit tells that the text is cut
            at = self.number.get(word)
            if at is None:
                at = self.number[word] = len(self.number) + 1
                if at == len(self.table):
                    self.table = np.concatenate([self.table, np.empty_like(self.table)])
                self.table[at] = [int(c, 16) - 7.5 for c in hashlib.md5(word.encode()).hexdigest()[:self.width]]
            ids.append(at)
        return ids

    def states(self, ids: np.ndarray, mask: np.ndarray) -> np.ndarray:
        return self.table[ids]


def digest_states(width: int = 16, limit: int = 64) -> TokenStates:
    return DigestStates(width, limit)


def pooled(model: TokenStates, texts: list[str], model_batch: int = MODEL_BATCH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Masked means of the token states of texts (M3: no token gives zeros), tokens taken, and whether
    the limit cut the text."""
    ids = [model.tokens(t) for t in texts]
    lengths = np.array([len(i) for i in ids], dtype=np.int64)
    taken = np.minimum(lengths, model.limit)
    out = np.zeros((len(texts), model.width))
    order = np.argsort(taken, kind="stable")  # equal lengths beside each other: little padding
    for at in range(0, len(order), model_batch):
        rows = order[at:at + model_batch]
        longest = int(taken[rows].max())
        if not longest:
            continue
        mask = np.arange(longest)[None, :] < taken[rows][:, None]
        padded = np.zeros(mask.shape, dtype=np.int64)
        padded[mask] = np.concatenate([np.asarray(ids[i][:model.limit], dtype=np.int64) for i in rows])
        states = model.states(padded, mask)
        out[rows] = np.einsum("ntd,nt->nd", states, mask.astype(float)) / np.maximum(mask.sum(axis=1), 1e-9)[:, None]
    return out, taken, lengths > model.limit


def pool_states(df: DataFrame, text_col: str, factory: Callable[[], TokenStates] = digest_states, out_col: str = "pooled",
                model_batch: int = MODEL_BATCH) -> DataFrame:
    """V2 + V1: ``df`` with ``out_col`` = struct<embedding array<double>, n_tokens int, truncated boolean>.
    A null or empty text has no token and the zero vector. The model is loaded once per task."""
    from ..session import ship_package
    ship_package(df.sparkSession)

    @F.arrow_udf("embedding array<double>, n_tokens int, truncated boolean")
    def states(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = factory()
        for texts in batches:
            vectors, taken, cut = pooled(model, [t or "" for t in texts.to_pylist()], model_batch)
            ends = np.arange(len(vectors) + 1, dtype=np.int32) * model.width
            flat = pa.ListArray.from_arrays(pa.array(ends), pa.array(vectors.ravel()))
            yield pa.StructArray.from_arrays([flat, pa.array(taken.astype(np.int32)), pa.array(cut)], names=["embedding", "n_tokens", "truncated"])

    return df.withColumn(out_col, states(F.col(text_col)))


def md5_hashing_vectors(df: DataFrame, id_col: str, text_col: str, dim: int = 64) -> DataFrame:
    """Deterministic stand-in embedder written natively (reproducible in SQL):
    signed feature hashing of lower-cased words by ``md5``, L2-normalised.

    Relational, so it scales with the text: words are exploded once, hashed
    once, reduced per (id, bucket) with a partial aggregate, and each id's
    ``dim`` buckets (bounded by ``dim``) are assembled into one vector.
    Ids without any word get no vector.
    """
    from ..functions.text import WS
    words = (df.select(id_col, F.explode(F.split(F.lower(F.col(text_col)), WS + "+")).alias("w"))
               .where(F.length("w") > 0))
    h = F.md5("w")
    bucket = (F.conv(F.substring(h, 1, 2), 16, 10).cast("int") % dim).alias("bucket")
    sign = F.when(F.conv(F.substring(h, 3, 1), 16, 10).cast("int") % 2 == 0, F.lit(1.0)).otherwise(F.lit(-1.0))
    per = words.groupBy(id_col, bucket).agg(F.sum(sign).alias("v"))
    m = per.groupBy(id_col).agg(F.map_from_entries(F.collect_list(F.struct("bucket", "v"))).alias("_m"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda d: F.coalesce(F.try_element_at("_m", d), F.lit(0.0)))
    vec = m.select(id_col, dense.alias("_d"))
    norm = F.sqrt(F.aggregate("_d", F.lit(0.0), lambda a, x: a + x * x))
    return vec.select(id_col, F.when(norm > 0, F.transform("_d", lambda x: x / norm)).alias("embedding")) \
              .where(F.col("embedding").isNotNull())
