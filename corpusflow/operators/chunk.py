"""C1 / AR1: cut article bodies into token-budgeted chunks and fan them out.

Two counters:

* ``word`` (default, pure Catalyst): a token is a run of non-space
  characters with the spaces around it (after T6 the only whitespace left is
  the single space), so the chunks concatenate back to the input exactly
  (``trim_chunks=False``) and every chunk holds at most ``budget`` words.
* an injected token counter (``token_chunk_udf``, ``token_chunks``): greedy
  packing by the largest semantic level that fits (lines, sentences, words,
  then grapheme clusters: a letter with its marks or a composed emoji is never
  cut, even if it is over the budget by itself). A counter that adds up over
  pieces (``additive``) is asked once per piece, and chunks are found in the
  prefix sums; of any other the joined candidate is counted, because real
  tokenizers are not additive. Runs as an Arrow UDF: one article at a time in
  a Python worker, which holds the chunks of a bounded slice of its batch
  (``functions/batches.py``). Counters go by name (``counter``) or are given
  as a factory.

Empty content gives no chunk, so such an article vanishes on the explode,
like the reference loop.
"""

from __future__ import annotations

import functools
import re
from typing import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.batches import sliced

# Chunk budget of the reference (tokens per chunk).
DEFAULT_BUDGET = 512

_WORD_TOKEN = r" *[^ ]+ *"


def word_tokens(content) -> Column:
    """ARRAY<STRING> of word tokens (each with its surrounding spaces)."""
    c = F.col(content) if isinstance(content, str) else content
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(_WORD_TOKEN), 0)


def chunks_from_tokens(toks: Column, budget: int = DEFAULT_BUDGET) -> Column:
    """Chunks of at most ``budget`` tokens; ``toks`` should be a column
    reference (a lambda body re-evaluates any expression it holds)."""
    n = F.size(toks)
    n_chunks = F.floor((n + F.lit(budget - 1)) / F.lit(budget)).cast("int")
    idx = F.sequence(F.lit(0), n_chunks - 1)
    return F.when(n == 0, F.array().cast("array<string>")).otherwise(
        F.transform(idx, lambda i: F.array_join(F.slice(toks, i * budget + 1, budget), "")))


def word_chunk_array(content, budget: int = DEFAULT_BUDGET) -> Column:
    """ARRAY<STRING> of chunks of at most ``budget`` words (Catalyst only).
    Prefer ``word_chunks`` on a DataFrame: it evaluates the tokens once."""
    return chunks_from_tokens(word_tokens(content), budget)


def word_chunk_count(content, budget: int = DEFAULT_BUDGET) -> Column:
    """Number of chunks the word chunker makes: ``ceil(words / budget)``,
    counted without building any chunk string (A1 on raw text)."""
    c = F.col(content) if isinstance(content, str) else content
    n = F.regexp_count(F.coalesce(c, F.lit("")), F.lit("[^ ]+"))
    return F.floor((n + F.lit(budget - 1)) / F.lit(budget)).cast("int")


def explode_chunks(df: DataFrame, chunks: Column, keep: list[str],
                   idx_col: str = "chunk_idx", out_col: str = "content") -> DataFrame:
    """AR1: one row per chunk, carrying ``keep`` columns (title, date, ...)."""
    return df.select(*keep, F.posexplode(chunks).alias(idx_col, out_col))


def word_chunks(df: DataFrame, content: str = "content", keep: list[str] | None = None,
                budget: int = DEFAULT_BUDGET) -> DataFrame:
    keep = keep if keep is not None else [c for c in df.columns if c != content]
    toks = df.select(*keep, word_tokens(content).alias("_toks"))
    return explode_chunks(toks, chunks_from_tokens(F.col("_toks"), budget), keep)


# ---------------------------------------------------------------------------
# Token-counter mode (injected tokenizer).

_SENT = re.compile(r"(?<=[.!?])\s+")
_GRAPHEME = regex.compile(r"\X")
LEVELS = 4  # lines, sentences, words, grapheme clusters


def _split_level(text: str, level: int) -> list[str]:
    """Pieces at one semantic level; concatenating them gives back ``text``."""
    if level == 0:  # lines
        parts = re.split(r"(?<=\n)", text)
    elif level == 1:  # sentences, separator kept on the left piece
        parts, last = [], 0
        for m in _SENT.finditer(text):
            parts.append(text[last:m.end()])
            last = m.end()
        parts.append(text[last:])
    elif level == 2:  # words with the white space around them
        parts = re.findall(r"\s*\S+\s*|\s+", text)
    else:
        parts = _GRAPHEME.findall(text)
    return [p for p in parts if p]


def _runs_of_sums(sizes: list[int], budget: int):
    """Greedy runs (first, last + 1) of additive sizes within the budget, from prefix sums; a piece
    over the budget is a run of its own."""
    ends = np.cumsum(sizes, dtype=np.int64)
    at, before = 0, 0
    while at < len(sizes):
        upto = max(int(np.searchsorted(ends, before + budget, side="right")), at + 1)
        yield at, upto, int(ends[upto - 1]) - before
        at, before = upto, int(ends[upto - 1])


def _runs_of_joined(pieces: list[str], budget: int, count: Callable[[str], int]):
    """The same with every candidate counted as it is joined: the run is doubled, then bisected, so
    a chunk of n pieces is counted about log n times."""
    at = 0
    while at < len(pieces):
        low, high = 0, 1
        while at + high <= len(pieces) and count("".join(pieces[at:at + high])) <= budget:
            low, high = high, 2 * high
        high = min(high, len(pieces) - at + 1)
        while high - low > 1:
            mid = (low + high) // 2
            if count("".join(pieces[at:at + mid])) <= budget:
                low = mid
            else:
                high = mid
        yield at, at + max(low, 1), budget if low else budget + 1
        at += max(low, 1)


def pack_chunks(text: str, budget: int, count: Callable[[str], int], level: int = 0) -> list[str]:
    """Greedy packing: pieces of the coarsest level are joined while they fit the budget; a piece
    that does not fit alone is split at the next finer level, and its chunks stay its own. A
    grapheme cluster is the smallest chunk. ``''.join(result) == text``."""
    if not text:
        return []
    if level >= LEVELS or count(text) <= budget:
        return [text]
    out: list[str] = []
    pieces = _split_level(text, level)
    runs = _runs_of_sums([count(p) for p in pieces], budget) if getattr(count, "additive", False) else _runs_of_joined(pieces, budget, count)
    for first, last, size in runs:
        if size <= budget:
            out.append("".join(pieces[first:last]))
        else:
            out.extend(pack_chunks(pieces[first], budget, count, level + 1))
    return out


def whitespace_token_count(s: str) -> int:
    return len(s.split())


def utf8_bytes(s: str) -> int:
    return len(s.encode("utf-8", "surrogatepass"))


def code_points(s: str) -> int:
    return len(s)


utf8_bytes.additive = code_points.additive = True


def _tokenizer(path: str) -> Callable[[str], int]:
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    return lambda s: len(model.encode(s, add_special_tokens=False).ids)


def counter(name: str) -> Callable[[], Callable[[str], int]]:
    """Factory of a token counter by name: ``words``, ``bytes``, ``chars``, or
    ``tokenizer:<path of a tokenizer file>`` (loaded once per Python worker)."""
    kind, _, path = name.partition(":")
    known = {"words": whitespace_token_count, "bytes": utf8_bytes, "chars": code_points}
    if kind == "tokenizer" and path:
        return functools.partial(_tokenizer, path)
    if name in known:
        return lambda: known[name]
    raise ValueError(f"no token counter named {name}: words, bytes, chars or tokenizer:<path>")


def token_chunk_udf(budget: int = DEFAULT_BUDGET,
                    counter_factory: Callable[[], Callable[[str], int]] = lambda: whitespace_token_count):
    """Arrow UDF ``content -> ARRAY<STRING>``; the counter is built once per
    Python worker (e.g. a real tokenizer loaded from a shared path)."""
    state = {}

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def _chunk(s: pd.Series) -> pd.Series:
        if "count" not in state:
            state["count"] = counter_factory()
        cnt = state["count"]
        return s.map(lambda t: pack_chunks(t, budget, cnt) if isinstance(t, str) else [])

    return sliced(_chunk, pa.list_(pa.string()))


def token_chunks(df: DataFrame, content: str = "content", keep: list[str] | None = None, budget: int = DEFAULT_BUDGET,
                 counter_factory: Callable[[], Callable[[str], int]] = lambda: whitespace_token_count) -> DataFrame:
    """C1 under a token counter: one row per chunk with ``keep``, ``chunk_idx`` and ``content``."""
    from ..session import ship_package
    ship_package(df.sparkSession)
    keep = keep if keep is not None else [c for c in df.columns if c != content]
    cut = df.select(*keep, token_chunk_udf(budget, counter_factory)(F.col(content)).alias("_chunks"))
    return explode_chunks(cut, F.col("_chunks"), keep)
