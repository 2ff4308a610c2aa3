"""Quality rules: hard floors, then robust multivariate outliers per language and source.

Five counts are taken from every whole text. Four statistics made from them (mean word length, and the
shares of symbols, of duplicated lines and of words in repeated windows, each under a transform that
evens out its spread) are compared with those of the text's own language and source: location and
scatter are minimum-covariance-determinant estimates, and a text whose squared Mahalanobis distance is
beyond a chi-square quantile is rejected.

The estimates are fitted to all rows, by concentration steps over the table of distinct statistic
vectors (copies count once, so a group of copies cannot become its unit's normal case). A step is one
pass for all units and starting points together: every vector's distance falls into a bucket, counts
and moments are added up by bucket, and the buckets nearest to the centre that hold the wanted share
give the next estimate. So no unit is gathered, however many rows it has, and the halves that decide
are taken from all of them. A language and source of fewer than ``min_rows`` distinct vectors is judged
with the language's other small sources, those with all other small ones; a unit that is still smaller
rejects nothing.

Defined results: a null text has no words (all counts 0, ``base_failed``); a null language or source is
a language or source of its own; a null id stays null; repeated rows are judged alike; an empty table
gives no rows; other columns are kept (those named like a result are replaced). Texts are taken whole,
a piece of about a million bytes at a time.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import prepare, written

WINDOW = 8
#: Fixed values of the rules: the symbols counted, and the white space that ends a word.
SYMBOLS = b"#*$%&|<>"
SPACE = re.compile(rb"[\x20\x09-\x0d]")
#: Bytes that do not begin a code point of a word.
NOT_COUNTED = bytes(range(0x80, 0xC0)) + b" \t\n\v\f\r"
PIECE = 1 << 20
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
STATISTICS = ["x0", "x1", "x2", "x3"]
P = len(STATISTICS)
PAIRS = [(i, j) for i in range(P) for j in range(i, P)]
#: Words that a text's shares are drawn towards the usual by, so that short texts are no outliers for being short.
STEADY = 50
#: Least spread of a statistic that counts as spread, in its transform's units.
FLOORS = np.array([0.05, 0.05, 0.1, 0.1])
#: Distance buckets an octave of the squared distance.
FINE = 16


def word_ids(data: bytes, number: defaultdict) -> np.ndarray:
    """Numbers of the words of a text, a piece at a time: only distinct words are held as objects."""
    out, at = [], 0
    while at < len(data):
        cut = SPACE.search(data, at + PIECE)
        end = cut.end() if cut else len(data)
        words = data[at:end].split()
        out.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
        at = end
    return np.concatenate(out) if out else np.zeros(0, dtype=np.int64)


def repeated_words(words: np.ndarray, text_of: np.ndarray) -> np.ndarray:
    """True for words in a window of eight that its text has twice or more. Windows are told apart
    exactly: numbers of pairs of words, then of pairs of pairs, then of pairs of those."""
    n = len(words) - WINDOW + 1
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    if n <= 0:
        return covered[:-1] > 0
    code = pd.factorize(words + text_of * (words.max() + 1))[0].astype(np.int64)
    width = 1
    while width < WINDOW:
        pairs = code[:-width] * (int(code.max()) + 1) + code[width:]
        code = pd.factorize(pairs)[0].astype(np.int64)
        width *= 2
    inside = text_of[:n] == text_of[WINDOW - 1:]
    often = np.bincount(code[inside], minlength=len(code) + 1)[code] > 1
    starts = np.flatnonzero(inside & often)
    np.add.at(covered, starts, 1)
    np.subtract.at(covered, starts + WINDOW, 1)
    return covered[:-1].cumsum() > 0


def count_texts(texts: list[bytes]) -> np.ndarray:
    """The five counts of every text and its lines with a word, a row each."""
    number: defaultdict = defaultdict(itertools.count().__next__)
    ids = [word_ids(t, number) for t in texts]
    sizes = np.array([len(i) for i in ids], dtype=np.int64)
    out = np.zeros((len(texts), 6), dtype=np.int64)
    out[:, 0] = sizes
    for k, t in enumerate(texts):
        out[k, 1] = len(t.translate(None, NOT_COUNTED))
        out[k, 2] = len(t) - len(t.translate(None, SYMBOLS))
        lines = [line for line in t.split(b"\n") if line.strip()]
        out[k, 3], out[k, 5] = len(lines) - len(set(lines)), len(lines)
    text_of = np.repeat(np.arange(len(texts)), sizes)
    if len(text_of):
        out[:, 4] = np.bincount(text_of[repeated_words(np.concatenate(ids), text_of)], minlength=len(texts))
    return out


def counted(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """A row per document: doc_id, lang, source, the five counts and lines with a word."""
    names = [*COUNTS, "n_lines"]
    schema = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("source", pa.string()), *((c, pa.int64()) for c in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column(3).to_pylist()]
            counts = count_texts(texts)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *(pa.array(counts[:, k]) for k in range(len(names)))], schema=schema)

    kept = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"),
                       F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return kept.mapInArrow(run, "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in names))


def statistics() -> list[Column]:
    """The transformed statistics: log of the mean word length, roots of three shares."""
    n = F.col("n_words") + STEADY
    steps = [F.log((F.col("word_chars") + 5 * STEADY) / n), F.sqrt(F.col("n_symbols") / n),
             F.sqrt(F.col("n_dup_lines") / (F.col("n_lines") + 5)), F.sqrt(F.col("n_repeat_words") / n)]
    return [F.round(x, 6).alias(c) for x, c in zip(steps, STATISTICS)]


def chi2_share(x: float, freedom: int) -> float:
    """Chi-square distribution function of an even number of degrees of freedom."""
    term, total = 1.0, 0.0
    for k in range(freedom // 2):
        total += term
        term *= x / 2 / (k + 1)
    return 1 - math.exp(-x / 2) * total


def chi2_quantile(share: float, freedom: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        low, high = (mid, high) if chi2_share(mid := (low + high) / 2, freedom) < share else (low, mid)
    return high


def consistency(share: float) -> float:
    """Factor that makes the scatter of a normal sample's nearest ``share`` estimate the whole's."""
    return 1.0 if share >= 1 else share / max(chi2_share(chi2_quantile(share, P), P + 2), 1e-12)


def estimate(n, sums: np.ndarray, products: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centre, precision matrix and log determinant from counts, sums and products of pairs (a row a unit)."""
    n = np.asarray(n, dtype=float)[:, None]
    centre = sums / n
    scatter = np.zeros((len(centre), P, P))
    for k, (i, j) in enumerate(PAIRS):
        scatter[:, i, j] = scatter[:, j, i] = products[:, k] / n[:, 0] - centre[:, i] * centre[:, j]
    scatter *= np.array([consistency(round(float(a), 6)) for a in share])[:, None, None]
    scatter += np.diag(FLOORS**2)
    return centre, np.linalg.inv(scatter), np.linalg.slogdet(scatter)[1]


ESTIMATE_DDL = "unit string, start int, centre array<double>, precision array<double>, spread double"


def estimated(moments: DataFrame) -> DataFrame:
    """Estimates from rows of unit, start, n, share, s0.., p0.. (sums and products)."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                centre, precision, spread = estimate(f["n"], f[[f"s{i}" for i in range(P)]].to_numpy(), f[[f"p{k}" for k in range(len(PAIRS))]].to_numpy(),
                                                     f["share"].to_numpy())
                yield pd.DataFrame({"unit": f["unit"], "start": f["start"], "centre": list(centre), "precision": [m.ravel() for m in precision], "spread": spread})

    return written(moments.mapInPandas(run, ESTIMATE_DDL), "quality-estimates")


def summed() -> list[Column]:
    """Count, sums and products of pairs of the statistics of a group."""
    return [F.count(F.lit(1)).alias("n"), *(F.sum(c).alias(f"s{i}") for i, c in enumerate(STATISTICS)),
            *(F.sum(F.col(STATISTICS[i]) * F.col(STATISTICS[j])).alias(f"p{k}") for k, (i, j) in enumerate(PAIRS))]


def squared_distance() -> Column:
    off = [F.col(c) - F.col("centre")[i] for i, c in enumerate(STATISTICS)]
    total = F.lit(0.0)
    for i, j in PAIRS:
        total += (1.0 if i == j else 2.0) * F.col("precision")[i * P + j] * off[i] * off[j]
    return total


def concentrate(vectors: DataFrame, estimates: DataFrame, share: float) -> DataFrame:
    """One step for all units and starts: the estimate from each one's nearest ``share`` of vectors."""
    bucket = F.floor(FINE * F.log2(squared_distance() + 2.0**-20)).cast("int")
    by_bucket = vectors.join(estimates, "unit").groupBy("unit", "start", bucket.alias("bucket")).agg(*summed())
    whole, upto = Window.partitionBy("unit", "start"), Window.partitionBy("unit", "start").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    near = (by_bucket.withColumns({"all": F.sum("n").over(whole), "before": F.coalesce(F.sum("n").over(upto), F.lit(0))})
            .where(F.col("before") < F.ceil(F.col("all") * share)))
    sums = [f"s{i}" for i in range(P)] + [f"p{k}" for k in range(len(PAIRS))]
    return estimated(near.groupBy("unit", "start").agg(F.sum("n").alias("n"), (F.sum("n") / F.max("all")).alias("share"), *(F.sum(c).alias(c) for c in sums)))


def units_of(distinct: DataFrame, min_rows: int) -> DataFrame:
    """The unit that judges each language and source: its own, its language's small sources, all small ones."""
    sizes = distinct.groupBy("lang_key", "source_key").count()
    small = F.col("count") < min_rows
    by_lang = sizes.where(small).groupBy("lang_key").agg(F.sum("count").alias("rest"))
    named = sizes.join(by_lang, "lang_key", "left").withColumn(
        "unit", F.when(~small, F.to_json(F.struct("lang_key", "source_key"))).when(F.col("rest") >= min_rows, F.to_json(F.struct("lang_key"))).otherwise("{}"))
    return written(named.select("lang_key", "source_key", "unit"), "quality-units")


def fit(distinct: DataFrame, min_rows: int, share: float, most_steps: int) -> tuple[DataFrame, DataFrame]:
    """Units of (lang_key, source_key), and each unit's centre and precision, from the distinct vectors."""
    units = units_of(distinct, min_rows)
    vectors = written(distinct.join(units, ["lang_key", "source_key"]).select("unit", *STATISTICS).distinct(), "quality-vectors")
    enough = vectors.groupBy("unit").agg(*summed()).where(F.col("n") >= min_rows)
    classic = enough.withColumns({"start": F.lit(0), "share": F.lit(1.0)})
    quartiles = vectors.groupBy("unit").agg(F.count(F.lit(1)).alias("n"), *(F.percentile_approx(c, [0.25, 0.5, 0.75], 1000).alias(c) for c in STATISTICS))
    # the other start: medians and quartile ranges, as the moments of one vector
    spread = [(F.col(c)[2] - F.col(c)[0]) / 1.349 for c in STATISTICS]
    middle = quartiles.where(F.col("n") >= min_rows).select(
        "unit", F.lit(1).cast("long").alias("n"), *(F.col(c)[1].alias(f"s{i}") for i, c in enumerate(STATISTICS)),
        *((F.col(STATISTICS[i])[1] * F.col(STATISTICS[j])[1] + (spread[i] * spread[i] if i == j else 0.0)).alias(f"p{k}") for k, (i, j) in enumerate(PAIRS)),
        F.lit(1).alias("start"), F.lit(1.0).alias("share"))
    now, last = estimated(classic.unionByName(middle)), None
    for _ in range(most_steps):
        now = concentrate(vectors, now, share)
        spreads = now.agg(F.sum(F.round("spread", 9)), F.count(F.lit(1))).first()
        if spreads == last:
            break
        last = spreads
    best = Window.partitionBy("unit").orderBy("spread", "start")
    chosen = now.withColumn("turn", F.row_number().over(best)).where("turn = 1").drop("turn")
    # reweighted once: the vectors within the 0.975 quantile give the final estimate
    inner = vectors.join(chosen, "unit").where(squared_distance() <= chi2_quantile(0.975, P)).groupBy("unit").agg(*summed())
    return units, estimated(inner.withColumns({"start": F.lit(0), "share": F.lit(0.975)}))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          min_words: int = 20, max_repeat_percent: int = 30, tail: float = 1e-6, share: float = 0.75, min_rows: int = 50,
          most_steps: int = 12) -> DataFrame:
    """One row per document: doc_id, lang, source, the counts, base_failed, kept, distance (squared; null
    where a hard floor or the lack of a unit decides) and the unit that judged it."""
    prepare(docs.sparkSession)
    counts = counted(docs, id_col, text_col, lang_col, source_col)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    key = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit(""))
    stats = written(counts.select("*", failed.alias("base_failed"), key("lang").alias("lang_key"), key("source").alias("source_key"), *statistics()), "quality-statistics")
    distinct = stats.where("not base_failed").select("lang_key", "source_key", *STATISTICS).distinct()
    units, estimates = fit(written(distinct, "quality-distinct"), min_rows, share, most_steps)
    rules = units.join(estimates.select("unit", "centre", "precision"), "unit", "left")
    judged = stats.join(rules, ["lang_key", "source_key"], "left").withColumn("distance", F.when(~F.col("base_failed"), squared_distance()))
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= chi2_quantile(1 - tail, P), F.lit(True))
    return judged.select("doc_id", "lang", "source", *COUNTS, "base_failed", kept.alias("kept"), "distance", "unit")
