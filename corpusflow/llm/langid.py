"""Language ID by hierarchical discrimination.

A text's family is predicted first (one linear SVM per family against the rest), then one-versus-one
linear SVMs separate the languages of that family. Features are hashed byte trigrams of the whole
lower-cased text, square-rooted and scaled to length one.

Defined results: a null or empty text, or one without a letter, is ``und`` with score 0, and so is
every text if no language could be learned; repeated rows are scored alike; an empty table gives
no rows; other columns are kept (one named ``language`` is replaced); rows without an id, language
or a letter in their text teach nothing and take no place in the sample, and copies of a text count
once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import cut_lineage, prepare
from .linear import linear_svm, logistic, sigmoid

# Families of ISO 639-1 codes; a code not listed is a family by itself.
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv"],
    "romance": ["ca", "es", "fr", "gl", "it", "oc", "pt", "ro"],
    "slavic": ["be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
    "uralic": ["et", "fi", "hu"],
    "celtic": ["br", "cy", "ga", "gd"],
    "baltic": ["lt", "lv"],
    "turkic": ["az", "kk", "tr", "uz"],
    "indic": ["bn", "gu", "hi", "mr", "ne", "pa", "si", "ur"],
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}

DIM = 1 << 12
NOT_LETTERS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))
SCORED = pa.struct([("lang", pa.string()), ("score", pa.float64())])


def features(text: str) -> np.ndarray:
    """Unit vector of square-rooted hashed trigram counts of a whole text."""
    raw = b" " + text.lower().encode("utf-8", "replace").translate(NOT_LETTERS) + b" "
    counts = np.zeros(DIM)
    for at in range(0, len(raw) - 2, 1 << 20):  # long texts piece by piece, overlapping by two
        b = np.frombuffer(raw[at:at + (1 << 20) + 2], np.uint8).astype(np.uint32)
        h = (b[:-2] * np.uint32(0x9E3779B1) ^ b[1:-1] * np.uint32(0x85EBCA77) ^ b[2:] * np.uint32(0xC2B2AE3D))
        counts += np.bincount((h ^ h >> np.uint32(15)) & np.uint32(DIM - 1), minlength=DIM)
    v = np.sqrt(counts)
    return v / max(np.linalg.norm(v), 1e-12)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


class LanguageModel:
    """Family classifiers, then pairwise classifiers of the languages of each family."""

    def __init__(self, langs: list[str]):
        self.families: dict[str, list[str]] = {}
        for lang in sorted(langs):
            self.families.setdefault(FAMILY_OF.get(lang, lang), []).append(lang)
        self.heads: list[tuple] = []  # (kind, positive, negative)
        self.weights, self.bias, self.scale = np.zeros((0, DIM)), np.zeros(0), np.zeros(0)

    def fit(self, x: np.ndarray, langs: np.ndarray) -> "LanguageModel":
        family = np.array([FAMILY_OF.get(v, v) for v in langs], dtype=object)
        jobs = [(("family", f, None), np.ones(len(x), bool), family == f) for f in self.families if len(self.families) > 1]
        for f, members in self.families.items():
            for i, a in enumerate(members):
                jobs += [(("pair", a, b), (langs == a) | (langs == b), langs == a) for b in members[i + 1:]]
        weights, bias, scale = [], [], []
        for head, rows, positive in jobs:
            y = np.where(positive[rows], 1.0, -1.0)
            w, b = linear_svm(x[rows], y)
            margin = x[rows] @ w + b
            a = logistic(margin[:, None], (y > 0).astype(float))
            self.heads.append(head)
            weights.append(w)
            bias.append(b)
            scale.append(max(a[0], 1.0))
        if weights:
            self.weights, self.bias, self.scale = np.stack(weights), np.array(bias), np.array(scale)
        return self

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.families or not has_letter(text):
            return "und", 0.0
        p = sigmoid(self.scale * (self.weights @ features(text) + self.bias)).tolist()
        of_family = {h[1]: v for h, v in zip(self.heads, p) if h[0] == "family"} or {next(iter(self.families)): 1.0}
        family = max(sorted(of_family), key=of_family.get)
        members = self.families[family]
        if len(members) == 1:
            return members[0], of_family[family]
        votes, sure = dict.fromkeys(members, 0), dict.fromkeys(members, 0.0)
        for (kind, a, b), v in zip(self.heads, p):
            if kind == "pair" and a in votes:
                votes[a if v >= 0.5 else b] += 1
                sure[a] += v / (len(members) - 1)
                sure[b] += (1 - v) / (len(members) - 1)
        best = max(members, key=lambda m: (votes[m], sure[m]))
        return best, of_family[family] * sure[best]


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_lang: int = 300, least: int = 3, max_docs: int = 4800, max_langs: int = 256) -> LanguageModel:
    """Learn from at most ``per_lang`` documents of each language (the first by a hash of the id)
    and about ``max_docs`` in all, shared evenly by the languages. A document is a different text
    with a letter; rows of one id and language are one. Languages with fewer than
    ``least`` documents and those beyond the ``max_langs`` most frequent are not learned. So what
    comes to the driver is bounded however many languages, and however often an id, there are.
    Each sampled text counts whole and once more as a short window, so short texts are known too."""
    prepare(docs.sparkSession)
    # the first of each slice of a language, then of the language: no task sees a common language whole
    sliced, first = (Window.partitionBy("lang", *by).orderBy("h", "doc_id") for by in (["slice"], []))
    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
            .where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
            .withColumn("t", F.xxhash64("text")))
    # one text of each id, then one id of each text: narrow rows, and both aggregates collapse a hot key before the shuffle
    told = rows.groupBy("lang", "doc_id").agg(F.min("t").alias("t")).withColumn("h", F.xxhash64("doc_id"))
    told = cut_lineage(told.groupBy("lang", "t").agg(F.min_by("doc_id", "h").alias("doc_id"), F.min("h").alias("h")))
    known = [r["lang"] for r in told.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
             .orderBy(F.desc("n"), "lang").limit(max_langs).collect()]
    if not known:
        return LanguageModel([])
    per_lang = max(least, min(per_lang, max_docs // len(known)))
    ids = (told.where(F.col("lang").isin(known)).withColumn("slice", F.pmod(F.hash("h"), F.lit(16)))
           .withColumn("r", F.row_number().over(sliced)).where(F.col("r") <= per_lang)
           .withColumn("r", F.row_number().over(first)).where(F.col("r") <= per_lang)
           .select("lang", "doc_id"))
    keep = [tuple(r) for r in ids.collect()]

    @F.arrow_udf("array<binary>")
    def vectors(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts.to_pylist():
            middle = len(t) // 3
            out.append([features(s).astype(np.float32).tobytes() for s in (t, t[middle:middle + 80] or t)] if has_letter(t) else [])
        return pa.array(out, type=pa.list_(pa.binary()))

    chosen = rows.join(F.broadcast(docs.sparkSession.createDataFrame(keep, "lang string, doc_id long")), ["lang", "doc_id"], "left_semi")
    chosen = chosen.groupBy("lang", "doc_id").agg(F.min_by("text", "t").alias("text"))  # the text its id was told by
    got = chosen.select("lang", vectors("text").alias("v")).collect()
    by_lang: dict[str, list] = {}
    for r in sorted(got, key=lambda r: (r["lang"], [bytes(b) for b in r["v"]])):
        by_lang.setdefault(r["lang"], []).extend(np.frombuffer(b, np.float32) for b in r["v"])
    by_lang = {k: v[:4 * per_lang] for k, v in by_lang.items() if len(v) >= 2 * least}
    model = LanguageModel(list(by_lang))
    if not by_lang:
        return model
    return model.fit(np.stack([x for v in by_lang.values() for x in v]),
                     np.array([k for k, v in by_lang.items() for _ in v], dtype=object))


def scorer(model: LanguageModel):
    """Arrow UDF of a text column: struct<lang string, score double>."""

    @F.arrow_udf("lang string, score double")
    def language(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            got = [model.predict(t.as_py()) for t in texts]
            yield pa.StructArray.from_arrays([pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                                             fields=list(SCORED))

    return language


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``language`` = struct<lang, score>."""
    prepare(docs.sparkSession)
    return docs.withColumn("language", scorer(model)(F.col(text_col)))


def held_out(id_col: str, folds: int, fold: int) -> Column:
    """True for rows of the fold by the CRC-32 of the id as text; a null id is in no fold."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(False))
