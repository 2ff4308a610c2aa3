"""Toxicity: a linear-chain conditional random field tags toxic spans.

Labels come per document, so tokens are labelled through a lexicon: word and prefix features that
mark labelled toxic documents; their words there are toxic, all words of clean documents are not.
The CRF (states clean and toxic) is fitted on windows of those tokens; forward-backward marginals
over a whole text give its spans, and a small logistic regression on their maximum, their sum and
their share gives the document score.

Defined results: a null or empty text, or one without words, has no spans and the score of a text
without any sign of toxicity; if nothing can be learned (a class without a text that has a word and
fits the bounds, or no feature that marks the toxic ones) every score is 0 and ``fit`` warns; repeated
rows are scored alike; an empty table gives no rows; other columns are kept (one named ``toxicity`` is
replaced); labels without a document and documents without an id or a word teach nothing and take no
place in the sample.
"""

from __future__ import annotations

import math
import re
import warnings
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import cut_lineage, prepare
from .linear import logistic, sigmoid

WORD = re.compile(r"\w+")
PREFIXES = (3, 4, 5, 6)
WINDOW = 48
#: Steps of one block of the forward-backward recursion.
BLOCK = 128
#: Words whose emission one Python worker remembers.
MEMO = 200_000

SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("marginal", pa.float64())])
SCORED = pa.struct([("score", pa.float64()), ("spans", pa.list_(SPAN))])
SCORED_DDL = "score double, spans array<struct<start:bigint,end:bigint,marginal:double>>"


def word_features(word: str) -> list[str]:
    return [word, *("^" + word[:k] for k in PREFIXES if len(word) > k)]


# --- forward-backward --------------------------------------------------------------------------

def _step(v, a):
    """Log-odds after one transition: v is the log-odds before it."""
    x = np.exp(np.clip(v, -60, 60))
    return np.log((x * a[1, 1] + a[0, 1]) / (x * a[1, 0] + a[0, 0]))


def _messages(e: np.ndarray, lengths: np.ndarray, a: np.ndarray, start: float) -> np.ndarray:
    """Log-odds of every position given what is before it and itself, over texts laid end to end.

    Each text is cut into blocks; the blocks' 2x2 transfer products are taken side by side, chained
    once per text, and the recursion then runs through all blocks at a time: exact, and a text of
    any length needs ``BLOCK`` vector steps.
    """
    blocks = -(-lengths // BLOCK)
    first_of = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(lengths)), blocks)
    turn = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    at = (first_of[owner] + turn * BLOCK)[:, None] + np.arange(BLOCK)
    inside = at < (first_of + lengths)[owner][:, None]
    at = np.where(inside, at, 0)
    em = np.where(inside, e[at], 0.0)
    init = np.full(len(owner), start)
    later = np.flatnonzero(turn > 0)
    if len(later):
        before = later - 1  # only blocks that another one follows need their product
        opening = turn[before] == 0  # a text's first position has the start odds, not a transition
        p = np.zeros((2, 2, len(before)))
        p[0, 0] = p[1, 1] = 1.0
        gain = np.exp(np.clip(em[before], -60, 60))
        for t in range(BLOCK):
            clean, toxic = a[0, 0] * p[0] + a[1, 0] * p[1], a[0, 1] * p[0] + a[1, 1] * p[1]
            if t == 0:
                clean, toxic = np.where(opening, p[0], clean), np.where(opening, p[1] * math.exp(start), toxic)
            toxic = toxic * gain[:, t]
            total = (clean + toxic).max(axis=0)
            p[0], p[1] = clean / total, toxic / total
        odds = 0.0
        for row, first, cc, tc, ct, tt in zip(later.tolist(), opening.tolist(), *p.reshape(4, -1).tolist()):
            x = 1.0 if first else odds
            odds = min(max((ct + tt * x) / max(cc + tc * x, 1e-200), 1e-26), 1e26)
            init[row] = math.log(odds)
    out = np.empty_like(em)
    v = np.where(turn == 0, start, _step(init, a)) + em[:, 0]
    out[:, 0] = v
    for t in range(1, BLOCK):
        v = em[:, t] + _step(v, a)
        out[:, t] = v
    return out[inside]


class ToxicityModel:
    """Feature weights, transitions and the calibration of document scores."""

    def __init__(self, weights: dict[str, float] | None = None, bias: float = 0.0, start: float = 0.0,
                 trans: np.ndarray | None = None):
        self.weights, self.bias, self.start = weights or {}, bias, start
        self.trans = np.exp(trans) if trans is not None else np.ones((2, 2))
        self.head: np.ndarray | None = None
        self._memo: dict[str, float] = {}

    def __getstate__(self):
        return self.__dict__ | {"_memo": {}}

    def emission(self, word: str) -> float:
        got = self._memo.get(word)
        if got is None:
            if len(self._memo) >= MEMO:
                self._memo.clear()
            got = self._memo[word] = self.bias + sum(self.weights.get(f, 0.0) for f in word_features(word.lower()))
        return got

    def marginals(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Probability of the toxic state of every word of every text."""
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        if not lengths.sum():
            return [np.zeros(0) for _ in texts]
        e = np.fromiter((self.emission(w) for t in texts for w in t), float, int(lengths.sum()))
        some = lengths[lengths > 0]
        forward = _messages(e, some, self.trans, self.start)
        # messages from behind: the same recursion on the reversed texts, less the own emission
        back = _messages(e[::-1], some[::-1], self.trans.T, 0.0)[::-1] - e
        return np.split(sigmoid(forward + back), np.cumsum(lengths)[:-1])

    def evidence(self, marginals: list[np.ndarray]) -> np.ndarray:
        """Per text: log-odds of its likeliest toxic word, and the logarithms of the expected number
        of toxic words and of their share."""
        top = np.clip([m.max(initial=1e-4) for m in marginals], 1e-4, 1 - 1e-4)
        many = np.array([m[m > 0.2].sum() for m in marginals])
        length = np.array([len(m) for m in marginals])
        return np.column_stack([np.log(top / (1 - top)), np.log1p(many), np.log1p(1000 * many / (length + 20))])

    def scores(self, marginals: list[np.ndarray]) -> np.ndarray:
        if self.head is None:
            return np.zeros(len(marginals))
        x = self.evidence(marginals)
        return sigmoid(x @ self.head[:-1] + self.head[-1])


# --- learning ----------------------------------------------------------------------------------

def lexicon(docs: list[tuple[Counter, int]], least_gain: float = 24.0, least_share: float = 0.6, most: int = 4000) -> list[str]:
    """Features whose documents are toxic far beyond the base rate (a likelihood ratio of
    ``least_gain``, more than chance gives among a million features) and whose occurrences, at
    most five a document, lie mostly in toxic documents."""
    seen = {1: (Counter(), Counter()), 0: (Counter(), Counter())}  # label -> documents, occurrences
    rate = sum(label for _, label in docs) / max(len(docs), 1)
    if not 0 < rate < 1:
        return []
    for label in (1, 0):
        in_docs, in_words = seen[label]
        for words, own in docs:
            if own == label:
                counts = Counter()
                for w, n in words.items():
                    for f in word_features(w):
                        if label or f in seen[1][0]:
                            counts[f] += n
                in_docs.update(counts.keys())
                in_words.update({f: min(n, 5) for f, n in counts.items()})
        for f in [f for f, k in in_docs.items() if label and k < 3]:
            del in_docs[f], in_words[f]
    found = []
    for f, k in seen[1][0].items():
        n = k + seen[0][0].get(f, 0)
        if k <= n * rate or seen[1][1][f] < least_share * (seen[1][1][f] + seen[0][1].get(f, 0)):
            continue
        gain = 2 * (k * math.log(k / n / rate) + (n - k) * math.log(max(n - k, 1e-9) / n / (1 - rate)))
        if gain >= least_gain:
            found.append((-gain, f))
    return [f for _, f in sorted(found)[:most]]


def _windows(docs: list[tuple[list[str], int]], index: dict[str, int], most: int):
    """Feature ids and tags of token windows: all around labelled tokens, and as many clean ones."""
    per_word = 1 + len(PREFIXES)
    hot, cold = [], []
    for words, label in docs:
        ids = np.zeros((-(-max(len(words), 1) // WINDOW) * WINDOW, per_word), dtype=np.int32)
        for i, w in enumerate(words):
            hits = [index[f] for f in word_features(w) if f in index]
            ids[i, :len(hits)] = hits
        tags = ((ids > 0).any(axis=1) & bool(label)).reshape(-1, WINDOW)
        ids = ids.reshape(-1, WINDOW, per_word)
        seen = (ids > 0).any(axis=(1, 2))
        if label:
            hot += [(ids[k], tags[k]) for k in np.flatnonzero(seen)]
        else:
            cold += [(ids[k], tags[k]) for k in sorted({*np.flatnonzero(seen).tolist(), (len(words) // 2) // WINDOW})]
    hot = hot[::max(1, -(-len(hot) // (most // 2)))]
    cold = cold[::max(1, -(-len(cold) // (most // 2)))]
    both = hot + cold
    return np.stack([x for x, _ in both]), np.stack([y for _, y in both]).astype(np.int8)


def fit_crf(ids: np.ndarray, tags: np.ndarray, n_features: int, steps: int = 120, ridge: float = 1e-3):
    """Maximum likelihood (with a ridge) of a two-state chain over equal windows, by Adam on the
    forward-backward gradient. Returns feature weights, bias, start and log transitions."""
    n, length, _ = ids.shape
    theta = np.zeros(n_features + 1 + 2 + 4)  # weights (0 is no feature), bias, start, transitions
    theta[n_features + 1] = -3.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    lit = np.flatnonzero(ids.reshape(-1))
    lit_feature, lit_token = ids.reshape(-1)[lit], lit // ids.shape[2]
    pair = tags[:, :-1] * 2 + tags[:, 1:]
    seen_pairs = np.bincount(pair.reshape(-1), minlength=4).astype(float)
    for step in range(1, steps + 1):
        bias, start, a = theta[n_features + 1], theta[n_features + 2], np.exp(theta[n_features + 3:]).reshape(2, 2)
        e = bias + np.bincount(lit_token, weights=theta[lit_feature], minlength=n * length).reshape(n, length)
        gain = np.exp(np.clip(e, -30, 30))
        alpha = np.empty((length, 2, n))
        alpha[0, 0], alpha[0, 1] = 1.0, gain[:, 0] * math.exp(start)
        alpha[0] /= alpha[0].sum(axis=0)
        for t in range(1, length):
            alpha[t] = a.T @ alpha[t - 1]
            alpha[t, 1] *= gain[:, t]
            alpha[t] /= alpha[t].sum(axis=0)
        beta, expected = np.ones((2, n)), np.zeros(4)
        post = np.empty((n, length))
        for t in range(length - 1, -1, -1):
            q = alpha[t] * beta
            post[:, t] = q[1] / q.sum(axis=0)
            if t:
                incoming = beta.copy()
                incoming[1] *= gain[:, t]
                joint = alpha[t - 1][:, None, :] * a[:, :, None] * incoming[None, :, :]
                expected += (joint / joint.sum(axis=(0, 1))).sum(axis=2).reshape(4)
                beta = a @ incoming
                beta /= beta.sum(axis=0)
        miss = (tags - post).reshape(-1)
        grad = np.zeros_like(theta)
        grad[:n_features + 1] = np.bincount(lit_feature, weights=miss[lit_token], minlength=n_features + 1)
        grad[0] = 0.0
        grad[n_features + 1] = miss.sum()
        grad[n_features + 2] = (tags[:, 0] - post[:, 0]).sum()
        grad[n_features + 3:] = seen_pairs - expected
        grad = grad / n - ridge * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta = theta + 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return theta[:n_features + 1], theta[n_features + 1], theta[n_features + 2], theta[n_features + 3:].reshape(2, 2)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", max_docs: int = 4000, max_chars: int = 12_000_000, max_windows: int = 2400) -> ToxicityModel:
    """Learn from at most ``max_docs`` labelled documents and at most ``max_chars`` of their
    characters, taken as whole texts; both bound what comes to the driver. A document is a different
    text with a word: texts are looked at before places are given, rows of one id are one document
    (the text of the greatest hash) and so are copies under one label. Places go by a hash of the id,
    over both classes alike but for a tenth of them, which each class has if it has so many documents;
    the score's intercept is set back to the classes' rates among all labelled documents. The rarer
    class may take half of the characters, the other what is left; a text that does not fit is passed
    over and those after it are still taken. One document of each group of near copies (same smallest
    shingle hash) counts, so that copies do not make their rare words look like a rule. Of their windows
    at most ``max_windows`` fit the CRF (half around labelled tokens, half clean, each thinned by a fixed
    stride), over the 4,000 lexicon features of the greatest likelihood ratio. All this bounds training
    only: whole texts are scored. If nothing can be learned, a warning says why."""
    prepare(docs.sparkSession)
    marked = (labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("_id"))
              .agg(F.max(label_col).alias("_label")))
    docs = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
            .where(F.col("_id").isNotNull() & F.col("_text").rlike(r"(?U)\w")).withColumn("_t", F.xxhash64("_text")))
    # narrow rows: one text of each id, then one id of each text and label
    told = (docs.select("_id", "_t", F.length("_text").alias("_n")).join(marked, "_id").groupBy("_id")
            .agg(F.max(F.struct("_t", "_n")).alias("of"), F.max(F.col("_label") > 0).cast("int").alias("label")))
    told = cut_lineage(told.groupBy(F.col("of._t").alias("_t"), "label").agg(F.min(F.struct(F.xxhash64("_id").alias("h"), "_id")).alias("at"), F.max("of._n").alias("n")))
    rates = {r["label"]: r["count"] for r in told.groupBy("label").count().collect()}
    if len(rates) < 2:
        return _nothing("no labelled text with a word in each class")
    chosen = {k: [(r["at"]["h"], r["at"]["_id"], r["_t"], r["n"]) for r in told.where(F.col("label") == k).orderBy("at.h", "at._id").limit(max_docs).collect()]
              for k in (0, 1)}
    first = sorted([(*row, k) for k in chosen for row in chosen[k]])[:max_docs]
    least = max(1, max_docs // 10)
    rare = min(rates, key=lambda k: (rates[k], k))
    places = {rare: max(sum(row[-1] == rare for row in first), min(rates[rare], least))}
    places[1 - rare] = max_docs - places[rare]
    keep, room = {}, max_chars // 2
    left = max_chars
    for k in (rare, 1 - rare):
        for _, doc_id, t, n in chosen[k][:places[k]]:
            if n <= room:
                room, left = room - n, left - n
                keep[doc_id, t] = k
        room = left
    if len(set(keep.values())) < 2:
        return _nothing("no text that fits into the characters in each class")
    wanted = F.broadcast(docs.sparkSession.createDataFrame([(*key, k) for key, k in keep.items()], "_id long, _t long, _label int"))
    rows = docs.join(wanted, ["_id", "_t"]).groupBy("_id", "_t", "_label").agg(F.min("_text").alias("_text")).select("_id", "_text", "_label").collect()
    texts: dict[tuple, tuple] = {}
    for _, text, label in sorted(rows):
        words = [w.lower() for w in WORD.findall(text)]
        if words:
            copy_of = min(hash_of(" ".join(words[i:i + 5])) for i in range(max(1, len(words) - 4)))
            texts.setdefault((copy_of, label), (words, label))
    del rows
    sample = [texts[k] for k in sorted(texts)]
    names = lexicon([(Counter(words), label) for words, label in sample])
    if not names:
        return _nothing("no feature of the texts marks the toxic ones")
    index = {f: i + 1 for i, f in enumerate(names)}
    ids, tags = _windows(sample, index, max_windows)
    weights, bias, start, trans = fit_crf(ids, tags, len(names))
    model = ToxicityModel({f: float(weights[i]) for f, i in index.items()}, float(bias), float(start), trans)
    evidence = []
    for at in range(0, len(sample), 500):
        evidence.append(model.evidence(model.marginals([words for words, _ in sample[at:at + 500]])))
    truth = np.array([label for _, label in sample], dtype=float)
    model.head = logistic(np.concatenate(evidence), truth)
    if rates[rare] > places[rare] > sum(row[-1] == rare for row in first):  # the rarer class was given more places than its share
        model.head[-1] += math.log(rates[1] / rates[0]) - math.log(truth.sum() / (len(truth) - truth.sum()))
    model._memo = {}
    return model


def _nothing(why: str) -> ToxicityModel:
    warnings.warn(f"toxicity: nothing learned, every score is 0: {why}", RuntimeWarning, stacklevel=3)
    return ToxicityModel()


def hash_of(shingle: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(shingle)


# --- scoring -----------------------------------------------------------------------------------

def scorer(model: ToxicityModel, threshold: float = 0.5):
    """Arrow UDF of a text column: its score and the offsets of runs of words whose marginal is at
    least ``threshold`` (code points, end exclusive, with the run's highest marginal)."""

    def spans(text: str, marginal: np.ndarray) -> list[dict]:
        out: list[dict] = []
        last = -2
        hot = set(np.flatnonzero(marginal >= threshold).tolist())
        for i, m in enumerate(WORD.finditer(text)) if hot else ():
            if i in hot:
                p = float(marginal[i])
                if last == i - 1:
                    out[-1] |= {"end": m.end(), "marginal": max(out[-1]["marginal"], p)}
                else:
                    out.append({"start": m.start(), "end": m.end(), "marginal": p})
                last = i
        return out

    @F.arrow_udf(SCORED_DDL)
    def toxicity(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            scores, found = [], []
            for at in range(0, len(batch), 64):
                texts = [t or "" for t in batch.slice(at, 64).to_pylist()]
                marginals = model.marginals([WORD.findall(t) for t in texts])
                scores += model.scores(marginals).tolist()
                found += [spans(t, m) for t, m in zip(texts, marginals)]
            yield pa.StructArray.from_arrays([pa.array(scores, pa.float64()), pa.array(found, pa.list_(SPAN))], fields=list(SCORED))

    return toxicity


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``toxicity`` = struct<score, spans>."""
    prepare(docs.sparkSession)
    return docs.withColumn("toxicity", scorer(model)(F.col(text_col)))
