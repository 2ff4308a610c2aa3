"""Whitening, quality rules and the prefix trie on edge cases and against brute force."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusflow.llm import prefixtrie, quality, queries, whitening
from conftest import SF01

# --- whitening ---


def brute_whitening(vectors, components=8):
    """Deviations, whitened rows up to sign and explained shares by a dense eigenvalue solver."""
    x = np.floor(1024 * np.array(vectors, dtype=float)).astype(np.int64) + 100_000
    n, total = len(x), x.sum(axis=0)
    centred = (n * x - total) / n
    e, q = np.linalg.eigh(centred.T @ centred / n)
    e, q = e[::-1][:components], q[:, ::-1][:, :components]
    return ((n * x - total) ** 2).sum(axis=1), centred @ q / np.sqrt(e), e / np.square(centred).sum() * n


def same_up_to_sign(got, want, tol):
    sign = np.sign((got * want).sum(axis=0))
    return np.abs(got - want * sign).max() < tol


def test_whitening_query_against_dense_solver(spark):
    got = queries.QUERIES["op11_embedding_whitening"](spark, SF01).toPandas()
    rows = spark.read.parquet(f"{SF01}/embeddings.parquet").toPandas()
    deviation, y, explained = brute_whitening(rows["embedding"].tolist())
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[rows["vec_id"]].to_numpy()
    assert wide.shape == y.shape and same_up_to_sign(wide, y, 1e-9)
    assert (got[got["component"] == 3].set_index("vec_id").loc[rows["vec_id"], "deviation"] == deviation).all()
    assert np.allclose(got.groupby("component")["explained"].first(), explained, rtol=1e-10)
    assert set(got["n"]) == {len(rows)} and got["identity_error"].nunique() == 1 and got["identity_error"][0] < 1e-10


@pytest.mark.parametrize("width,k,inner", [(1, 1, 5), (2, 2, 5), (3, 8, 5), (40, 8, 1), (40, 8, 20), (64, 5, 5)])
def test_eigensolver_locks_pairs_at_double_precision(width, k, inner):
    rng = np.random.default_rng(width + inner)
    x = rng.normal(size=(500, width)) * np.linspace(1, 1.05, width)
    v = x.T @ x
    k = min(k, width)
    value, vector = whitening.jacobi_davidson(lambda z: v @ z, width, k, inner=inner)
    e, _ = np.linalg.eigh(v)
    assert np.allclose(value, e[::-1][:k], rtol=1e-12)
    assert np.abs(vector.T @ vector - np.eye(k)).max() < 1e-12
    assert np.linalg.norm(v @ vector - vector * value, axis=0).max() <= 2 * max(width, 16) * whitening.EPS * e[-1]


def test_eigensolver_with_equal_and_no_eigenvalues():
    value, vector = whitening.jacobi_davidson(lambda z: z * np.array([[3.0], [3.0], [3.0], [1.0], [0.0]]), 5, 4)
    assert np.allclose(value, [3, 3, 3, 1]) and np.abs(vector.T @ vector - np.eye(4)).max() < 1e-12


def test_minres_solves_under_each_shift():
    rng = np.random.default_rng(1)
    m = rng.normal(size=(12, 12))
    m, shift, b = m + m.T, np.array([0.3, -2.0, 5.0]), rng.normal(size=(12, 3))
    b[:, 1] = 0
    x = whitening.minres(lambda v: m @ v - v * shift, b, 40, 1e-13)
    assert np.abs(m @ x - x * shift - b).max() < 1e-8 and not x[:, 1].any()


def test_whitening_edges(spark):
    rng = np.random.default_rng(0)
    good = [[float(c) for c in v] for v in rng.normal(size=(60, 4))]
    rows = [(i, v, 1) for i, v in enumerate(good)]
    rows += [(None, good[0], 1), (7, good[7], 1)]  # no id, and a repeated row: both count
    bad = [(100, None, 1), (101, [], 1), (102, [1.0, None, 0.0, 0.0], 1), (103, [float("nan")] * 4, 1),
           (104, [float("inf"), 0.0, 0.0, 0.0], 1), (105, [1e300, 0.0, 0.0, 0.0], 1), (106, [1.0, 2.0], 1)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, component int")
    got = whitening.whiten(df, components=8, block_rows=16).toPandas()
    assert len(got) == 4 * len(rows) and set(got["n"]) == {62}
    deviation, y, explained = brute_whitening([v for _, v, _ in rows], 4)
    assert sorted(got[got["component"] == 1]["deviation"]) == sorted(deviation)
    for c in range(1, 5):
        one = got[(got["component"] == c) & (got["vec_id"] == 3)]["whitened"].iat[0]
        assert abs(abs(one) - abs(y[3, c - 1])) < 1e-9
    assert got["vec_id"].isna().sum() == 4 and (got["vec_id"] == 7).sum() == 8
    assert np.allclose(got.groupby("component")["explained"].first(), explained)
    schema = "vec_id long, embedding array<float>, label int"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None, 1)], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(i, [1.0, 2.0], 1) for i in range(5)], schema)).count() == 0
    # a flat direction has no component
    flat = whitening.whiten(spark.createDataFrame([(i, [float(i), 2.0], 1) for i in range(5)], schema)).toPandas()
    assert set(flat["component"]) == {1} and abs(flat["explained"][0] - 1) < 1e-12


def test_whitening_deviation_beyond_64_bits(spark):
    rows = [(i, [float(s) * 2.0**29, float(i)]) for i, s in enumerate([-1, 1] * 30)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).toPandas()
    assert got["deviation"].isna().all() and got["identity_error"].iat[0] < 1e-6


# --- quality rules ---

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = collections.Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)]


def test_counts_against_brute_force():
    rng = random.Random(3)
    parts = ["a", "b", "été", "#|", "　", "\x85", "x" * 30, "\U0001f600"]
    texts = ["", " \t\n", "a b c d e f g h a b c d e f g h", "a b\r\na b\r\na b \n\n \n", "one " * 9, "\x1c\x1d a \xa0 b", "&&" * 5]
    for _ in range(300):
        texts.append("".join(rng.choice(parts) + rng.choice([" ", "\n", "\t", "\r", "\x0b", "\x0c", "  "]) for _ in range(rng.randrange(80))))
    got = quality.count_texts([t.encode() for t in texts])[:, :5]
    assert got.tolist() == [brute_counts(t) for t in texts]


def test_counts_of_a_long_text_in_pieces(monkeypatch):
    rng = random.Random(4)
    text = " ".join(rng.choice("abcdefgh") * rng.randrange(1, 4) for _ in range(3000))
    monkeypatch.setattr(quality, "PIECE", 50)
    assert quality.count_texts([text.encode(), b"", ("y" * 400).encode()])[:, :5].tolist() == [brute_counts(t) for t in (text, "", "y" * 400)]


def brute_verdicts(frame):
    """Minimum covariance determinants and verdicts in numpy, unit by unit, from the contract's counts."""
    f = frame.copy()
    n = f["n_words"] + quality.STEADY
    f["x"] = list(np.round(np.array([np.log((f["word_chars"] + 5 * quality.STEADY) / n), np.sqrt(f["n_symbols"] / n),
                                     np.sqrt(f["n_dup_lines"] / (f["n_lines"] + 5)), np.sqrt(f["n_repeat_words"] / n)]).T, 6))
    f["failed"] = (f["n_words"] < 20) | (100 * f["n_repeat_words"] > 30 * f["n_words"])
    fine = f[~f["failed"]]
    sizes = {k: len(set(map(tuple, g["x"]))) for k, g in fine.groupby(["lang", "source"])}
    rest = collections.Counter()
    for (lang, _), many in sizes.items():
        rest[lang] += many if many < 50 else 0
    unit = {k: k if many >= 50 else k[0] if rest[k[0]] >= 50 else "" for k, many in sizes.items()}
    found = collections.defaultdict(set)
    for lang, source, x in zip(fine["lang"], fine["source"], fine["x"]):
        found[unit[lang, source]].add(tuple(x))
    rules = {}
    for name, rows in found.items():
        v = np.array(sorted(rows))
        if len(v) < 50:
            continue

        def estimate(w, share):
            c = (w.T @ w / len(w) - np.outer(w.mean(0), w.mean(0))) * quality.consistency(round(share, 6)) + np.diag(quality.FLOORS**2)
            return w.mean(0), np.linalg.inv(c), np.linalg.slogdet(c)[1]

        distance = lambda at, w=v: np.einsum("ni,ij,nj->n", w - at[0], at[1], w - at[0])
        q = np.quantile(v, [0.25, 0.5, 0.75], axis=0, method="inverted_cdf")
        scale = np.diag(((q[2] - q[0]) / 1.349) ** 2) + np.diag(quality.FLOORS**2)
        starts = []
        for at in (estimate(v, 1.0), (q[1], np.linalg.inv(scale), np.linalg.slogdet(scale)[1])):
            for _ in range(12):
                bucket = np.floor(16 * np.log2(distance(at) + 2.0**-20))
                edge = np.sort(bucket)[int(np.ceil(0.75 * len(v))) - 1]
                at = estimate(v[bucket <= edge], float((bucket <= edge).mean()))
            starts.append(at)
        best = min(starts, key=lambda at: at[2])
        rules[name] = estimate(v[distance(best) <= quality.chi2_quantile(0.975, 4)], 0.975)
    cut = quality.chi2_quantile(1 - 1e-6, 4)
    kept = []
    for lang, source, x, failed in zip(f["lang"], f["source"], f["x"], f["failed"]):
        at = None if failed else rules.get(unit[lang, source])
        kept.append(not failed and (at is None or float((x - at[0]) @ at[1] @ (x - at[0])) <= cut))
    return kept


def test_quality_query_against_brute_force(spark):
    got = queries.QUERIES["op12_quality_rules"](spark, SF01).toPandas().sort_values("doc_id")
    docs = spark.read.parquet(f"{SF01}/documents.parquet").toPandas().sort_values("doc_id")
    assert got["doc_id"].tolist() == docs["doc_id"].tolist()
    want = np.array([brute_counts(t) for t in docs["text"]])
    assert (got[quality.COUNTS].to_numpy() == want).all()
    frame = pd.DataFrame(want, columns=quality.COUNTS).assign(
        lang=docs["lang"].tolist(), source=docs["source"].tolist(),
        n_lines=[sum(bool(WORD.search(line)) for line in t.split("\n")) for t in docs["text"]])
    verdict = brute_verdicts(frame)
    assert got["kept"].tolist() == verdict
    # both rules decide, and clean prose is kept
    assert (~got["kept"] & ~got["base_failed"]).sum() > 20
    clean = ~got["base_failed"] & (got["n_symbols"] == 0) & (got["n_repeat_words"] == 0)
    assert got["kept"][clean].mean() > 0.99


def test_quality_units_outliers_and_copies(spark):
    rng = random.Random(5)
    say = lambda n, tail="": " ".join("".join(rng.choice("aeinrst") for _ in range(rng.randrange(2, 9))) + tail for _ in range(n))
    rows = [(i, say(rng.randrange(30, 200)), "en", "big", "k") for i in range(200)]
    rows += [(1000 + i, say(80), "en", f"small{i % 20}", "k") for i in range(80)]  # judged together
    rows += [(2000 + i, say(80), "xx", "few", "k") for i in range(5)]  # too few: nothing is rejected
    junk = say(60, "###")
    rows += [(3000 + i, junk, "en", "big", "k") for i in range(400)]  # two thirds of the unit are copies of one junk text
    rows += [(4000, say(60, "&&&"), "en", "small3", "k"), (4001, say(60, "&&&"), "xx", "few", "k")]
    rows += [(5000, None, None, None, "k"), (5001, "", "en", "big", "k"), (None, say(50), None, "big", "k"), (5002, "w " * 40, "en", "big", "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, kept string")
    got = quality.judge(df).toPandas()
    assert len(got) == len(rows)
    kept = got.set_index("doc_id")["kept"]
    assert kept[range(200)].all() and kept[range(1000, 1080)].all() and kept[range(2000, 2005)].all()
    assert not kept[range(3000, 3400)].any() and not kept[4000] and kept[4001]
    assert not kept[5000] and not kept[5001] and not kept[5002]
    assert got.set_index("doc_id")["base_failed"][[5000, 5001, 5002]].all()
    assert got[got["doc_id"].isna()]["kept"].tolist() == [True]
    assert quality.judge(df.limit(0)).count() == 0
    assert quality.judge(df.where("text is null")).select("kept").collect()[0][0] is False


def test_chi_square():
    assert abs(quality.chi2_quantile(0.95, 4) - 9.487729) < 1e-5 and abs(quality.chi2_share(12.591587, 6) - 0.95) < 1e-6
    assert quality.consistency(1.0) == 1.0 and quality.consistency(0.5) > 1.5


# --- prefix trie ---


def brute_trie(sequences, length):
    """Nodes of the trie over {conv_id: sequence}: rows as op13 returns them."""
    members = collections.defaultdict(list)
    for c, seq in sequences.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, who in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(who) - 1) * length(p[-1]) if p else 0
    ends = lambda p: ",".join(map(str, sorted(c for c in members[p] if len(sequences[c]) == len(p))))
    return sorted((min(who), len(p), min(members[p[:-1]]) if p else None, len(who), children[p], leaves[p], saved[p],
                   hashlib.sha256(ends(p).encode()).hexdigest()) for p, who in members.items()) if sequences else []


def trie_rows(nodes, ends):
    digests = {r[0]: r[1] for r in prefixtrie.digest_of_ends(ends).collect()}
    none = hashlib.sha256(b"").hexdigest()
    return sorted((r["conv_id"], r["depth"], r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"],
                   digests[r["end_key"]] if r["end_key"] else none) for r in nodes.collect())


@pytest.mark.parametrize("segment,shard", [(512, 100_000), (512, 7), (3, 11), (1, 4)])
def test_trie_against_brute_force(spark, segment, shard):
    rng = random.Random(segment * shard)
    most = 9 if segment > 1 else 5  # every segment is a round
    sequences = {c: [rng.randrange(2) for _ in range(rng.randrange(0, most))] for c in range(70)}
    sequences |= {100 + c: [0, 1, 0, 1, 1][:most - 1] for c in range(30)} | {-5: [], 300: [7] * 2 * most, 301: [7] * most}
    rows = [(c, pos, token, 10 + token) for c, seq in sequences.items() for pos, token in enumerate(seq)]
    encoded = spark.createDataFrame(rows, "conv_id long, pos long, token long, chars long")
    members = spark.createDataFrame([(c,) for c in sequences] * 2, "conv_id long")
    nodes, ends = prefixtrie.build(encoded, members, segment_turns=segment, shard_turns=shard)
    assert trie_rows(nodes, ends) == brute_trie(sequences, lambda token: 10 + token)


def rebuilt(turns):
    """The contract's rebuilt conversations from (conv_id, turn, role, text) rows."""
    own = collections.defaultdict(list)
    for c, turn, role, text in turns:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest(), role, text))
    seqs = {c: [t[3:] for t in sorted(rows)] for c, rows in own.items()}
    out = {}
    for c, seq in seqs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = seqs.get(c - c % 100, [])[:h] + seq[h:]
    return out


def op13_rows(spark, tmp_path, turns):
    schema = "conv_id long, turn long, role string, text string, depth string"
    spark.createDataFrame([(*t, "k") for t in turns], schema).write.mode("overwrite").parquet(f"{tmp_path}/conversations.parquet")
    out = queries.QUERIES["op13_conversation_prefix_trie"](spark, str(tmp_path))
    return sorted(tuple(r) for r in out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect())


def test_trie_query_on_edges(spark, tmp_path):
    rng = random.Random(9)
    turns = []
    for c in [*range(0, 40), *range(195, 260), 500, 501, 777]:
        for k in range(rng.randrange(1, 9)):
            turns.append((c, k, rng.choice(["user", "assistant", None]), rng.choice(["hi", "yes", None, "", "é\U0001f600"])))
    turns += [(5, 3, "user", "hi"), (5, 3, "user", "hi"), (6, None, "user", "first"), (None, 0, "user", "nobody"), (7, 10**12, "user", "late"), (8, -4000, "user", "early")]
    turns += [(300, k, "user", "long " * 1000 if k == 3 else f"t{k}") for k in range(1300)]  # over two number buckets and three segments
    assert op13_rows(spark, tmp_path / "a", turns) == brute_trie(rebuilt(turns), lambda turn: len(turn[1]))


def test_trie_query_of_nothing(spark, tmp_path):
    assert op13_rows(spark, tmp_path, []) == []
    assert op13_rows(spark, tmp_path, [(None, 0, "user", "x")]) == []


def test_trie_of_one_group_of_copies_is_streamed(spark, tmp_path):
    turns = [(c, k, "user", f"t{k}") for c in range(1000, 1900) for k in range(6)]
    got = op13_rows(spark, tmp_path, turns)
    assert got == brute_trie(rebuilt(turns), lambda turn: len(turn[1]))
    plan = prefixtrie.digest_of_ends(spark.createDataFrame([(1, "a")], "conv_id long, end_key string"))._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "FlatMapGroups" not in plan


def test_tree_is_balanced_by_medians():
    tree = prefixtrie.TernaryTree()
    top = tree.node(None, -1, 0, 0)
    for row in prefixtrie.medians(1023):
        tree.insert(top, [row], [1], 1, row, row)

    def height(at):
        return 0 if at < 0 else 1 + max(height(tree.lower[at]), height(tree.higher[at]))

    assert sorted(prefixtrie.medians(1023)) == list(range(1023)) and height(tree.equal[top]) == 10


def test_encoded_turns_are_numbered_over_buckets(spark):
    rows = [(1, k * 700 - 3000, "user", str(k)) for k in range(12)] + [(1, None, "user", "null")]
    got = prefixtrie.encode(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).orderBy("pos").collect()
    assert [r["pos"] for r in got] == list(range(13)) and [r["chars"] for r in got] == [4] + [len(str(k)) for k in range(12)]
    assert got[0]["token"] not in {r["token"] for r in got[1:]} and F is not None
