"""Packing, language ID, toxicity, SentencePiece and token counts on edge cases and brute force."""

import math
import random
import re
import zlib

import numpy as np
import pytest

import public_tokenizers as P
from corpusflow.llm import langid, packing, queries, spm, tokencount, toxicity
from conftest import SF01

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, ids string, language string, toxicity string"
EDGES = [None, "", " \t\n", "1234 ... !?", "²", "naïve café 中文 😀", "a" * 3000, "word " * 30000, "x▁y ▁▁", "tie", "tie", "<|endoftext|> [INST]"]


def docs(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t, "en", "s", 1, 0.5, "x", "y", "z") for i, t in enumerate(texts)], SCHEMA)


@pytest.fixture(scope="module")
def edges(spark):
    rows = docs(spark, EDGES).unionByName(docs(spark, [EDGES[5]], 5))
    return rows.unionByName(spark.createDataFrame([(None, "no id", None, None, None, None, None, None, None)], SCHEMA))


# --- packing ---

def check_sequences(pdf, limit=2048):
    pdf = pdf.sort_values(["sequence_id", "offset"])
    by = pdf.groupby("sequence_id")["length"]
    assert (by.cumsum() - pdf.length == pdf.offset).all() and by.sum().max() <= limit


def test_ids_equal_the_files_own_library():
    from tokenizers import Tokenizer
    own = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    encode = packing.byte_bpe(P.path("byte_bpe_50k.json"))
    rng = random.Random(3)
    texts = [t or "" for t in EDGES] + ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0xD800), rng.randrange(0x10000, 0x1F900), 10, 32])) for _ in range(60)) for _ in range(200)]
    texts += ["<|endoftext|>", "a<|endoftext|><|endoftext|> b", " <|endoftext|>\n\n c", "<|endoftext|", "x \n <|endoftext|>y"]
    assert [encode(t).tolist() for t in texts] == [e.ids for e in own.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("run", [" ", "\n", " \n\t\u3000", "a", "1", "!?"])
def test_ids_of_very_long_runs(run):
    from tokenizers import Tokenizer
    own = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    encode = queries.byte_bpe_encoder()
    for text in (run * (2_000_000 // len(run)), "x" + run * (1_000_000 // len(run)) + "y <|endoftext|> z"):
        assert np.array_equal(encode(text), own.encode(text, add_special_tokens=False).ids)


def test_ids_of_every_document(spark):
    from tokenizers import Tokenizer
    own = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rows = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").toPandas()
    ids = {d: np.array([*own.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4") for d, t in zip(rows.doc_id, rows.text)}
    got = queries.op8(spark, SF01).toPandas()
    assert set(got.doc_id) == set(ids)
    for d, start, length, crc, whole in zip(got.doc_id, got.start, got.length, got.ids_crc32, got.doc_tokens):
        assert whole == len(ids[d]) and zlib.crc32(ids[d][start:start + length].tobytes()) == crc


def test_packing_edges(spark, edges):
    got = packing.pieces(packing.pack(edges, queries.byte_bpe_encoder, end_id=1, cut=True)).toPandas()
    check_sequences(got)
    encode = queries.byte_bpe_encoder()
    want = {}
    for i, t in [*enumerate(EDGES), (5, EDGES[5]), (None, "no id")]:
        want.setdefault(i, []).append(np.append(encode(t or ""), 1).astype("<u4"))
    for i, all_ids in want.items():
        mine = got[got.doc_id.isna()] if i is None else got[got.doc_id == i]
        assert mine.length.sum() == sum(map(len, all_ids)) and set(mine.doc_tokens) == {len(all_ids[0])}
        for start, length, crc in zip(mine.start, mine.length, mine.ids_crc32):
            assert zlib.crc32(all_ids[0][start:start + length].tobytes()) == crc
    assert packing.pack(docs(spark, []), queries.byte_bpe_encoder, end_id=1).count() == 0


def test_packing_table_is_whole_and_tight(spark):
    got = queries.op8(spark, SF01).toPandas()
    check_sequences(got)
    by_doc = got.sort_values(["doc_id", "start"]).groupby("doc_id")
    assert (by_doc["length"].sum() == by_doc["doc_tokens"].first()).all() and got.doc_id.nunique() == 1000
    fill = got.groupby("sequence_id")["length"].sum()
    assert sum(2048 - n for n in fill if n & (n - 1)) < 0.002 * fill.sum()


def test_packer_keeps_every_limit():
    rng = np.random.default_rng(0)
    for cut in (False, True):
        packer = packing.DotProductPacker(64, 4, 32, window=16, cut=cut)
        items = [(int(n), int(rng.integers(0, n + 1))) for n in rng.integers(1, 150, 400)]
        placed = [p for k, (n, loss) in enumerate(items) for p in packer.add(k, n, loss)] + list(packer.finish())
        bins, tokens, losses = {}, {}, {}
        for key, start, length, loss, bin_, offset in placed:
            assert bins.setdefault(bin_, [0, 0, 0])[0] == offset
            bins[bin_][0] += length
            bins[bin_][1] += 1
            bins[bin_][2] += loss
            tokens.setdefault(key, []).append((start, length))
            losses[key] = losses.get(key, 0) + loss
        assert all(a <= 64 and b <= 4 and c <= 32 for a, b, c in bins.values())
        for key, (n, loss) in enumerate(items):
            at = 0
            for start, length in sorted(tokens[key]):
                assert start == at
                at += length
            assert at == n and losses[key] == loss


def test_packing_whole_examples_under_loss_limit(spark):
    rows = spark.createDataFrame([(i, "a b c d e f g h " * (i % 7), i % 5) for i in range(200)], "doc_id long, text string, loss long")
    got = packing.pack(rows, queries.byte_bpe_encoder, loss_col="loss", end_id=1, max_tokens=128, max_segments=6, max_loss=8).toPandas()
    by = got.groupby("sequence_id")
    assert by.size().max() <= 6 and by.loss_tokens.sum().max() <= 8 and got.doc_id.nunique() == len(got) == 200


# --- language ID ---

def test_language_edges(spark, edges):
    model = langid.fit(spark.read.parquet(f"{SF01}/documents.parquet"))
    got = langid.identify(edges, model).select("doc_id", "text", "language.*").collect()
    assert len(got) == len(EDGES) + 2
    for r in got:
        letters = any(map(str.isalpha, r["text"] or ""))
        assert 0 <= r["score"] <= 1 and (r["lang"] == "und") == (not letters)
    nothing = langid.fit(docs(spark, []))
    assert [r[0] for r in langid.identify(edges, nothing).select("language.lang").distinct().collect()] == ["und"]
    assert langid.identify(docs(spark, []), model).count() == 0


def test_language_held_out_accuracy(spark):
    got = queries.op10(spark, SF01).join(spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got.held_out]
    assert len(got) == 1000 and (held.lang == held.lang_pred).mean() > 0.98
    assert all(h == (zlib.crc32(str(i).encode()) % 3 == 1) for i, h in zip(got.doc_id, got.held_out))


def plain_language(model, text):
    """Family first, then votes of the pairs, from counts of hashed trigrams taken one by one."""
    if not any(map(str.isalpha, text or "")):
        return "und", 0.0
    raw = b" " + bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in text.lower().encode()) + b" "
    counts = {}
    for a, b, c in zip(raw, raw[1:], raw[2:]):
        h = (a * 0x9E3779B1 ^ b * 0x85EBCA77 ^ c * 0xC2B2AE3D) & 0xFFFFFFFF
        bucket = (h ^ h >> 15) % langid.DIM
        counts[bucket] = counts.get(bucket, 0) + 1
    at, x = list(counts), np.sqrt(list(counts.values())) / len(raw[2:]) ** 0.5
    say = {}
    for (kind, a, b), w, bias, scale in zip(model.heads, model.weights, model.bias, model.scale):
        say[kind, a, b] = 1 / (1 + np.exp(-scale * (w[at] @ x + bias)))
    p_family = {f: say.get(("family", f, None), 1.0) for f in model.families}
    family = max(sorted(p_family), key=p_family.get)
    members = model.families[family]
    votes = {}
    for m in members:
        for_m = [say["pair", m, o] if ("pair", m, o) in say else 1 - say["pair", o, m] for o in members if o != m]
        votes[m] = (sum((say["pair", m, o] >= 0.5) if ("pair", m, o) in say else (say["pair", o, m] < 0.5) for o in members if o != m),
                    sum(for_m) / len(for_m) if for_m else 1.0)
    best = max(members, key=votes.get)
    return best, p_family[family] * votes[best][1]


def test_language_query_against_brute_force(spark):
    model = queries.language_model(spark, SF01)
    assert len(model.families) > 1 and max(map(len, model.families.values())) > 1
    got = queries.op10(spark, SF01).join(spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text"), "doc_id").collect()
    assert len(got) == 1000
    for r in got:
        lang, score = plain_language(model, r["text"])
        assert r["lang_pred"] == lang and abs(r["score"] - score) < 1e-9


def test_language_sample_is_bounded(spark):
    words = {"en": "the thing with those", "de": "der schein auf dich", "fr": "eau les deux chez", "aa": "qzq zzz", "ab": "kwk www"}
    rows = [(i, f"{words[k]} {i}", k) for i, k in enumerate(["en"] * 40 + ["de"] * 30 + ["fr"] * 20 + ["aa"] * 9 + ["ab"] * 2)]
    table = spark.createDataFrame(rows + [rows[0]] * 500, "doc_id long, text string, lang string")
    learned = lambda **kw: {m for f in langid.fit(table, **kw).families.values() for m in f}
    assert learned() == {"en", "de", "fr", "aa"} and learned(max_langs=2) == {"en", "de"}
    model = langid.fit(table, max_docs=12)
    assert [model.predict(words[k] + " 5")[0] for k in ("en", "de", "fr", "aa")] == ["en", "de", "fr", "aa"]


def test_language_sample_holds_different_texts(spark):
    """Rows without a letter, copies and repeated ids take no place of the sample."""
    words = {"en": "the thing with those", "de": "der schein auf dich"}
    good = [(i, f"{words[k]} {i}", k) for i, k in enumerate(["en", "de"] * 20)]
    empty = [(1000 + i, (None, "", "12 + 34")[i % 3], "en") for i in range(3000)] + [(9000 + i, None, "xx") for i in range(50)]
    copies = [(5000 + i, "der schein auf dich 1", "de") for i in range(3000)] + [(10_000 + i, "qzq zzz", "yy") for i in range(50)]
    often = [good[0]] * 500
    fit = lambda rows: langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), per_lang=30)
    want, got = fit(good), fit(good + empty + copies + often)
    assert got.families == want.families == {"germanic": ["de", "en"]}
    assert np.allclose(got.weights, want.weights, atol=1e-6) and np.allclose(got.bias, want.bias, atol=1e-6)


def test_families_with_single_and_unlisted_languages():
    rng = random.Random(0)
    words = {"en": ["the", "thing"], "de": ["der", "schein"], "fr": ["eau", "les"], "xx": ["qzq", "zzz"]}
    texts = [(k, " ".join(rng.choice(v) for _ in range(20))) for k, v in words.items() for _ in range(20)]
    x = np.stack([langid.features(t) for _, t in texts]).astype(np.float32)
    model = langid.LanguageModel(list(words)).fit(x, np.array([k for k, _ in texts], dtype=object))
    assert [model.predict(t)[0] for _, t in texts] == [k for k, _ in texts]


# --- toxicity ---

def test_forward_backward_equals_the_plain_recursion():
    rng = np.random.default_rng(1)
    a, start = np.exp(rng.normal(size=(2, 2))), -0.7
    lengths = np.array([1, 5, 127, 128, 129, 300, 1000])
    e = rng.normal(size=lengths.sum()) * 2 - 1
    got = toxicity.sigmoid(toxicity._messages(e, lengths, a, start) + toxicity._messages(e[::-1], lengths[::-1], a.T, 0.0)[::-1] - e)
    at = 0
    for n in lengths:
        g = np.exp(e[at:at + n])
        alpha, beta = np.zeros((n, 2)), np.ones((n, 2))
        alpha[0] = 1, g[0] * np.exp(start)
        for t in range(1, n):
            alpha[t] = alpha[t - 1] / alpha[t - 1].sum() @ a * [1, g[t]]
        for t in range(n - 2, -1, -1):
            beta[t] = a @ (beta[t + 1] / beta[t + 1].sum() * [1, g[t + 1]])
        want = (alpha * beta)[:, 1] / (alpha * beta).sum(axis=1)
        assert np.allclose(got[at:at + n], want, atol=1e-9)
        at += n


@pytest.fixture(scope="module")
def model(spark):
    table = spark.read.parquet(f"{SF01}/documents.parquet")
    return toxicity.fit(table, spark.read.parquet(f"{SF01}/labels.parquet").where(~langid.held_out("doc_id", 4, 2)))


def test_toxicity_edges(spark, edges, model):
    more = edges.unionByName(docs(spark, ["you IDIOT, stupid moron and " + "the " * 50000 + "scum"], 100))
    got = {r["doc_id"]: r for r in toxicity.score(more, model).select("doc_id", "text", "toxicity.*").collect()}
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert got[0]["score"] == got[1]["score"] == got[2]["score"] < 0.3
    assert got[100]["score"] >= 0.3
    words = [got[100]["text"][s["start"]:s["end"]] for s in got[100]["spans"]]
    assert "IDIOT" in words[0] and words[-1] == "scum"
    assert toxicity.score(docs(spark, []), model).count() == 0
    unlearned = toxicity.fit(edges, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r[0] for r in toxicity.score(edges, unlearned).select("toxicity.score").collect()} == {0.0}


def test_toxicity_held_out(spark):
    got = queries.op4(spark, SF01).join(spark.read.parquet(f"{SF01}/labels.parquet"), "doc_id").toPandas()
    held = got[got.held_out]
    assert (held.predicted == held.toxic).mean() > 0.92 and held[held.toxic == 0].predicted.mean() < 0.02


def plain_toxicity(model, text, threshold=0.5):
    """Score and spans of one text: the recursion word by word, nothing in blocks or batches."""
    found = list(re.finditer(r"\w+", text))
    gain = []
    for m in found:
        word = m.group().lower()
        features = [word] + [f"^{word[:k]}" for k in toxicity.PREFIXES if k < len(word)]
        gain.append(math.exp(model.bias + math.fsum(model.weights.get(f, 0.0) for f in features)))
    (cc, ct), (tc, tt) = model.trans.tolist()
    alpha, beta, marginal = [], [], []
    for t, g in enumerate(gain):
        c, x = (1.0, math.exp(model.start)) if t == 0 else (alpha[-1][0] * cc + alpha[-1][1] * tc, alpha[-1][0] * ct + alpha[-1][1] * tt)
        alpha.append((c / (c + x * g), x * g / (c + x * g)))
    c, x = 1.0, 1.0
    for g in reversed(gain):
        beta.append((c, x))
        c, x = cc * c + ct * g * x, tc * c + tt * g * x
        c, x = c / (c + x), x / (c + x)
    for (a0, a1), (b0, b1) in zip(alpha, reversed(beta)):
        marginal.append(a1 * b1 / (a0 * b0 + a1 * b1))
    top = min(max([1e-4, *marginal]), 1 - 1e-4)
    many = math.fsum(m for m in marginal if m > 0.2)
    signs = [math.log(top / (1 - top)), math.log1p(many), math.log1p(1000 * many / (len(found) + 20)), 1.0]
    spans = []
    for k, (m, p) in enumerate(zip(found, marginal)):
        if p < threshold:
            continue
        if k and marginal[k - 1] >= threshold:
            spans[-1] = (spans[-1][0], m.end(), max(spans[-1][2], p))
        else:
            spans.append((m.start(), m.end(), p))
    return 1 / (1 + math.exp(-float(np.dot(signs, model.head)))), spans


def test_toxicity_query_against_brute_force(spark, model):
    got = queries.op4(spark, SF01).join(spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text"), "doc_id").collect()
    assert len(got) == 1000 and sum(bool(r["spans"]) for r in got) > 20
    for r in got:
        score, spans = plain_toxicity(model, r["text"] or "")
        assert abs(r["score"] - score) < 1e-7 and r["predicted"] == (r["score"] >= 0.3)
        assert [(s["start"], s["end"]) for s in r["spans"]] == [s[:2] for s in spans]
        assert np.allclose([s["marginal"] for s in r["spans"]], [s[2] for s in spans], atol=1e-7)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)


def test_toxicity_places_go_to_texts(spark):
    F = queries.F
    table, labels = spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")
    columns = labels.select("doc_id", "toxic")
    empty = spark.range(10_000, 14_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "").alias("text"))
    more = columns.unionByName(empty.select("doc_id", F.lit(1).alias("toxic")))
    want = toxicity.fit(table, columns, max_docs=400)
    got = toxicity.fit(table.select("doc_id", "text").unionByName(empty), more, max_docs=400)
    assert len(want.weights) > 20 and got.weights == want.weights and np.allclose(got.head, want.head)


def test_toxicity_learns_a_rare_class(spark):
    F = queries.F
    table = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rare = labels.where((F.col("toxic") == 0) | (F.pmod(F.hash("doc_id"), F.lit(10)) == 0))  # about 1 %
    model = toxicity.fit(table, rare, max_docs=300)
    assert len(model.weights) > 10
    score = F.col("toxicity.score")
    said = toxicity.score(table.join(labels, "doc_id"), model).groupBy("toxic").agg(F.avg((score >= 0.3).cast("int")).alias("share")).collect()
    said = {r["toxic"]: r["share"] for r in said}
    assert said[0] < 0.02 and said[1] > 0.3


def test_toxicity_says_when_it_learned_nothing(spark):
    table = docs(spark, ["good text", "bad text", None])
    for marks in ([(0, 0), (1, 0)], [(0, 0), (2, 1)], [(0, 0), (1, 1)]):
        with pytest.warns(RuntimeWarning, match="nothing learned"):
            assert not toxicity.fit(table, spark.createDataFrame(marks, "doc_id long, toxic int")).weights


def test_toxicity_sample_passes_over_what_does_not_fit(spark):
    table, labels = spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")
    F = queries.F
    marked = table.join(labels.where("toxic is not null"), "doc_id").select("doc_id", F.length("text").alias("n"))
    (first, n1), (second, n2) = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(2).collect()
    bound = marked.agg(F.sum("n")).first()[0]
    rest = table.where(F.col("doc_id") != first)
    want = toxicity.fit(rest, labels)
    assert want.weights
    # in the order of the sample an over-long text comes first, an id of very many rows next
    long = table.where(F.col("doc_id") == first).withColumn("text", F.repeat("text", 1 + bound // n1))
    often = table.where(F.col("doc_id") == second).crossJoin(spark.range(1 + bound // n2).select())
    got = toxicity.fit(rest.unionByName(long).unionByName(often), labels, max_chars=bound)
    assert got.weights == want.weights and np.array_equal(got.head, want.head)


# --- SentencePiece ---

@pytest.fixture(scope="module")
def vocabulary():
    return queries.piece_vocabulary()


def viterbi(v, text):
    best, back = [0] + [-(1 << 62)] * len(text), [0] * (len(text) + 1)
    for j in range(1, len(text) + 1):
        for i in range(max(0, j - v.longest), j):
            s = v.scores.get(text[i:j], v.byte_score * len(text[i:j].encode()) if i == j - 1 else None)
            if s is not None and best[i] + s > best[j]:
                best[j], back[j] = best[i] + s, i
    path, at = [], len(text)
    while at:
        path.append((back[at], at))
        at = back[at]
    return path[::-1]


def test_streaming_viterbi_equals_the_whole_one(vocabulary):
    rng = random.Random(0)
    for k in range(150):
        text = " " + "".join(rng.choice(["the", "tion", "ing", " a", "and", " ", "é", "中", "x9", "\n", "²"]) for _ in range(rng.randint(0, 80)))
        assert list(vocabulary.segment(text)) == viterbi(vocabulary, text)
        assert vocabulary.encode(text[1:]) == (vocabulary.encode_word(text) if len(text) > 1 else b"")


def test_streaming_commits_before_the_end(vocabulary):
    seen = []

    class Text(str):
        def __getitem__(self, at):
            seen.append(at.stop if isinstance(at, slice) else at)
            return str.__getitem__(self, at)

    pieces = vocabulary.segment(Text("thingtion" * 500))
    next(pieces)
    assert max(seen) < 4500


def test_round_trip_of_edges(spark, edges, vocabulary):
    back = spm.decode(spm.encode(edges, queries.piece_vocabulary), queries.piece_vocabulary).select("text", "ids", "decoded").collect()
    for r in back:
        assert r["decoded"] == r["text"]
        assert (r["ids"] is None) == (r["text"] is None) and (r["ids"] is None or bytes(r["ids"]) == vocabulary.encode(r["text"]))
    assert spm.encode(docs(spark, []), queries.piece_vocabulary).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_streaming_over_vocabularies_that_rarely_converge(seed):
    rng = random.Random(seed)
    for _ in range(200):
        pieces = {"".join(rng.choice("ab") for _ in range(rng.randint(1, 5))) for _ in range(6)}
        v = spm.Vocabulary([(p, i, -3 * rng.random()) for i, p in enumerate(pieces)], list(range(100, 356)), [])
        text = "".join(rng.choice("ab") for _ in range(rng.randint(0, 120)))
        assert list(v.segment(text)) == viterbi(v, text)


def test_sentencepiece_query_against_brute_force(spark, vocabulary):
    """Every document as one text, not word by word, by a Viterbi that keeps all of it."""
    rows = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for r in rows:
        text = " " + r["text"] if r["text"] else ""
        ids = []
        for i, j in viterbi(vocabulary, text):
            piece = vocabulary.ids.get(text[i:j])
            ids += [piece] if piece is not None else [vocabulary.bytes[b] for b in text[i:j].encode()]
        raw = np.array(ids, "<u4").tobytes()
        want[r["doc_id"]] = (len(ids), zlib.crc32(raw), len(r["text"] or ""), True)
    got = {r[0]: tuple(r)[1:] for r in queries.op2(spark, SF01).collect()}
    assert len(rows) == len(got) == 1000 and got == want


# --- token counts ---

def greedy(word, begins, continues):
    n = at = 0
    while at < len(word):
        pieces = continues if at else begins
        end = next((j for j in range(len(word), at, -1) if word[at:j] in pieces), None)
        if end is None:
            return 0
        n, at = n + 1, end
    return n


def test_automaton_equals_greedy_matching():
    rng = random.Random(1)
    word = lambda most: "".join(rng.choice("abcd") for _ in range(rng.randint(1, most)))
    for _ in range(300):
        begins, continues = {word(5) for _ in range(6)}, {word(5) for _ in range(8)}
        automaton = tokencount.LongestMatch(begins, continues)
        for _ in range(20):
            w = word(14)
            assert automaton.count(w) == greedy(w, begins, continues)


def test_token_counts_of_edges(spark, edges):
    automaton = queries.word_piece_automaton()
    got = tokencount.count_tokens(edges, queries.word_piece_automaton).select("text", "token_count.*").collect()
    for r in got:
        counts = [automaton.count(w) for w in (r["text"] or "").split()]
        assert (r["words"], r["unknown"]) == (len(counts), counts.count(0)) and r["tokens"] == sum(counts) + counts.count(0)
    assert tokencount.count_tokens(docs(spark, []), queries.word_piece_automaton).count() == 0


def test_token_count_query_against_brute_force(spark):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    pieces = [sp.id_to_piece(i) for i in range(len(sp)) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i))]
    continues = {p for p in pieces if "▁" not in p}
    begins = {p[1:] for p in pieces if p.startswith("▁") and p.count("▁") == 1 and len(p) > 1} | {p for p in continues if len(p) == 1}
    seen = {}
    want = {}
    for r in spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").collect():
        words = (r["text"] or "").split()
        counts = [seen[w] if w in seen else seen.setdefault(w, greedy(w, begins, continues)) for w in words]
        want[r["doc_id"]] = (len(words), sum(counts) + counts.count(0), counts.count(0))
    got = {r[0]: tuple(r)[1:] for r in queries.op9(spark, SF01).collect()}
    assert len(got) == 1000 and got == want
