"""C1 invariants, V1/V3/V4/M2/M3 against brute force, Q&A figures, upserts."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusflow.functions import vectors as VF
from corpusflow.operators import chunk as ch
from corpusflow.operators import qa as QA
from corpusflow.operators import vectors as V
from corpusflow.sources import sinks


# --- C1 ---------------------------------------------------------------------

CHUNK_CASES = ["", "one", " lead and trail ", " ".join(f"w{i}" for i in range(10)),
               " ".join(f"w{i}" for i in range(11)), "x" * 50, "a  b"]


def test_word_chunks_invariants(spark):
    budget = 5
    df = spark.createDataFrame([(i, t) for i, t in enumerate(CHUNK_CASES)], "doc_id int, content string")
    out = ch.word_chunks(df, "content", keep=["doc_id"], budget=budget).collect()
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append((r.chunk_idx, r.content))
    for i, text in enumerate(CHUNK_CASES):
        parts = [c for _, c in sorted(by.get(i, []))]
        assert [k for k, _ in sorted(by.get(i, []))] == list(range(len(parts)))  # dense idx
        if not text.strip():
            assert parts == []
            continue
        assert "".join(parts) == text  # trim_chunks=False: nothing lost
        assert all(len(p.split()) <= budget for p in parts)
        assert len(parts) == math.ceil(len(text.split()) / budget)
    counts = df.select("doc_id", ch.word_chunk_count("content", budget).alias("n")).collect()
    assert {r.doc_id: r.n for r in counts} == {i: len(by.get(i, [])) for i in range(len(CHUNK_CASES))}


def test_token_packer_invariants():
    rnd = random.Random(3)
    words = ["alpha", "be", "c.", "delta!", "e?", "ffff", "\n"]
    for _ in range(200):
        text = " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 80)))
        budget = rnd.randint(1, 12)
        parts = ch.pack_chunks(text, budget, ch.whitespace_token_count)
        assert "".join(parts) == text
        assert all(ch.whitespace_token_count(p) <= budget for p in parts)


def test_token_chunk_udf(spark):
    df = spark.createDataFrame([("a b c. d e f. g",), (None,)], "content string")
    out = df.select(ch.token_chunk_udf(budget=3)("content").alias("c")).collect()
    assert "".join(out[0].c) == "a b c. d e f. g" and out[1].c == []


# --- vectors ------------------------------------------------------------------

def _cos(a, b):
    na, nb = np.linalg.norm(a), np.linalg.norm(b)
    return float(a @ b / (na * nb)) if na > 0 and nb > 0 else None


def test_topk_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    pts = rng.normal(size=(300, 8)).astype("float32")
    pts[7] = 0.0  # zero vector
    pts[11] = pts[10]  # exact tie, broken by id
    qs = rng.normal(size=(4, 8))
    qs[3] = pts[10]
    pdf = spark.createDataFrame([(i, pts[i].tolist(), i % 3) for i in range(300)],
                                "point_id long, embedding array<float>, source int").repartition(5)
    qdf = spark.createDataFrame([(j, qs[j].tolist()) for j in range(4)], "query_id int, embedding array<double>")
    k = 7
    got = V.topk_search(pdf, qdf, k, payload=["source"], block_bytes=100).collect()
    for j in range(4):
        scores = [(_cos(qs[j], pts[i].astype("float64")), i) for i in range(300)]
        scores = [(s, i) for s, i in scores if s is not None]
        exp = sorted(scores, key=lambda t: (-t[0], t[1]))[:k]
        mine = sorted([r for r in got if r.query_id == j], key=lambda r: r["rank"])
        assert [r.point_id for r in mine] == [i for _, i in exp]
        assert all(abs(r.score - s) < 1e-9 for r, (s, _) in zip(mine, exp))


def test_topk_fewer_points_than_k(spark):
    pdf = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "point_id long, embedding array<float>")
    qdf = spark.createDataFrame([(0, [1.0, 0.0])], "query_id int, embedding array<double>")
    got = V.topk_search(pdf, qdf, 10).collect()
    assert sorted(r.point_id for r in got) == [1, 2]


def test_cosine_softmax_clamp(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0], [3.0, 2.0, 1.0]), ([0.0, 0.0, 0.0], [1.0, 0.0, 0.0])],
                               "a array<double>, b array<double>")
    r = df.select(VF.cosine("a", "b").alias("c"), VF.softmax_at("a", 0).alias("p"),
                  VF.clamp_min(F.lit(0.0)).alias("m")).collect()
    assert abs(r[0].c - 10 / 14) < 1e-12 and r[1].c is None
    e = np.exp(np.array([1.0, 2.0, 3.0]) - 3)
    assert abs(r[0].p - e[0] / e.sum()) < 1e-12 and r[0].m == 1e-9


def test_masked_mean_pool_array_form(spark):
    states = [[1.0, 2.0], [3.0, 4.0], [100.0, 100.0]]
    df = spark.createDataFrame([("c1", states, [1, 1, 0]), ("c2", states, [0, 0, 0]), ("c3", states, [1, 1, 1])],
                               "chunk_id string, states array<array<float>>, mask array<int>")
    got = {r.chunk_id: r.v for r in df.select("chunk_id", VF.masked_mean_pool("states", "mask").alias("v")).collect()}
    assert got["c1"] == [2.0, 3.0]
    assert got["c2"] == [0.0, 0.0]  # all masked: clamp to 1e-9, sums are 0
    assert [round(x, 6) for x in got["c3"]] == [round(104 / 3, 6), round(106 / 3, 6)]


def test_centroids_long_form(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], "a"), (2, [3.0, 6.0], "a"), (3, [5.0, 5.0], "b")],
                               "id long, embedding array<float>, g string")
    cv = {r.g: r.embedding for r in V.centroid_vectors(V.centroids(df, "g"), "g").collect()}
    assert cv == {"a": [2.0, 4.0], "b": [5.0, 5.0]}


def test_scroll_pages(spark):
    df = spark.createDataFrame([(i, i % 2) for i in range(25)], "point_id long, source int")
    p1 = V.scroll(df, "source", 1, limit=5).collect()
    assert [r.point_id for r in p1] == [1, 3, 5, 7, 9] and {r.next_offset for r in p1} == {11}
    last = V.scroll(df, "source", 1, limit=5, offset=21).collect()
    assert [r.point_id for r in last] == [21, 23] and {r.next_offset for r in last} == {None}


# --- Q&A --------------------------------------------------------------------------

@pytest.mark.parametrize("rows,acc,level,flags", [
    ([(0, 0, 0)], 0.0, "bad", "ok"),                      # no votes: accuracy 0
    ([(1, 1, 0), (1, 0, 1)], 100 * 2 / 3, "good", "warn"),
    ([(0, 1, 0), (1, 0, 0)], 50.0, "good", "ok"),
])
def test_kpis(spark, rows, acc, level, flags):
    df = spark.createDataFrame([("q", "a", u, d, f, 0.1) for u, d, f in rows],
                               "question string, answer string, upvote int, downvote int, flag int, Entailment double")
    k = QA.kpis(df).first()
    assert abs(k.accuracy - acc) < 1e-9 and k.accuracy_level == level and k.flags_level == flags
    assert k.avg_entailment is None and k.entailment_level == "good"  # nothing above 0.2


def test_row_state_first_match_wins(spark):
    df = spark.createDataFrame([(1, 1, 1), (0, 1, 1), (0, 0, 1), (0, 0, 0)], "upvote int, downvote int, flag int")
    assert [r.s for r in df.select(QA.row_state().alias("s")).collect()] == ["up", "down", "flag", "none"]


def test_entailment_threshold_exactly_02(spark):
    df = spark.createDataFrame([(0, 0, 0, 0.2), (0, 0, 0, 0.6)],
                               "upvote int, downvote int, flag int, Entailment double")
    assert QA.kpis(df).first().avg_entailment == 0.6


# --- sinks --------------------------------------------------------------------------

def test_upsert_frame_replaces_keys(spark):
    old = spark.createDataFrame([("d1", "s", 1), ("d2", "s", 2)], "date string, source string, count long")
    new = spark.createDataFrame([("d2", "s", 5), ("d2", "t", 1)], "date string, source string, count long")
    got = sorted(tuple(r) for r in sinks.upsert_frame(old, new, ["date", "source"]).collect())
    assert got == [("d1", "s", 1), ("d2", "s", 5), ("d2", "t", 1)]


def test_content_ids_are_stable(spark):
    df = spark.createDataFrame([("s", "d", "t", 0, "c")], "source string, publishdate string, title string, chunk_idx int, content string")
    a = sinks.with_point_id(df).first().point_id
    b = sinks.with_point_id(df).first().point_id
    assert a == b and len(a) == 64


def test_scroll_301_rows_and_empty_source(spark):
    df = spark.createDataFrame([(i, "big") for i in range(301)] + [(1000, "other")], "point_id long, source string")
    page = V.scroll(df, "source", "big").collect()
    assert len(page) == 300 and {r.next_offset for r in page} == {300}
    rest = V.scroll(df, "source", "big", offset=300).collect()
    assert [r.point_id for r in rest] == [300] and rest[0].next_offset is None
    assert V.scroll(df, "source", "none").count() == 0


def test_token_packer_word_longer_than_budget():
    text = "short " + "x" * 30 + " end"
    parts = ch.pack_chunks(text, 10, len)  # character counter
    assert "".join(parts) == text and all(len(p) <= 10 for p in parts)


def test_preview_of_short_question(spark):
    df = spark.createDataFrame([("why?", 0, 0, 0)], "question string, upvote int, downvote int, flag int")
    r = QA.qa_table(df).first()
    assert r.preview == "why?..." and r.state == "none"


def test_row_wise_cosine_and_display_format(spark):
    from corpusflow.functions import text as tx
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0], 49.995)], "q array<double>, a array<double>, x double")
    r = QA.with_cosine_similarity(df, "q", "a").select("cosine_similarity", tx.fmt2("x").alias("t")).first()
    assert abs(r.cosine_similarity - 2 ** -0.5) < 1e-12
    assert r.t in ("50.00", "49.99")  # display only; Java rounds the decimal text half-up


def test_embed_reports_truncation(spark):
    from functools import partial

    from corpusflow.operators import embed as EM
    df = spark.createDataFrame([("a b c",), ("a b c d e f",)], "content string")
    out = EM.embed_column(df, "content", partial(EM.hashing_embedder, 8), model_limit=4).collect()
    assert [r.truncated for r in out] == [False, True] and all(len(r.embedding) == 8 for r in out)


def test_upsert_counts_partitions(spark):
    import os
    import tempfile
    path = os.path.join(tempfile.mkdtemp(prefix="cf-upsert-"), "daily")
    sch = "date string, source string, count long"
    sinks.upsert_counts(spark.createDataFrame([("d1", "s1", 1)], sch), path, ["date", "source"])
    sinks.upsert_counts(spark.createDataFrame([("d1", "s2", 2)], sch), path, ["date", "source"])  # new key, old date
    sinks.upsert_counts(spark.createDataFrame([("d1", "s1", 5)], sch), path, ["date", "source"])  # same key again
    got = sorted((r.date, r.source, r["count"]) for r in spark.read.parquet(path).collect())
    assert got == [("d1", "s1", 5), ("d1", "s2", 2)]


def test_iter_pages_walks_whole_source(spark):
    df = spark.createDataFrame([(i, "a" if i % 3 else "b") for i in range(50)], "point_id long, source string")
    pages = [sorted(r.point_id for r in p.collect()) for p in V.iter_pages(df, "source", "a", limit=7)]
    assert [len(p) for p in pages] == [7, 7, 7, 7, 5]
    assert sum(pages, []) == [i for i in range(50) if i % 3]


def test_unscorable_vectors_are_left_out(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i + 1), 1.0]) for i in range(20)] + [(100 + i, [nan, 1.0]) for i in range(40)]
    rows += [(200, None), (201, [None, 1.0]), (202, [0.0, 0.0]), (203, [1.0]), (204, [inf, 1.0]), (205, [])]
    pts = spark.createDataFrame(rows, "point_id long, embedding array<float>")
    qs = spark.createDataFrame([(0, [1.0, 1.0]), (1, [0.0, 0.0]), (2, [nan, 1.0]), (3, None)], "query_id int, embedding array<double>")
    for metric in ("cosine", "dot"):
        got = V.topk_search(pts, qs, 5, metric=metric).collect()
        best = sorted((r["rank"], r.point_id) for r in got if r.query_id == 0)
        want = [19, 18, 17, 16, 15] if metric == "dot" else [0, 1, 2, 3, 4]
        assert [p for _, p in best] == want
        assert {r.query_id for r in got} == ({0} if metric == "cosine" else {0, 1})
    assert V.topk_search(pts, qs.limit(0), 5).count() == 0
    for r in pts.select(VF.cosine("embedding", "embedding").alias("c"), V.scorable("embedding").alias("s")).collect():
        assert r.s == (r.c is not None and r.c == r.c)


def test_many_queries_in_blocks(spark):
    rng = np.random.default_rng(0)
    p, q = rng.normal(size=(500, 6)), rng.normal(size=(300, 6))
    pts = spark.createDataFrame([(f"p{i:03d}", p[i].tolist()) for i in range(500)], "point_id string, embedding array<double>")
    qs = spark.createDataFrame([(i, q[i].tolist()) for i in range(300)], "query_id int, embedding array<double>")
    got = V.topk_search(pts, qs, 3, metric="dot", block_bytes=2000).collect()
    mine = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        mine.setdefault(r.query_id, []).append(int(r.point_id[1:]))
    s = q @ p.T
    assert all(mine[i] == np.argsort(-s[i], kind="stable")[:3].tolist() for i in range(300))


# --- token budget with the grapheme level -----------------------------------------

CLUSTERS = ["e\u0301", "\U0001f469\u200d\U0001f469\u200d\U0001f467", "\U0001f1eb\U0001f1f7", "\U0001f44d\U0001f3fd", "n\u0303", "a", "\r\n", "ก็", "각"]


@pytest.mark.parametrize("budget", [1, 2, 5, 30])
@pytest.mark.parametrize("name", ["bytes", "chars", "words"])
def test_no_cluster_is_cut(name, budget):
    import random

    import regex
    rng = random.Random(budget)
    count = ch.counter(name)()
    for _ in range(60):
        text = "".join(rng.choice(CLUSTERS + [" ", ". ", "\n", "word"]) for _ in range(rng.randrange(1, 60)))
        chunks = ch.pack_chunks(text, budget, count)
        assert "".join(chunks) == text and all(chunks)
        ends = {m.end() for m in regex.finditer(r"\X", text)}
        at = 0
        for c in chunks:
            at += len(c)
            assert at in ends
            # over the budget only what cannot be cut
            assert count(c) <= budget or len(regex.findall(r"\X", c)) == 1


def test_prefix_sums_equal_counting_joined():
    import random
    rng = random.Random(1)
    plain = lambda s: len(s.encode())  # noqa: E731  the same counter, asked of every joined candidate
    for _ in range(80):
        text = "".join(rng.choice(["ab", "é", ". ", " ", "\n", "x" * 20]) for _ in range(rng.randrange(1, 200)))
        budget = rng.randrange(1, 40)
        assert ch.pack_chunks(text, budget, ch.utf8_bytes) == ch.pack_chunks(text, budget, plain)


def test_additive_counter_is_asked_once_a_piece():
    asked = []

    def count(s):
        asked.append(s)
        return len(s)
    count.additive = True
    text = "w " * 5000
    assert "".join(ch.pack_chunks(text, 50, count)) == text and len(asked) < 5010


def test_counters_by_name(spark):
    import public_tokenizers as P
    with pytest.raises(ValueError, match="no token counter named"):
        ch.counter("gpt")
    count = ch.counter("tokenizer:" + P.path("byte_bpe_50k.json"))
    df = spark.createDataFrame([(1, "One sentence here. " * 20 + "e\u0301" * 30), (2, ""), (3, None)], "id int, content string")
    rows = ch.token_chunks(df, "content", ["id"], 16, count).orderBy("chunk_idx").collect()
    assert {r.id for r in rows} == {1} and "".join(r.content for r in rows) == "One sentence here. " * 20 + "e\u0301" * 30
    own = count()
    assert all(own(r.content) <= 16 for r in rows) and len(rows) < 20


# --- token states and pages ----------------------------------------------------------

def test_states_are_pooled_under_the_mask(spark):
    from corpusflow.functions.vectors import masked_mean_pool
    from corpusflow.operators import embed as EM
    texts = ["a b c", "", None, " ".join(f"w{i}" for i in range(100)), "b", "c a", "x " * 64, "x " * 65]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    for batch in (1, 3, 128):
        got = {r.i: r.pooled for r in EM.pool_states(df, "text", lambda: EM.digest_states(8, 64), model_batch=batch).collect()}
        model = EM.digest_states(8, 64)
        for i, t in enumerate(texts):
            ids = model.tokens(t or "")[:64]
            rows = [model.table[k] for k in ids]
            want = [sum(c) / len(rows) for c in zip(*rows)] if rows else [0.0] * 8
            assert np.allclose(got[i].embedding, want) and got[i].n_tokens == len(ids)
            assert got[i].truncated == (len((t or "").split()) > 64)
    # the row-wise form agrees, padding and all
    model = EM.digest_states(8, 64)
    ids = [*model.tokens("a b c"), 0, 0]
    one = spark.createDataFrame([([model.table[k].tolist() for k in ids], [1, 1, 1, 0, 0])], "s array<array<double>>, m array<int>")
    assert np.allclose(one.select(masked_mean_pool("s", "m")).first()[0], got[0].embedding)


def test_model_batches_are_of_like_length():
    from corpusflow.operators import embed as EM
    seen = []

    class Counted(EM.DigestStates):
        def states(self, ids, mask):
            seen.append((mask.shape, int(mask.sum())))
            return super().states(ids, mask)

    texts = [" ".join(["w"] * (1 + 60 * (i % 2))) for i in range(64)]
    EM.pooled(Counted(4, 512), texts, model_batch=32)
    assert sum(a * b for (a, b), _ in seen) == sum(n for _, n in seen)  # no padding at all


def test_pages_cover_their_source(spark, tmp_path):
    import random
    from corpusflow.operators import vectors as V
    rng = random.Random(2)
    ids = rng.sample(range(100_000), 1500)
    rows = [(f"id{i:06d}", "hot" if k % 3 else f"s{k % 7}", k) for k, i in enumerate(ids)] + [(None, "hot", 0)]
    spark.createDataFrame(rows, "point_id string, source string, n int").repartition(5).write.partitionBy("source").parquet(str(tmp_path / "p"))
    pts = spark.read.parquet(str(tmp_path / "p"))
    V.page_index(pts, limit=64).write.parquet(str(tmp_path / "i"))
    index = spark.read.parquet(str(tmp_path / "i"))
    for source in {r[1] for r in rows}:
        own = sorted(r[0] for r in rows if r[1] == source and r[0])
        walked = []
        for page in range(-(-len(own) // 64)):
            got = V.read_page(pts, index, source, page)
            walked.append([r.point_id for r in got.collect()])
        assert [x for p in walked for x in p] == own and all(len(p) == 64 for p in walked[:-1])
        assert V.read_page(pts, index, source, len(walked)).count() == 0
    plan = V.read_page(pts, index, "hot", 2)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(point_id" in plan and "source" in plan[plan.index("PartitionFilters"):][:80]
    assert V.page_index(pts.limit(0)).count() == 0
