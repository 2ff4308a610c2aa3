"""Approximate search: found rows are exact, recall is measured, edges have defined results."""

import numpy as np

from corpusflow.operators import ann, vectors as V
from conftest import SF01


def _both(spark, pts, queries, k=10):
    pts = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(pts)], "id long, v array<double>")
    asked = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(queries)], "q long, v array<double>")
    args = dict(id_col="id", vec_col="v", qid_col="q", qvec_col="v")
    exact = {(r.query_id, r.id): r.score for r in V.topk_search(pts, asked, k, **args).collect()}
    near = ann.approx_topk(pts, asked, k, **args).collect()
    return exact, near


def test_recall_and_scores_on_clustered_vectors(spark):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(60, 48))
    pts = np.repeat(centres, 40, axis=0) + 0.35 * rng.normal(size=(2400, 48))
    exact, near = _both(spark, pts, centres + 0.2 * rng.normal(size=centres.shape))
    found = {(r.query_id, r.id): r.score for r in near}
    assert len(set(exact) & set(found)) >= 0.97 * len(exact)
    assert all(abs(found[k] - exact[k]) < 1e-9 for k in set(exact) & set(found))
    for q in range(60):
        own = sorted((r["rank"], r.score) for r in near if r.query_id == q)
        assert [a for a, _ in own] == list(range(1, len(own) + 1)) and [s for _, s in own] == sorted((s for _, s in own), reverse=True)


def test_recall_on_the_given_table(spark):
    pts = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    asked = pts.where("vec_id % 100 = 0").withColumnRenamed("vec_id", "q")
    args = dict(id_col="vec_id", qid_col="q")
    exact = {(r.query_id, r.vec_id) for r in V.topk_search(pts, asked, 10, **args).collect()}
    found = {(r.query_id, r.vec_id) for r in ann.approx_topk(pts, asked, 10, **args).collect()}
    assert len(exact & found) >= 0.9 * len(exact)


def test_edges_stored_index_and_plan(spark, tmp_path):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [float("nan"), 1.0]), (7, [1.0, 0.0, 0.0]), (8, [-1.0, 0.0])]
    pts = spark.createDataFrame(rows, "id long, v array<double>")
    asked = spark.createDataFrame([(1, [3.0, 0.0]), (2, None), (3, [0.0, 0.0])], "q long, v array<double>")
    ann.lsh_index(pts, "id", "v").write.parquet(str(tmp_path / "index"))
    stored = spark.read.parquet(str(tmp_path / "index"))
    args = dict(id_col="id", vec_col="v", qid_col="q", qvec_col="v")
    for index in (None, stored):
        out = ann.approx_topk(pts, asked, 2, index=index, **args)
        assert [(r.query_id, r["rank"], r.id, round(r.score, 9)) for r in out.orderBy("rank").collect()] == [(1, 1, 1, 1.0), (1, 2, 2, 1.0)]
    assert ann.approx_topk(pts.limit(0), asked, 2, **args).count() == 0
    more = spark.read.parquet(f"{SF01}/embeddings.parquet")
    plan = ann.approx_topk(more, more, 3, id_col="vec_id", qid_col="vec_id")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_planes_follow_from_their_rule():
    p = ann.planes(5, 3, 4)
    assert p.shape == (5, 12) and set(np.unique(p)) == {-1.0, 1.0}
    assert (ann.planes(7, 3, 4)[:5] == p).all()
