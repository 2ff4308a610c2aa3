"""SC1-SC3 envelope scans, SC5 registry, SC6-SC9 readers, SP filters, V5 scorer."""

import json
import os
import tempfile

import numpy as np
from pyspark.sql import functions as F

from corpusflow.operators import ingest as J
from corpusflow.operators import qa as QA
from corpusflow.sources import envelopes, registry, tables


def _land(rows):
    d = tempfile.mkdtemp(prefix="cf-land-")
    with open(os.path.join(d, "p.json"), "w") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")
    return d


def test_newsapi_envelope_order_and_missing_list(spark):
    d = _land([
        {"run_id": "r", "source": "BBC", "poll_no": 0, "status": 200, "totalResults": 2,
         "articles": [{"title": "a", "url": "u1", "publishedAt": "t1"}, {"title": "b", "url": "u2", "publishedAt": "t2"}]},
        {"run_id": "r", "source": "BBC", "poll_no": 1, "status": 200},  # no articles key: empty page
        {"run_id": "r", "source": "BBC", "poll_no": 2, "status": 200, "articles": []},
    ])
    raw = envelopes.read_polls(spark, d)
    arts = envelopes.newsapi_articles(raw).collect()
    assert [(r.poll_no, r.pos, r.url) for r in sorted(arts, key=lambda r: (r.poll_no, r.pos))] == [(0, 0, "u1"), (0, 1, "u2")]
    polls = envelopes.poll_table(raw).collect()
    assert sorted(r.poll_no for r in polls) == [0, 1, 2]  # zero-article polls kept


def test_strict_envelope_quarantines(spark):
    d = _land([
        {"run_id": "r", "source": "GNews", "poll_no": 0, "status": 200, "articles": [{"title": "a", "url": "u", "publishedAt": "t"}]},
        {"run_id": "r", "source": "GNews", "poll_no": 1, "status": 200},
        {"run_id": "r", "source": "GNews", "poll_no": 2, "status": 500},
    ])
    good, bad = envelopes.strict_articles(envelopes.read_polls(spark, d))
    assert good.count() == 1 and [r.poll_no for r in bad.collect()] == [1]


def test_guardian_envelope_inline_body(spark):
    from corpusflow import schemas
    d = _land([{"run_id": "r", "source": "Guardian", "poll_no": 0, "status": 200,
                "response": {"results": [{"webPublicationDate": "2024-01-01T00:00:00Z",
                                          "fields": {"headline": "h", "body": "<p>b</p>"}}]}}])
    raw = envelopes.read_polls(spark, d, shape="guardian")
    assert [(f.name, f.dataType) for f in raw.schema] == [(f.name, f.dataType) for f in schemas.POLL_GUARDIAN]
    r = envelopes.guardian_articles(raw).first()
    assert (r.title, r.content, r.publishdate, r.url) == ("h", "<p>b</p>", "2024-01-01T00:00:00Z", None)


def test_registry_rows_and_rules():
    assert len(registry._S) == 27 and sum(1 for s in registry._S if s[-1]) == 24
    assert {s[3] for s in registry._S} - {"X0"} <= set(registry.RULES)
    assert len(registry.RULES) == 26


def test_registry_join(spark):
    arts = spark.createDataFrame([("BBC", 1), ("CNN", 2), ("nobody", 3)], "source string, pos int")
    reg = registry.sources_df(spark).select(F.col("label").alias("source"), "rule_id")
    j = J.attach_registry(arts, reg, on="source", label_col="source")
    assert sorted((r.source, r.rule_id) for r in j.collect()) == [("BBC", "X1"), ("CNN", "X5"), ("nobody", None)]


def test_request_settings(spark):
    rows = {r["label"]: r for r in registry.sources_df(spark, active_only=False).collect()}
    assert rows["Guardian"]["page_size"] == 200 and rows["BBC"]["page_size"] == 100
    assert rows["ABC AU"]["window_days"] is None and rows["BBC"]["window_days"] == 1
    assert {k for k, r in rows.items() if r["strict"]} == {"GNews", "CNN"} and rows["Fortune"]["topic"] == "business"


def test_count_table_readers(spark):
    d = tempfile.mkdtemp(prefix="cf-counts-")
    empty = tables.read_count_table(spark, os.path.join(d, "missing"), "vector")
    assert empty.count() == 0 and empty.columns == ["date", "vector_count"]
    p = os.path.join(d, "total")
    spark.createDataFrame([("x", "2024-01-01", "s", 3)], "_id string, date string, source string, nb_article long") \
         .write.parquet(p)
    t = tables.read_count_table(spark, p, "total")
    assert t.columns == ["date", "source", "nb_article"] and t.first().nb_article == 3
    qa = spark.createDataFrame([("i", "q", "a", 1, 0, 0, None, "extra")],
                               "_id string, question string, answer string, upvote int, downvote int, flag int, "
                               "timestamp timestamp, other string")
    assert tables.read_qa(qa).columns == ["question", "answer", "upvote", "downvote", "flag", "timestamp"]


def test_request_filter(spark):
    df = spark.createDataFrame([("bbc-news", "en", "General news", "x", 0), ("bbc-news", "fr", "general", "y", 1),
                                ("cnn", "en", "sport", "general z", 2), ("bbc-news", "en", "other", "w", 150)],
                               "sel string, lang string, title string, content string, pos int")
    out = J.request_filter(df, selector_col="sel", selector="bbc-news", lang_col="lang", lang="en",
                           topic="general", page_size=100)
    assert [r.pos for r in out.collect()] == [0]


def test_injected_pair_scorer(spark):
    def factory():
        def score(qs, ans):  # toy model: higher logit 0 when the answer repeats the question
            return np.array([[1.0 if q in a else -1.0, 0.0, 0.0] for q, a in zip(qs, ans)])
        return score
    df = spark.createDataFrame([("q1", "q1 yes"), ("q2", "no")], "question string, answer string")
    out = QA.with_entailment(df, QA.pair_logits_udf(factory)("question", "answer")).collect()
    e1 = np.exp(1.0) / (np.exp(1.0) + 2)
    e2 = np.exp(-1.0) / (np.exp(-1.0) + 2)
    got = {r.question: r.Entailment for r in out}
    assert abs(got["q1"] - e1) < 1e-12 and abs(got["q2"] - e2) < 1e-12


def test_strict_envelope_error_mode(spark):
    import pytest
    d = _land([{"run_id": "r", "source": "GNews", "poll_no": 1, "status": 200}])
    raw = envelopes.read_polls(spark, d)
    with pytest.raises(Exception, match="poll without articles"):
        envelopes.strict_articles(raw, on_missing="error").collect()


def test_missing_run_id_reads_as_empty(spark):
    d = _land([{"source": "BBC", "poll_no": 0, "status": 200,
                "articles": [{"title": "a", "url": "u1", "publishedAt": "t1"}]}])
    raw = envelopes.read_polls(spark, d)
    assert [r.run_id for r in envelopes.newsapi_articles(raw).collect()] == [""]


def test_lookup_pages_keeps_article_cardinality(spark):
    arts = spark.createDataFrame([(0, "u1"), (1, "u1"), (2, "missing")], "pos int, url string")
    pages = spark.createDataFrame([("u1", 200, "<p>a</p>"), ("u1", 200, "<p>b</p>"), ("u1", None, "<p>0</p>"), ("u1", 404, "")],
                                  "url string, status int, html string")
    out = sorted((r.pos, r.html) for r in J.lookup_pages(arts, pages).collect())
    assert out == [(0, "<p>a</p>"), (1, "<p>a</p>"), (2, None)]  # one page per url, one that answered 200


def test_landing_window_prunes_partitions(spark):
    root = tempfile.mkdtemp(prefix="cf-landing-")
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        d = os.path.join(root, f"landing_date={day}")
        os.makedirs(d)
        with open(os.path.join(d, "p.json"), "w") as f:
            f.write(json.dumps({"run_id": "r", "source": "BBC", "poll_no": 0, "status": 200,
                                "articles": [{"title": day, "url": day, "publishedAt": day}]}) + "\n")
    raw = envelopes.read_polls_window(spark, root, "2024-01-03", days=1)
    plan = raw._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(landing_date" in plan
    got = sorted(r.title for r in envelopes.newsapi_articles(raw).collect())
    assert got == ["2024-01-02", "2024-01-03"]


def test_each_source_reads_its_own_window(spark, tmp_path):
    """Folders outside a source's request window are pruned; ABC AU has no window and reads all days
    up to the run's; a source that is not listed has the default."""
    import json
    for day in ("2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"):
        for source in ("CNN", "ABC AU", "Some Blog"):
            d = tmp_path / f"landing_date={day}" / f"source={source}"
            d.mkdir(parents=True)
            (d / "p.json").write_text(json.dumps(dict(run_id="r", source=source, poll_no=0, status=200, totalResults=0, articles=[])) + "\n")
    windows = registry.request_windows()
    assert windows["ABC AU"] is None and windows["CNN"] == 1
    raw = envelopes.read_polls_window(spark, str(tmp_path), "2024-01-03", 0, windows=windows)
    got = sorted((r.source, r.landing_date) for r in raw.select("source", "landing_date").collect())
    assert got == [("ABC AU", "2024-01-01"), ("ABC AU", "2024-01-02"), ("ABC AU", "2024-01-03"),
                   ("CNN", "2024-01-02"), ("CNN", "2024-01-03"), ("Some Blog", "2024-01-03")]
    plan = raw._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]
    assert "landing_date" in filters and "source" in filters
    files = raw._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in files


def test_answers_newest_first(spark):
    from corpusflow.plans import ingest
    stub = lambda u, t: {"title": u, "url": u, "publishedAt": t}
    arts = [stub("old", "2024-01-01T00:00:00Z"), stub("x", None), stub("tie1", "2024-01-02T00:00:00Z"),
            stub("y", "soon"), stub("tie2", "2024-01-02T01:00:00+01:00"), stub("new", "2024-01-03T00:00:00Z")]
    poll = lambda source, n, **kw: {"run_id": "r", "source": source, "poll_no": n, "status": 200, **kw}
    raw = envelopes.read_polls(spark, _land([poll("sky sports", 0, articles=arts), poll("BBC", 0, articles=arts),
                                             poll("sky sports", 1), poll("sky sports", 2, articles=[])]))
    newest = registry.newest_first_labels()
    assert newest == ["Guardian", "sky sports"]
    stubs, polls = ingest.landed(raw, newest=newest)
    got = {}
    for r in sorted(stubs.collect(), key=lambda r: r.pos):
        got.setdefault(r.source, []).append(r.url)
    assert got == {"sky sports": ["new", "tie1", "tie2", "old", "x", "y"], "BBC": [a["url"] for a in arts]}
    assert sorted((r.source, r.poll_no, r.no_list) for r in polls.collect()) == [
        ("BBC", 0, False), ("sky sports", 0, False), ("sky sports", 1, True), ("sky sports", 2, False)]
    plan = stubs._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    items = [{"webPublicationDate": f"2024-01-0{d}T00:00:00Z", "fields": {"headline": str(d), "body": "b"}} for d in (1, 3, 2)]
    raw = envelopes.read_polls(spark, _land([poll("Guardian", 0, response={"results": items}), poll("Guardian", 1), poll("Guardian", 2, response={})]), "guardian")
    stubs, polls = ingest.landed(raw, "guardian", newest)
    assert [r.title for r in sorted(stubs.collect(), key=lambda r: r.pos)] == ["3", "2", "1"] and polls.count() == 3


def test_newest_positions_against_brute_force(spark):
    import random
    rng = random.Random(4)
    rows = [("hot" if rng.random() < 0.5 else rng.choice(["a", "b", None]), rng.choice([None, *range(5)]), i) for i in range(3000)]
    table = spark.createDataFrame(rows, "source string, t int, id long").repartition(7)
    got = {r["id"]: (r["source"], r["position"]) for r in J.newest_positions(table, ["source"], "t", "id").collect()}
    want = {}
    for key in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is None, -(r[1] or 0), r[2]))
        want |= {r[2]: (key, k) for k, r in enumerate(mine)}
    assert got == want
    assert J.newest_positions(table.limit(0), ["source"], "t", "id").count() == 0
    # a source of any size is dealt to many parts, each ranked by itself
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spread = {r["id"]: (r["source"], r["position"]) for r in J.newest_positions(table, ["source"], "t", "id").collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spread == want
