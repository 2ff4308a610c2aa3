"""End-to-end ingest on a landed fixture (polls JSON + pages), re-run
idempotence, and the streaming form."""

import json
import os
import tempfile

import pytest

from corpusflow import schemas
from corpusflow.plans import ingest
from corpusflow.sources import envelopes, registry
from corpusflow.streaming import ingest as stream


def _stub(u, d):
    return {"title": f"title {u}", "url": u, "publishedAt": d}


ABC = "<div class='xvlfx ZRifP TKoO eaKKC bOdfO'><p>{}</p></div>"
CNN = "<div class='article__content-container'><p class='paragraph inline-placeholder'>{}</p></div>"

POLLS = [
    dict(run_id="r1", source="ABC", poll_no=0, status=200, totalResults=2,
         articles=[_stub("u1", "2024-01-01T10:00:00Z"), _stub("u2", "2024-01-01T11:00:00Z")]),
    dict(run_id="r1", source="ABC", poll_no=1, status=200, totalResults=2,
         articles=[_stub("u1", "2024-01-01T10:00:00Z"), _stub("u3", "2024-01-01T12:00:00Z")]),
    dict(run_id="r1", source="ABC", poll_no=2, status=500, totalResults=None, articles=None),
    dict(run_id="r1", source="ABC", poll_no=3, status=200, totalResults=1,
         articles=[_stub("u9", "2024-01-01T13:00:00Z")]),
    dict(run_id="r1", source="CNN", poll_no=0, status=200, totalResults=2,
         articles=[_stub("u4", "2024-01-01T10:00:00Z"), _stub("u5", "2024-01-01T10:30:00Z")]),
    dict(run_id="r1", source="CNN", poll_no=1, status=500, totalResults=None, articles=None),
    dict(run_id="r1", source="CNN", poll_no=2, status=200, totalResults=2,
         articles=[_stub("u6", "2024-01-01T10:00:00Z"), _stub("u7", "2024-01-01T14:00:00Z")]),
]
PAGES = [
    ("u1", 200, ABC.format("Alpha body 3.15pm GMT text")), ("u2", 200, "<div>no container</div>"),
    ("u3", 200, ABC.format("Gamma")), ("u9", 200, ABC.format("after the stop")),
    ("u4", 200, CNN.format("Delta")), ("u5", 200, "<div>none</div>"),
    ("u6", 200, CNN.format("Epsilon")), ("u7", 200, CNN.format("Zeta")),
    ("u7", 200, CNN.format("landed twice")),
]


def _write_json(d, rows):
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, "part-0.json"), "w") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")


def test_collect_and_run_ingest(spark):
    tmp = tempfile.mkdtemp(prefix="cf-ingest-")
    _write_json(os.path.join(tmp, "polls"), POLLS)
    raw = envelopes.read_polls(spark, os.path.join(tmp, "polls"))
    pages = spark.createDataFrame(PAGES, "url string, status int, html string")

    arts = ingest.collect_articles(spark, raw, pages)
    got = sorted((r.source, r.url, r.content) for r in arts.collect())
    assert got == [("ABC", "u1", "Alpha body text"), ("ABC", "u3", "Gamma"),
                   ("CNN", "u4", "Delta"), ("CNN", "u7", "Zeta")]

    pts, counts = os.path.join(tmp, "points"), os.path.join(tmp, "counts")
    with pytest.raises(ValueError, match="name an embedder"):
        ingest.run_ingest(spark, raw, pages, "2024-01-01", pts, counts)
    ingest.run_ingest(spark, raw, pages, "2024-01-01", pts, counts, "hashing")
    assert spark.read.parquet(pts).count() == 4
    daily = {(r.source, r["count"]) for r in spark.read.parquet(os.path.join(counts, "daily_counts")).collect()}
    assert ("ABC", 2) in daily and ("CNN", 2) in daily and ("BBC", 0) in daily
    vec = spark.read.parquet(os.path.join(counts, "vector_counts")).collect()
    assert [(r.date, r.vector_count) for r in vec] == [("2024-01-01", 4)]

    # re-run: content ids make the append idempotent; counts are replaced, not added
    ingest.run_ingest(spark, raw, pages, "2024-01-01", pts, counts, "hashing")
    assert spark.read.parquet(pts).count() == 4
    vec = spark.read.parquet(os.path.join(counts, "vector_counts")).collect()
    assert [(r.date, r.vector_count) for r in vec] == [("2024-01-01", 4)]
    tot = {r.source: r.nb_article for r in spark.read.parquet(os.path.join(counts, "article_counts")).collect()}
    active = {r.label for r in registry.sources_df(spark).collect()}
    assert tot == dict.fromkeys(active, 0) | {"ABC": 2, "CNN": 2}  # a source without points reports 0


def _guardian(poll_no, items):
    return {"run_id": "r1", "source": "Guardian", "poll_no": poll_no, "status": 200,
            "response": {"results": [{"webPublicationDate": d, "fields": {"headline": h, "body": b}}
                                     for d, h, b in items]}}


def _land(folder, files):
    os.makedirs(folder)
    for i, rows in enumerate(files):
        with open(os.path.join(folder, f"poll-{i:03d}.json"), "w") as f:
            for r in rows:
                f.write(json.dumps(r) + "\n")
        os.utime(f.name, (1_700_000_000 + i,) * 2)  # the stream takes files in the order of their times


def test_guardian_stream(spark):
    tmp = tempfile.mkdtemp(prefix="cf-stream-")
    land, pts, counts, ck = (os.path.join(tmp, x) for x in ("landing", "points", "counts", "ckpt"))
    _land(land, [
        [_guardian(0, [("2024-01-01T10:00:00Z", "a", "<p>one</p>"), ("2024-01-01T11:00:00Z", "b", "two")])],
        [_guardian(1, [("2024-01-01T10:00:00Z", "a", "<p>one</p>"), ("2024-01-02T09:00:00Z", "c", "three"),
                       ("not a date", "d", "four")])]])
    go = lambda: stream.start(spark, land, pts, counts, ck, "hashing", shape="guardian", run_date="2024-01-02", files_per_batch=1)
    assert go().awaitTermination(240)
    stored = spark.read.parquet(pts)
    assert sorted(r.content for r in stored.collect()) == ["four", "one", "three", "two"]
    daily = {(str(r.date), r.source, r["count"]) for r in spark.read.parquet(os.path.join(counts, "daily_counts")).collect()}
    assert daily == {("2024-01-01", "Guardian", 2), ("2024-01-02", "Guardian", 1)}
    vec = [(str(r.date), r.vector_count) for r in spark.read.parquet(os.path.join(counts, "vector_counts")).collect()]
    assert vec == [("2024-01-02", 4)]


def test_newest_first_decides_what_a_full_answer_keeps(spark):
    """An answer of more articles than its source's page, oldest first: the page cuts the last ones landed,
    or, in the order the source asks for, the oldest; the same in the stream."""
    tmp = tempfile.mkdtemp(prefix="cf-newest-")
    day = lambda i: f"2024-01-01T{i // 60:02d}:{i % 60:02d}:00Z"
    _land(os.path.join(tmp, "landing"), [[_guardian(0, [(day(i), f"h{i}", f"text {i}") for i in range(205)])]])
    g = envelopes.read_polls(spark, os.path.join(tmp, "landing"), "guardian")
    none, pages = spark.createDataFrame([], schemas.POLL_NEWSAPI), spark.createDataFrame([], schemas.PAGES)
    kept = lambda **kw: {int(r.title[1:]) for r in ingest.collect_articles(spark, none, pages, guardian_raw=g, **kw).collect()}
    assert kept() == set(range(200)) and kept(newest=registry.newest_first_labels()) == set(range(5, 205))
    q = stream.start(spark, os.path.join(tmp, "landing"), os.path.join(tmp, "points"), os.path.join(tmp, "counts"), os.path.join(tmp, "ckpt"),
                     "hashing", shape="guardian", run_date="2024-01-01", newest=registry.newest_first_labels())
    assert q.awaitTermination(240)
    assert {int(r.title[1:]) for r in spark.read.parquet(os.path.join(tmp, "points")).collect()} == set(range(5, 205))


def test_stream_equals_batch_for_page_sources(spark):
    """Polls in reverse order of landing, two a batch; the same points as the batch job."""
    tmp = tempfile.mkdtemp(prefix="cf-stream-")
    land, pts, counts, ck = (os.path.join(tmp, x) for x in ("landing", "points", "counts", "ckpt"))
    pages = spark.createDataFrame(PAGES, "url string, status int, html string")
    pages.write.parquet(os.path.join(tmp, "pages"))
    extra = dict(run_id="r1", source="Fox News", poll_no=1, status=200, totalResults=1, articles=[_stub("u3", "2024-01-01T10:00:00Z")])
    _land(land, [[p] for p in POLLS[::-1]] + [[extra]])
    q = stream.start(spark, land, pts, counts, ck, "hashing", pages_path=os.path.join(tmp, "pages"), run_date="2024-01-01", files_per_batch=2)
    assert q.awaitTermination(240)
    raw = envelopes.read_polls(spark, land)
    ingest.run_ingest(spark, raw.where("source <> 'Fox News'"), pages, "2024-01-01", os.path.join(tmp, "p2"), os.path.join(tmp, "c2"), "hashing")
    key = lambda path: sorted((r.point_id, r.content, len(r.embedding)) for r in spark.read.parquet(path).collect())
    assert key(pts) == key(os.path.join(tmp, "p2")) and len(key(pts)) == 4
    # the count tables of a source that has nothing, too: 24 sources report in both
    told = lambda root, name: sorted(tuple(r) for r in spark.read.parquet(os.path.join(root, name)).select("*").collect())
    for name in ("article_counts", "vector_counts"):
        assert told(counts, name) == told(os.path.join(tmp, "c2"), name)
    assert len(told(counts, "article_counts")) == 24
    # the run that misses its first poll waits and is reported
    gaps = [(r.source, r.missing_poll) for r in spark.read.parquet(os.path.join(ck, "run-state", "gaps")).collect()]
    assert gaps == [("Fox News", 0)]
    # streamed points can be searched
    from corpusflow.plans import search
    assert search.search_texts(spark, pts, ["Gamma"], k=1, embedder="hashing").first().content == "Gamma"


def test_stream_sets_answers_without_a_list_aside(spark):
    """The case of test_run_rules over several batches: the poll after the one set aside is kept, and
    every run that waits stays in the report until its poll lands."""
    tmp = tempfile.mkdtemp(prefix="cf-stream-")
    land, pts, counts, ck = (os.path.join(tmp, x) for x in ("landing", "points", "counts", "ckpt"))
    pages = spark.createDataFrame(PAGES, "url string, status int, html string")
    pages.write.parquet(os.path.join(tmp, "pages"))
    poll = lambda source, no, url: dict(run_id="r", source=source, poll_no=no, status=200, totalResults=1,
                                        articles=[_stub(url, f"2024-01-01T1{no}:00:00Z")] if url else None)
    aside = poll("CNN", 0, None)
    _land(land, [[poll("Fox News", 1, "u3"), poll("ABC", 1, "u1")], [poll("CNN", 1, "u4")], [aside],
                 [poll("CNN", 2, "u7"), aside, poll("ABC", 0, "u3")]])
    q = stream.start(spark, land, pts, counts, ck, "hashing", pages_path=os.path.join(tmp, "pages"), run_date="2024-01-01", files_per_batch=1)
    assert q.awaitTermination(240)
    raw = envelopes.read_polls(spark, land).where("source <> 'Fox News'").dropDuplicates(["source", "poll_no"])
    out = ingest.run_ingest(spark, raw, pages, "2024-01-01", os.path.join(tmp, "p2"), os.path.join(tmp, "c2"), "hashing")
    key = lambda path: sorted((r.point_id, r.content) for r in spark.read.parquet(path).collect())
    assert key(pts) == key(os.path.join(tmp, "p2"))
    assert sorted(c for _, c in key(pts)) == ["Alpha body text", "Delta", "Gamma", "Zeta"]
    told = lambda name: spark.read.parquet(os.path.join(ck, "run-state", name)).select("source", "poll_no").distinct().collect()
    assert told("set_aside") == out["set_aside"].select("source", "poll_no").collect() == [("CNN", 0)]
    gaps = spark.read.parquet(os.path.join(ck, "run-state", "gaps")).collect()
    assert [(r.source, r.missing_poll, r.last_landed) for r in gaps] == [("Fox News", 0, 1)]


def test_first_run_without_an_article(spark):
    """Nothing is accepted: no store, and every source reports 0, in batch and stream; the next run
    finds its articles."""
    tmp = tempfile.mkdtemp(prefix="cf-empty-")
    land, pts, counts, ck = (os.path.join(tmp, x) for x in ("landing", "points", "counts", "ckpt"))
    failed = dict(run_id="r0", source="ABC", poll_no=0, status=500, totalResults=None, articles=None)
    _land(land, [[failed]])
    raw, pages = envelopes.read_polls(spark, land), spark.createDataFrame(PAGES, "url string, status int, html string")
    ingest.run_ingest(spark, raw, pages, "2024-01-01", pts, counts, "hashing")
    assert not os.path.exists(pts)
    told = lambda root, name: sorted(tuple(r) for r in spark.read.parquet(os.path.join(root, name)).collect())
    assert {r[0] for r in told(counts, "article_counts")} == {0} and told(counts, "vector_counts")[0][0] == 0
    pages.write.parquet(os.path.join(tmp, "pages"))
    go = lambda: stream.start(spark, land, os.path.join(tmp, "p2"), os.path.join(tmp, "c2"), ck, "hashing", pages_path=os.path.join(tmp, "pages"), run_date="2024-01-01")
    assert go().awaitTermination(240)
    for name in ("article_counts", "vector_counts"):
        assert told(counts, name) == told(os.path.join(tmp, "c2"), name)
    with open(os.path.join(land, "more.json"), "w") as f:
        f.writelines(json.dumps(r) + "\n" for r in POLLS[:2])
    out = ingest.run_ingest(spark, envelopes.read_polls(spark, land), pages, "2024-01-01", pts, counts, "hashing")
    assert go().awaitTermination(240)
    assert spark.read.parquet(pts).count() == spark.read.parquet(os.path.join(tmp, "p2")).count() == 2
    for name in ("article_counts", "vector_counts"):
        assert told(counts, name) == told(os.path.join(tmp, "c2"), name)
    # u2 has no container under ABC's rule, which makes it empty, not failed
    assert out["failed"].count() == 0


def test_failed_extractions_are_reported(spark, monkeypatch):
    tmp = tempfile.mkdtemp(prefix="cf-failed-")
    land, ck = os.path.join(tmp, "landing"), os.path.join(tmp, "ckpt")
    _land(land, [POLLS[:2]])
    pages = spark.createDataFrame(PAGES, "url string, status int, html string")
    pages.write.parquet(os.path.join(tmp, "pages"))
    sources = registry.sources_df(spark, active_only=False).replace({"X1": "no such rule"}, subset=["rule_id"])
    rule = {r.label: r.rule_id for r in sources.collect()}["ABC"]
    sources = sources.replace({rule: "no such rule"}, subset=["rule_id"])
    out = ingest.run_ingest(spark, envelopes.read_polls(spark, land), pages, "2024-01-01", os.path.join(tmp, "p"), os.path.join(tmp, "c"), "hashing", sources=sources)
    want = [("ABC", u, "no such rule", "unknown rule") for u in ("u1", "u2", "u3")]
    assert sorted(tuple(r) for r in out["failed"].collect()) == want
    monkeypatch.setattr(registry, "sources_df", lambda *a, **k: sources)
    q = stream.start(spark, land, os.path.join(tmp, "p2"), os.path.join(tmp, "c2"), ck, "hashing", pages_path=os.path.join(tmp, "pages"))
    assert q.awaitTermination(240)
    told = spark.read.parquet(os.path.join(ck, "run-state", "failed")).select("source", "url", "rule_id", "extract_error")
    assert sorted(tuple(r) for r in told.collect()) == want


def test_a_batch_reads_only_its_runs_buckets(spark):
    """State reads carry partition filters on epoch and bucket, and a batch leaves no article behind
    that it judged: only those ahead of a gap wait."""
    tmp = tempfile.mkdtemp(prefix="cf-buckets-")
    land, pts, counts, ck = (os.path.join(tmp, x) for x in ("landing", "points", "counts", "ckpt"))
    poll = lambda source, no: _guardian(no, [(f"2024-01-01T{10 + no}:00:00Z", "t", f"{source} {no}")]) | {"source": source}
    _land(land, [[poll("A", 0), poll("B", 0)], [poll("A", 1), poll("B", 2)], [poll("A", 2), poll("C", 1)]])
    q = stream.start(spark, land, pts, counts, ck, "hashing", shape="guardian", files_per_batch=1)
    assert q.awaitTermination(240)
    assert sorted(r.content for r in spark.read.parquet(pts).collect()) == ["A 0", "A 1", "A 2", "B 0"]
    state = stream.State(spark, os.path.join(ck, "run-state"))
    schema = spark.createDataFrame([], stream.RUN_STATE).schema
    last = {r.source: (r.next_poll, r.last_landed, r.turns, r.epoch) for r in stream.as_of(state.get("runs", schema)).collect()}
    assert last == {"A": (3, 2, 3, 2), "B": (1, 2, 1, 1), "C": (0, 1, 0, 2)}
    waiting = spark.read.parquet(state.path("waiting_rows"))
    assert sorted((r.source, r.poll_no) for r in waiting.collect()) == [("B", 2), ("C", 1)]
    one = state.get("runs", schema, before=2, buckets=[r[0] for r in waiting.where("source = 'B'").select(stream.bucket_of(waiting)).collect()])
    assert {("B", 0), ("B", 1)} <= {(r.source, r.epoch) for r in one.collect()}
    plan = one._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):]
    assert "bucket" in filters[:300] and "epoch" in filters[:300]
    gaps = spark.read.parquet(state.path("gaps")).collect()
    assert sorted((r.source, r.missing_poll, r.last_landed) for r in gaps) == [("B", 1, 2), ("C", 0, 1)]


def test_a_retried_batch_adds_nothing(spark):
    tmp = tempfile.mkdtemp(prefix="cf-retry-")
    land, pts, counts, state = (os.path.join(tmp, x) for x in ("landing", "points", "counts", "state"))
    _land(land, [[_guardian(0, [("2024-01-01T10:00:00Z", "a", "one"), ("2024-01-01T11:00:00Z", "b", "two")])]])
    raw = envelopes.read_polls(spark, land, shape="guardian")
    sink = stream.points_sink(None, pts, counts, state, "hashing", "guardian", "2024-01-01")
    for _ in range(2):
        sink(raw, 0)
    assert spark.read.parquet(pts).count() == 2
    assert spark.read.parquet(os.path.join(counts, "vector_counts")).first().vector_count == 2


def test_search_and_dashboard_after_ingest(spark):
    from corpusflow.plans import monitor, search
    tmp = tempfile.mkdtemp(prefix="cf-views-")
    _write_json(os.path.join(tmp, "polls"), POLLS)
    raw = envelopes.read_polls(spark, os.path.join(tmp, "polls"))
    pages = spark.createDataFrame(PAGES, "url string, status int, html string")
    pts, counts = os.path.join(tmp, "points"), os.path.join(tmp, "counts")
    ingest.run_ingest(spark, raw, pages, "2024-01-01", pts, counts, "hashing")
    res = search.search_texts(spark, pts, ["Gamma", "Zeta"], k=2, embedder="hashing").collect()
    assert [r.content for r in res if r["rank"] == 1] == ["Gamma", "Zeta"]
    assert search.count_by_source(spark.read.parquet(pts), "ABC").first()["count"] == 2
    v = monitor.views(spark, counts, "2024-01-01", source="CNN")
    assert v["total_today"].first().total == 4
    assert {(r.source, r["count"]) for r in v["counts_by_source_today"].collect() if r["count"]} == {("ABC", 2), ("CNN", 2)}
    assert [r.nb_article for r in v["source_over_time"].collect()] == [2]
    empty = monitor.views(spark, os.path.join(tmp, "nothing"), "2024-01-01")
    assert empty["total_today"].first().total is None and empty["daily_today"].count() == 0


def test_ingest_with_guardian_inline_bodies(spark):
    tmp = tempfile.mkdtemp(prefix="cf-guardian-")
    _write_json(os.path.join(tmp, "polls"), POLLS[:2])
    g = [_guardian(0, [("2024-01-01T10:00:00Z", "a", "<p>one 3.15pm GMT</p>"), ("2024-01-01T10:00:00Z", "dup", "x")]),
         dict(_guardian(1, [("2024-01-01T12:00:00Z", "b", "two")]), status=503)]  # no status check
    _write_json(os.path.join(tmp, "guardian"), g)
    raw = envelopes.read_polls(spark, os.path.join(tmp, "polls"))
    graw = envelopes.read_polls(spark, os.path.join(tmp, "guardian"), shape="guardian")
    pages = spark.createDataFrame(PAGES, "url string, status int, html string")
    arts = ingest.collect_articles(spark, raw, pages, guardian_raw=graw)
    got = sorted((r.source, r.title, r.content) for r in arts.collect())
    assert got == [("ABC", "title u1", "Alpha body text"), ("ABC", "title u3", "Gamma"),
                   ("Guardian", "a", "one "), ("Guardian", "b", "two")]


def test_qa_scores_materialised_once(spark):
    from corpusflow.plans import monitor
    tmp = tempfile.mkdtemp(prefix="cf-qa-")
    qa = spark.createDataFrame([("why is the sky blue", "because of scattering", 1, 0, 0, None),
                                ("q2", "a2", 0, 1, 1, None)],
                               "question string, answer string, upvote int, downvote int, flag int, timestamp timestamp")
    out = os.path.join(tmp, "qa_scored")
    first = monitor.materialise_scores(qa, out, "lengths").count()
    again = monitor.materialise_scores(qa, out, "lengths").count()  # nothing new to score
    assert first == again == 2
    v = monitor.views(spark, os.path.join(tmp, "counts"), "2024-01-01", qa=spark.read.parquet(out))
    k = v["qa_kpis"].first()
    assert k.n_questions == 2 and k.n_flags == 1 and abs(k.accuracy - 50.0) < 1e-9


def test_cli_end_to_end(spark, capsys):
    from corpusflow import cli
    tmp = tempfile.mkdtemp(prefix="cf-cli-")
    _write_json(os.path.join(tmp, "polls"), POLLS)
    pages_path = os.path.join(tmp, "pages.parquet")
    spark.createDataFrame(PAGES, "url string, status int, html string").write.parquet(pages_path)
    pts, counts = os.path.join(tmp, "points"), os.path.join(tmp, "counts")
    cli.main(["ingest", "--polls", os.path.join(tmp, "polls"), "--pages", pages_path,
              "--run-date", "2024-01-01", "--points", pts, "--counts", counts, "--embedder", "hashing"])
    assert spark.read.parquet(pts).count() == 4
    cli.main(["ingest", "--polls", os.path.join(tmp, "polls"), "--pages", pages_path, "--run-date", "2024-01-01", "--points", pts + "2",
              "--counts", counts + "2", "--embedder", "hashing", "--budget", "5", "--counter", "chars"])
    assert max(len(r.content) for r in spark.read.parquet(pts + "2").collect()) == 5
    cli.main(["search", "--points", pts, "--k", "1", "--embedder", "hashing", "Gamma"])
    qa = os.path.join(tmp, "qa")
    spark.createDataFrame([(f"q{i}", "a", 1, 0, 0, None) for i in range(60)],
                          "question string, answer string, upvote int, downvote int, flag int, timestamp timestamp").write.parquet(qa)
    cli.main(["dashboard", "--counts", counts, "--date", "2024-01-01", "--source", "ABC", "--qa", qa, "--scorer", "lengths"])
    cli.main(["dashboard", "--counts", counts, "--date", "2024-01-01", "--out", os.path.join(tmp, "out")])
    assert spark.read.parquet(os.path.join(tmp, "out", "totals_by_source")).count() == 24
    out = capsys.readouterr().out
    assert "Gamma" in out and "== total_today" in out and "== source_over_time" in out
    assert out.count('"preview"') == 60  # every row, also beyond a screenful


def test_unregistered_source_uses_standard_rules(spark):
    tmp = tempfile.mkdtemp(prefix="cf-unreg-")
    _write_json(os.path.join(tmp, "polls"), POLLS[:1])
    g = [dict(_guardian(0, [("2024-01-01T10:00:00Z", "a", "x"), ("2024-01-01T10:00:00Z", "dup", "y")]),
              source="Some Blog")]
    _write_json(os.path.join(tmp, "g"), g)
    raw = envelopes.read_polls(spark, os.path.join(tmp, "polls"))
    graw = envelopes.read_polls(spark, os.path.join(tmp, "g"), shape="guardian")
    pages = spark.createDataFrame(PAGES, "url string, status int, html string")
    got = sorted((r.source, r.title) for r in ingest.collect_articles(spark, raw, pages, guardian_raw=graw).collect())
    assert ("Some Blog", "a") in got and ("Some Blog", "dup") not in got


def test_run_rules(spark):
    """Unlisted sources run under the plain rules, inactive ones do not run, a strict
    source's answer without its list is set aside, requests bound page and window."""
    tmp = tempfile.mkdtemp(prefix="cf-rules-")
    many = [_stub(f"m{i}", f"2024-01-01T{i // 60:02d}:{i % 60:02d}:00Z") for i in range(130)]
    polls = [
        dict(run_id="r", source="Unlisted", poll_no=0, status=200, totalResults=1, articles=[_stub("x", "2024-01-01T10:00:00Z")]),
        dict(run_id="r", source="GNews", poll_no=0, status=200, totalResults=1, articles=[_stub("x", "2024-01-01T10:00:00Z")]),
        dict(run_id="r", source="CNN", poll_no=0, status=200, totalResults=None, articles=None),
        dict(run_id="r", source="CNN", poll_no=1, status=200, totalResults=1, articles=[_stub("u4", "2024-01-01T10:00:00Z")]),
        dict(run_id="r", source="ABC", poll_no=0, status=200, totalResults=1,
             articles=[_stub("u1", "2023-12-01T10:00:00Z"), _stub("u3", "2023-12-31T10:00:00Z")]),
        dict(run_id="r", source="BBC", poll_no=0, status=200, totalResults=130, articles=many),
    ]
    _write_json(os.path.join(tmp, "polls"), polls)
    raw = envelopes.read_polls(spark, os.path.join(tmp, "polls"))
    rows = PAGES + [("x", 200, "<html><p>plain</p></html>")] + [(f"m{i}", 200, f"<p>body {i}</p>") for i in range(130)]
    pages = spark.createDataFrame(rows, "url string, status int, html string")
    counter = lambda: (lambda s: len(s.split()))
    out = ingest.run_ingest(spark, raw, pages, "2024-01-01", os.path.join(tmp, "p"), os.path.join(tmp, "c"), "hashing:16", counter=counter)
    points = spark.read.parquet(os.path.join(tmp, "p")).collect()
    by = {}
    for r in points:
        by.setdefault(r.source, []).append(r.content)
    assert by["Unlisted"] == ["plain"] and "GNews" not in by and by["CNN"] == ["Delta"] and by["ABC"] == ["Gamma"]
    assert len(by["BBC"]) == 100 and all(len(r.embedding) == 16 for r in points)
    daily = {r.source: r["count"] for r in out["daily"].collect()}
    assert daily["Unlisted"] == 1 and daily["Wired"] == 0 and "GNews" not in daily
    assert [(r.source, r.poll_no) for r in out["set_aside"].collect()] == [("CNN", 0)]


def test_append_reads_only_the_batchs_folders(spark):
    from corpusflow.sources import sinks
    path = os.path.join(tempfile.mkdtemp(prefix="cf-store-"), "points")
    sch = "source string, publishdate string, title string, chunk_idx int, content string"
    first = sinks.with_point_id(spark.createDataFrame([("s", f"2024-01-0{d}T00:00:00Z", "t", 0, f"c{d}") for d in range(1, 6)]
                                                      + [("s", None, "t", 0, "c"), ("s", "", "t", 0, "c")], sch))
    sinks.append_points(sinks.unstored(first, path), path)
    assert spark.read.parquet(path).count() == 7  # a missing date and an empty one are two contents
    again = sinks.unstored(first.where("publishdate like '2024-01-03%'").unionByName(
        sinks.with_point_id(spark.createDataFrame([("s", "2024-01-03T00:00:00Z", "t", 1, "more")], sch))), path)
    assert [r.content for r in again.collect()] == ["more"]
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "publishday" in plan
