"""Event-time dedup of overlapping polls: each date once, state that ends, late rows reported."""

import json
import os
import tempfile

from corpusflow.streaming import window


def _poll(no, dates, source="Guardian", status=200):
    items = [{"webPublicationDate": d, "fields": {"headline": f"h {d}", "body": f"body of {d} in poll {no}"}} for d in dates]
    return {"run_id": f"run{no}", "source": source, "poll_no": 0, "status": status, "response": {"results": items}}


def _land(folder, polls, first=0):
    os.makedirs(folder, exist_ok=True)
    for i, p in enumerate(polls, first):
        name = os.path.join(folder, f"poll-{i:03d}.json")
        with open(name, "w") as f:
            f.write(json.dumps(p) + "\n")
        os.utime(name, (1_700_000_000 + i,) * 2)


def test_overlapping_polls_state_and_late_rows(spark):
    tmp = tempfile.mkdtemp(prefix="cf-window-")
    land, pts, counts, ck = (os.path.join(tmp, x) for x in ("landing", "points", "counts", "ckpt"))
    day = lambda d: [f"2024-01-{d:02d}T{h:02d}:00:00Z" for h in (8, 16)]
    # every daily poll asks for two days, so each day comes twice; the last one brings a day long gone
    polls = [_poll(d, day(d - 1) + day(d) + (["no date"] if d == 2 else [])) for d in range(2, 12)]
    _land(land, polls + [_poll(12, day(3) + day(12)), _poll(13, day(13), status=500), _poll(14, day(12) + ["no date"], source="Other")])
    go = lambda: window.start(spark, land, pts, counts, ck, "hashing", shape="guardian", files_per_batch=1)
    q = go()
    assert q.awaitTermination(600)
    stored = spark.read.parquet(pts).collect()
    per = sorted((r.source, r.publishdate) for r in stored)
    assert len(per) == len(set(per)) == 24 + 1 + 3  # every date once, with its first body; one undated each source
    assert next(r.content for r in stored if r.publishdate == day(3)[0]) == f"body of {day(3)[0]} in poll 3"
    told = window.report(q, os.path.join(tmp, "report")).orderBy("batch").collect()
    # the two rows of the third came eight days late; repeats within the window are no late rows
    assert sum(r.late_rows for r in told) == 2
    # the state holds what a window publishes, not what the stream has seen
    assert sum(r.state_removed for r in told) >= 12 and max(r.state_rows for r in told) <= 14
    assert spark.read.parquet(os.path.join(tmp, "report")).count() == len(told)
    daily = {(str(r.date), r.source): r["count"] for r in spark.read.parquet(os.path.join(counts, "daily_counts")).collect()}
    assert daily == {(f"2024-01-{d:02d}", "Guardian"): 2 for d in range(1, 13)} | {("2024-01-12", "Other"): 2}
    # the next run goes on from the state: the same day again adds nothing, a new one does
    _land(land, [_poll(15, day(12) + day(13))], first=20)
    q = go()
    assert q.awaitTermination(300)
    assert spark.read.parquet(pts).count() == len(stored) + 2


def test_plan_has_a_state_keyed_by_source_and_date(spark):
    tmp = tempfile.mkdtemp(prefix="cf-window-")
    _land(os.path.join(tmp, "l"), [_poll(1, [])])
    from corpusflow.sources import registry
    raw = window.landing_stream(spark, os.path.join(tmp, "l"), "guardian")
    plan = window.first_within(window.stubs_stream(raw, registry.sources_df(spark), "guardian"))._jdf.queryExecution().analyzed().toString()
    assert "DeduplicateWithinWatermark" in plan and "EventTimeWatermark" in plan
