"""Boundary fixtures for the stop rules (FIXTURES.md section 3), against the loop
and against hand-derived expectations."""

from corpusflow.operators import order
from loop_sim import simulate

ART = "run_id string, source string, poll_no int, pos int, publishdate string, content string"
POLL = "run_id string, source string, poll_no int, status int, total_results long"


def _run(spark, polls, r):
    arts, prow = [], []
    for p in polls:
        prow.append(("r", "s", p["poll_no"], p["status"], p.get("total_results", 1)))
        for a in p["articles"]:
            arts.append(("r", "s", p["poll_no"], a["pos"], a["publishdate"], a["content"]))
    a = spark.createDataFrame(arts, ART)
    pp = spark.createDataFrame(prow, POLL)
    got = sorted((x.poll_no, x.pos) for x in order.accept_articles(a, pp, r).collect())
    assert got == sorted(simulate(polls, r))
    return got


def _poll(n, dates, status=200, content="body"):
    return {"poll_no": n, "status": status, "total_results": len(dates),
            "articles": [{"pos": i, "publishdate": d, "content": content} for i, d in enumerate(dates)]}


def test_exactly_100_duplicates_does_not_stop_101_does(spark):
    # poll 0: 1 new + 100 repeats of it -> 100 dups (not > 100) -> poll 1 is read
    p0 = _poll(0, ["d0"] * 101)
    p1 = _poll(1, ["d1"])
    got = _run(spark, [p0, p1], order.STD)
    assert (1, 0) in got
    # one more duplicate -> 101 > 100 -> stop after poll 0
    got = _run(spark, [_poll(0, ["d0"] * 102), p1], order.STD)
    assert got == [(0, 0)]


def test_no_growth_counter_never_resets(spark):
    # polls without growth at 1, 3, 5 (3 so far, not adjacent) keep going; the 4th (7) stops
    polls = []
    for n in range(10):
        polls.append(_poll(n, [f"d{n}"] if n % 2 == 0 else ["d0"]))
    got = _run(spark, polls, order.PollRules(max_dups=1000))
    assert max(p for p, _ in got) == 6  # poll 7 is the 4th without growth; nothing new after it


def test_same_page_repeated_five_times(spark):
    page = ["a", "b", "c"]
    got = _run(spark, [_poll(n, page) for n in range(5)], order.STD)
    assert got == [(0, 0), (0, 1), (0, 2)]


def test_trailing_repeat_exactly_five(spark):
    r = order.PollRules(stop_variant="trailing_repeat", require_total_results=True)
    # 1 new then 5 repeats at the end of poll 0 -> rep == 5 -> stop
    got = _run(spark, [_poll(0, ["x"] * 6), _poll(1, ["y"])], r)
    assert got == [(0, 0)]
    # 6 repeats -> rep == 6, not 5 -> continue
    got = _run(spark, [_poll(0, ["x"] * 7), _poll(1, ["y"])], r)
    assert got == [(0, 0), (1, 0)]


def test_cap_checked_between_polls_overshoots(spark):
    r = order.PollRules(stop_variant="cap")
    p0 = _poll(0, [f"a{i}" for i in range(99)])
    p1 = _poll(1, [f"b{i}" for i in range(21)])  # 99 -> 120 within one poll
    p2 = _poll(2, ["c"])
    got = _run(spark, [p0, p1, p2], r)
    assert len(got) == 120 and all(p < 2 for p, _ in got)


def test_non200_in_the_middle_and_null_bodies(spark):
    polls = [_poll(0, ["a", "b"]), _poll(1, ["c"], status=500), _poll(2, ["d"])]
    assert _run(spark, polls, order.STD) == [(0, 0), (0, 1)]
    assert _run(spark, polls, order.PollRules(null_policy="as_dup", status_policy="skip")) == [(0, 0), (0, 1), (2, 0)]
    nulls = [{"poll_no": 0, "status": 200, "articles": [
        {"pos": 0, "publishdate": "a", "content": "x"}, {"pos": 1, "publishdate": "b", "content": None},
        {"pos": 2, "publishdate": "c", "content": "y"}]}]
    assert _run(spark, nulls, order.STD) == [(0, 0)]
    assert _run(spark, nulls, order.PollRules(null_policy="never_null")) == [(0, 0), (0, 1), (0, 2)]


def test_inpage_stop_mid_page(spark):
    r = order.PollRules(null_policy="skip_falsy", stop_variant="inpage")
    falsy = {"poll_no": 0, "status": 200, "articles": [
        {"pos": i, "publishdate": f"f{i}", "content": None} for i in range(3)]}
    p1 = {"poll_no": 1, "status": 200, "articles": [
        {"pos": 0, "publishdate": "z", "content": ""}, {"pos": 1, "publishdate": "n", "content": "new"}]}
    # 3 falsy in poll 0 + the first falsy of poll 1 reaches 4 -> the run ends before "new"
    assert _run(spark, [falsy, p1], r) == []
