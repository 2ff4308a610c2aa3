"""Hot keys: one publish date with a third of all rows, two runs per source,
AQE skew-join splitting forced on; the result must still equal the loop."""

import random

from corpusflow.operators import order
from loop_sim import simulate

ART = "run_id string, source string, poll_no int, pos int, publishdate string, content string"
POLL = "run_id string, source string, poll_no int, status int, total_results long"

SKEW_CONF = {
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


def test_hot_publish_date_two_runs(spark):
    rnd = random.Random(21)
    arts, polls, by = [], [], {}
    for run in ("r1", "r2"):
        for s in range(4):
            src = f"s{s}"
            plist = []
            for p in range(6):
                alist = []
                for pos in range(rnd.randint(10, 60)):
                    d = "HOT" if rnd.random() < 1 / 3 else f"d{rnd.randrange(400)}"
                    c = None if rnd.random() < 0.03 else "x"
                    alist.append(dict(pos=pos, publishdate=d, content=c))
                    arts.append((run, src, p, pos, d, c))
                polls.append((run, src, p, 200, len(alist)))
                plist.append(dict(poll_no=p, status=200, total_results=len(alist), articles=alist))
            by[(run, src)] = plist
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        a = spark.createDataFrame(arts, ART).repartition(8)
        p = spark.createDataFrame(polls, POLL)
        r = order.PollRules(max_dups=60)
        got = {}
        for row in order.accept_articles(a, p, r).collect():
            got.setdefault((row.run_id, row.source), set()).add((row.poll_no, row.pos))
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    for key, plist in by.items():
        assert got.get(key, set()) == set(simulate(plist, r)), key
