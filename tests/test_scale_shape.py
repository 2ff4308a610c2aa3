"""Scale-shape checks from the test strategy: driver collects only where
bounded, per-source filters prune partitions, order marking is narrow."""

import os
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from corpusflow.plans import search

ROOT = os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "corpusflow")
ALLOWED = {
    ("operators/vectors.py", "F.count(F.lit(1)), F.coalesce(F.max"),  # one row of two numbers
    ("operators/vectors.py", "next_offset\")).first()"),  # one scalar per page
    ("operators/vectors.py", "\"first_id\", \"last_id\").first()"),  # the bounds of one page
    ("streaming/ingest.py", "bucket_of(touched)).distinct().collect()"),  # at most as many numbers as buckets
    ("plans/queries_monitor.py", "F.to_date(F.max(\"ts\"))).first()"),  # one day
}


def test_driver_collects_are_bounded():
    found = []
    for dirpath, folders, files in os.walk(ROOT):
        folders[:] = [d for d in folders if d != "llm"]  # has its own tests
        for f in files:
            if not f.endswith(".py"):
                continue
            rel = os.path.relpath(os.path.join(dirpath, f), ROOT)
            for line in open(os.path.join(dirpath, f)):
                if re.search(r"\.collect\(\)|\.toPandas\(|\.first\(\)|\.take\(", line):
                    ok = any(rel == a and tag in line for a, tag in ALLOWED)
                    found.append((rel, line.strip(), ok))
    assert found and all(ok for _, _, ok in found), [x for x in found if not x[2]]


def test_source_filter_prunes_partitions(spark):
    d = tempfile.mkdtemp(prefix="cf-prune-")
    spark.createDataFrame([(f"id{i}", f"s{i % 4}") for i in range(40)], "point_id string, source string") \
         .write.partitionBy("source").parquet(os.path.join(d, "points"))
    pts = spark.read.parquet(os.path.join(d, "points"))
    q = search.count_by_source(pts, "s2")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*source#\d+ = s2", plan)
    assert q.first()["count"] == 10


def test_order_marking_reads_no_payload(spark):
    from corpusflow.operators import order
    arts = spark.createDataFrame([("r", "s", 0, 0, "d", "x" * 10, "big payload")],
                                 "run_id string, source string, poll_no int, pos int, publishdate string, "
                                 "content string, body string")
    polls = spark.createDataFrame([("r", "s", 0, 200, 1)], "run_id string, source string, poll_no int, status int, total_results long")
    rows = order.surviving_rows(arts, order.read_polls(arts, polls, order.STD), order.STD)
    assert set(rows.columns) == {"run_id", "source", "_turn", "pos", "publishdate", "_elig", "stop_variant"}
    out = order.accept_articles(arts, polls, order.STD)
    assert out.columns == arts.columns and out.first().body == "big payload"


@pytest.mark.parametrize("name", ["window_filter", "total_today", "counts_today", "daily_on_date"])
def test_day_ranges_reach_the_scan(spark, name):
    from corpusflow.plans.catalog import load_all
    df = load_all()[0][name](spark, SF001)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(ts," in plan and plan.split("== Initial Plan ==")[0].count("FileScan") == 1


def test_upsert_reads_the_table_once(spark):
    from corpusflow.plans.catalog import load_all
    df = load_all()[0]["upsert_counts"](spark, SF001)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[0].count("FileScan") <= 3
