"""What a Python worker holds of a batch: Python objects of a slice, one tree, one run a row."""

import gc
import sys

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusflow.functions import batches as B
from corpusflow.operators import chunk as ch
from corpusflow.operators import extract as X
from corpusflow.sources import registry

RULES = {"all": {**registry._DEFAULTS, "container": {"tag": "body"}, "text_mode": "all", "status_policy": "none"},
         "p": {**registry._DEFAULTS, "container": {"tag": "body"}, "joiner": "|", "status_policy": "none"}}


@pytest.mark.parametrize("rows,size", [(1, 1 << 20), (3, 1 << 20), (256, 5), (4, 7), (1000, 1 << 20)])
def test_slices_cover_a_batch_in_order(rows, size):
    texts = ["abc", None, "", "ééé", "x" * 20, "", None, "ab", "a"] * 3
    got = list(B.slices([pa.array(texts), pa.array([["r"]] * len(texts))], rows, size))
    assert [i for at, n in got for i in range(at, at + n)] == list(range(len(texts)))
    of = [len((t or "").encode()) for t in texts]
    assert all(n <= rows and (n == 1 or sum(of[at:at + n]) <= size) for at, n in got)
    assert list(B.slices([pa.array([], pa.string())])) == [] and list(B.slices([pa.array([1, 2, None])])) == [(0, 3)]


def test_sliced_udf_keeps_rows(spark):
    """More rows than a slice and a batch, nulls, and a text over a slice's bytes; every row meets its own result."""
    @F.pandas_udf("array<string>")
    def seen(a: pd.Series, b: pd.Series) -> pd.Series:
        assert len(a) <= B.SLICE_ROWS
        return pd.Series([None if x is None else [x[:9], str(y), str(len(x))] for x, y in zip(a, b)], dtype=object)

    n = 25_000
    text = F.when(F.col("id") % 10 == 0, None).when(F.col("id") == 777, F.repeat(F.lit("y"), 3 << 20)).otherwise(F.concat(F.lit("t"), "id"))
    df = spark.range(n).repartition(2).select("id", text.alias("a"), (F.col("id") * 2).alias("b"))
    got = {r.id: r.s for r in df.select("id", B.sliced(seen, pa.list_(pa.string()))("a", "b").alias("s")).collect()}
    want = {i: None if i % 10 == 0 else ["yyyyyyyyy", "1554", str(3 << 20)] if i == 777 else [f"t{i}", str(2 * i), str(1 + len(str(i)))] for i in range(n)}
    assert got == want


def test_token_chunks_hold_a_slice(spark):
    """10,000 texts of 50 chunks each in one batch: the worker never holds half a million chunks."""
    def watching():
        start = []

        def count(s):
            start[:] = start or [sys.getallocatedblocks()]
            assert sys.getallocatedblocks() - start[0] < 150_000, "chunks of the whole batch are held"
            return len(s.encode())
        count.additive = True
        return count

    n = 10_000
    df = spark.range(0, n, 1, 1).select("id", F.when(F.col("id") % 100 != 0, F.repeat(F.concat(F.lit("w"), "id", F.lit(" ")), 50)).alias("content"))
    out = ch.token_chunks(df, "content", ["id"], 6, watching)
    per = out.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("chunk_idx", "content"))).alias("c")).collect()
    assert len(per) == n - n // 100
    for r in per:
        assert [x.content for x in r.c] == ch.pack_chunks(f"w{r.id} " * 50, 6, ch.utf8_bytes) and [x.chunk_idx for x in r.c] == list(range(len(r.c)))


def test_python_runs_once_a_row(spark):
    texts = spark.createDataFrame([(1, "a. b"), (2, None)], "id int, content string")
    pages = spark.createDataFrame([(1, "<body><p>a</p><p>b</p></body>", ["p", "all"]), (2, None, ["p"])], "id int, html string, rules array<string>")
    for df, n in ((ch.token_chunks(texts, "content", ["id"], 3, ch.counter("bytes")), 2), (X.extract_all(pages, RULES), 3)):
        assert df.count() == n
        assert df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_trees_go_with_their_page():
    def alive():
        return sum(isinstance(o, X.Node) for o in gc.get_objects())

    pages = pd.Series(["<body><div><p>a<p>b</div><span>c" * 5, None, ""] * 20)
    gc.collect()
    gc.disable()
    try:
        before = alive()
        out = X.pieces_udf(RULES).func(pages, pd.Series([["p", "all", "p"]] * len(pages)))
        assert alive() == before
    finally:
        gc.enable()
    assert out[0] == out[3] and out[0][0] == out[0][2] and out[0][1]["pieces"] == ["abc" * 5] and out[1][0]["level"] == 0
