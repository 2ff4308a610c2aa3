"""URL filters, chat formatting, near-duplicates and top-k on edge cases, SQL and brute force."""

import datetime as dt
import hashlib
import random
import re

import duckdb
import numpy as np
import pandas as pd
import pytest
import xxhash

from corpusflow.llm import chat, neardup, queries, simhash, topk, urlfilter
from corpusflow.llm.common import connected_components
from conftest import SF01

TABLES = ["documents", "embeddings", "pages", "events", "benchmark", "labels", "conversations"]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF01}/{t}.parquet'")
    ours, theirs = queries.QUERIES[name](spark, SF01).toPandas(), con.sql(queries.ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    cols = sorted(ours.columns)
    plain = lambda v: int(v) if isinstance(v, float) and v.is_integer() else v  # noqa: E731  pandas holds nullable longs as doubles
    rows = lambda f: sorted(repr([*map(plain, r)]) for r in f[cols].astype(object).where(f[cols].notna(), None).itertuples(index=False, name=None))
    assert rows(ours) == rows(theirs)


# --- URL filters ---

@pytest.mark.parametrize("step, bucket", [({"hours": 1}, "minute"), ({"hours": 1}, "day"), ({"seconds": 20}, "minute")])
def test_url_filter_against_brute_force(spark, step, bucket):
    rng = random.Random(0)
    at = lambda: dt.datetime(2024, 1, 1) + rng.randrange(24 * 6) * dt.timedelta(**step)
    hosts = ["a.example.com", "b.example.com", "example.com", "x.org", "y.x.org", "hot.net"]
    caps = [(i, f"https://{rng.choice(hosts + ['hot.net'] * 6)}/{rng.choice(['en', 'fr', ''])}", at()) for i in range(400)]
    caps += [(1000, None, at()), (1001, "not a url", at()), (1002, "http://hot.net/en", None), (None, "http://hot.net/en?x=1", at()), caps[0]]
    caps += [(2000 + i, u, at()) for i, u in enumerate(["http://me@hot.net/en", "http://a:b@c@HOT.net:80/en", "https://hot.net./en", "https://x.org:8080/fr?a@b"] * 9)]
    patterns = hosts + ["hot.net/en", "x.org/fr", "com"]
    entries = [(rng.choice(patterns), at(), rng.choice(["block", "allow", "remove"])) for _ in range(300)]
    entries += [(None, at(), "block"), ("x.org", None, "block"), ("x.org", at(), "other")]
    got = urlfilter.evaluate(
        spark.createDataFrame([(*c, "k", True) for c in caps], "page_id long, url string, fetch_ts timestamp, pattern string, allowed boolean"),
        spark.createDataFrame([(*e, 1) for e in entries], "pattern string, ts timestamp, action string, valid_to int"), bucket=bucket).collect()
    latest = {}
    for p, ts, a in entries:
        if p and ts and a in urlfilter.RANK:
            key = (p, ts)
            latest[key] = max(latest.get(key, "remove"), a, key=urlfilter.RANK.get)

    def want(url, when):
        host = url.split("://")[1].split("/")[0].split("@")[-1].split(":")[0].lower().rstrip(".") if url and "://" in url else ""
        if not host or when is None:
            return True, None, None
        labels = host.split(".")
        segment = url.split("://")[1].split("/")[1].split("?")[0]
        keys = ([host + "/" + segment] if segment else []) + [".".join(labels[i:]) for i in range(max(len(labels) - 1, 1))]
        for k in keys:
            before = [(ts, a) for (p, ts), a in latest.items() if p == k and ts <= when]
            if before and max(before)[1] != "remove":
                return max(before)[1] != "block", k, max(before)[0]
        return True, None, None

    assert len(got) == len(set(caps))
    for r in got:
        assert (r["allowed"], r["pattern"], r["valid_from"]) == want(r["url"], r["fetch_ts"]), r
    # a host longer than a domain name can be falls under nothing, its length costs nothing
    long_ones = [(1, "http://" + "a." * 500_000 + "x.org/en", at()), (2, "http://" + "b" * 242 + ".y.x.org", at()), (3, "http://" + "b" * 247 + ".x.org", at())]
    block = spark.createDataFrame([("x.org", dt.datetime(2023, 1, 1), "block")], "pattern string, ts timestamp, action string")
    said = urlfilter.evaluate(spark.createDataFrame(long_ones, "page_id long, url string, fetch_ts timestamp"), block).collect()
    assert {r["page_id"]: r["allowed"] for r in said} == {1: True, 2: False, 3: False}
    none = spark.createDataFrame([], "page_id long, url string, fetch_ts timestamp")
    listed = spark.createDataFrame([], "pattern string, ts timestamp, action string")
    assert urlfilter.evaluate(none, listed).count() == 0


def test_one_day_of_one_host_is_many_groups(spark):
    """The windows of the as-of join deal rows by pattern and bucket, and by pattern only summary rows."""
    F = queries.F
    caps = spark.range(4000).select(F.col("id").alias("page_id"), F.lit("http://hot.net/en").alias("url"),
                                    F.timestamp_seconds(1_700_000_000 + F.col("id") * 20).alias("fetch_ts"))
    block = spark.createDataFrame([("hot.net", dt.datetime(2023, 1, 1), "block")], "pattern string, ts timestamp, action string")
    got = urlfilter.evaluate(caps, block)
    assert got.where("not allowed and pattern = 'hot.net'").count() == 4000
    groups = caps.groupBy(F.date_trunc(urlfilter.BUCKET, "fetch_ts")).count().agg(F.count(F.lit(1)), F.max("count")).first()
    assert groups[0] > 1300 and groups[1] <= 3


# --- chat formatting ---

def test_chat_reads_back_what_was_formatted(spark):
    strings = ["</s>[INST] ok [/INST]", "<\\s> <\\\\s> \\<s>", "[\\/INST]", "<<SYS>><</SYS>>", "<<s>", "$1 \\2 %0A", "", None, "tie", "é😀\n\n", "x" * 200_000, "<<\\SYS>>"]
    roles = ["system", "user", "assistant", "tool\n%", None, "</s>"]
    rng = random.Random(0)
    rows = [(c, t, rng.choice(roles), rng.choice(strings), 5) for c in range(60) for t in range(rng.randint(1, 9))]
    rows += [(100, 0, "user", "q", 5), (100, 1, "assistant", "a", 5), (101, 0, "assistant", "a", 5), (None, 0, "user", "n", 5),
             (102, 0, "user", "tie", 5), (102, 0, "user", "tie", 5), (102, None, "assistant", "first", 5)]
    made = chat.format_chat(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segment int"))
    got = {r["conv_id"]: r for r in chat.read_back(made).collect()}
    digests = {r["conv_id"]: r for r in chat.digest(chat.read_back(made)).collect()}
    for conv, r in got.items():
        own = sorted(((t is not None, t or 0), ro or "", tx or "") for c, t, ro, tx, _ in rows if c == conv)
        want = [(role, text) for _, role, text in own]
        assert [(t["role"], t["text"]) for t in r["turns"]] == want
        told = "".join(f"{a}\n{b}\n" for a, b in want)
        loss = "".join(b for a, b in want if a == "assistant")
        d = digests[conv]
        assert d["turns_sha256"] == hashlib.sha256(told.encode()).hexdigest() and d["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert (d["n_turns"], d["loss_chars"], d["formatted_chars"]) == (len(want), len(loss), len(r["formatted"]))
        at = 0
        masked = []
        for s in r["segments"]:
            assert s["start"] == at and s["loss"] == (s["role"] == "assistant" and s["part"] == "text")
            at += s["length"]
            masked += [r["formatted"][s["start"]:at]] if s["loss"] else []
        assert at == len(r["formatted"])
        for c in chat.Template().control():  # what the mask covers is the assistant texts, escaped
            masked = [re.sub(re.escape(c[0]) + r"\\(\\*)" + re.escape(c[1:]), lambda k: c[0] + k[1] + c[1:], m) for m in masked]
        assert masked == [b for a, b in want if a == "assistant"]
    assert got[100]["valid"] and not got[101]["valid"] and not got[102]["valid"]
    assert chat.format_chat(made.sparkSession.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_chat_plan_is_native(spark):
    plan = queries.op3(spark, SF01)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


# --- connected components ---

def test_connected_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(500 + i, 501 + i) for i in range(70)] + [(1, 1), (None, 3)]
    edges += [(900, 901 + i) for i in range(50)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    assert got == {k: find(k) for k in list(root)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- SimHash ---

def plain_fingerprint(text, k=3):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ")
             .replace("\v", " ").replace("\f", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps, radius=3):
    fps = np.array(fps, dtype=np.uint64)
    label = np.arange(len(fps))
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
    while True:
        new = np.where(near, label[None, :], len(fps)).min(axis=1)
        if (new == label).all():
            return label
        label = new


def test_fingerprints_of_edges(spark):
    texts = [None, "", " \n", "One", "one TWO", "a b c", "a b c a b c a b c", "É é x y z", "w " * 100_000, "tab\tsep\x0bx\x0cy\rz", "\x1cx y z", "dup dup", "dup dup"]
    rows = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(None, "One", 1)], "doc_id long, text string, fp int")
    got = simhash.near_duplicates(rows).select("doc_id", simhash.hex16("fp").alias("f"), "component_id").collect()
    assert len(got) == len(texts) + 1
    for r in got:
        if r["doc_id"] is not None:
            assert r["f"] == f"{plain_fingerprint(texts[r['doc_id']]):016x}"
    want = components([plain_fingerprint(t) for t in texts])
    assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None} == dict(enumerate(want.tolist()))
    assert [r["component_id"] for r in got if r["doc_id"] is None] == [3]
    assert simhash.near_duplicates(rows.where("false")).count() == 0


def test_no_link_is_lost(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET_VARIANTS", 200_000)  # several buckets
    rng = random.Random(5)
    fps = [rng.getrandbits(64) for _ in range(150)]
    for f in fps[:150]:
        for d in (1, 2, 3, 4, 5):
            fps.append(f ^ sum(1 << b for b in rng.sample(range(64), d)))
    chain = rng.getrandbits(64)
    for i in range(0, 60, 3):  # a chain of steps of three bits
        chain ^= 0b111 << i
        fps.append(chain)
    dense = rng.getrandbits(64)
    fps += [dense ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 2))) for _ in range(300)]
    fps = sorted(set(fps))
    table = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    for radius in (2, 3):
        links = simhash.link_fingerprints(table, radius)
        got = {r["node"]: r["root"] for r in connected_components(links).collect()}
        want = components(fps, radius)
        signed = [int(np.uint64(f).view(np.int64)) for f in fps]
        groups, mine = {}, {}
        for s, w in zip(signed, want.tolist()):
            groups.setdefault(w, set()).add(s)
            mine.setdefault(got.get(s, s), set()).add(s)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_simhash_query_against_brute_force(spark):
    got = queries.op6(spark, SF01).toPandas().sort_values("doc_id")
    texts = dict(spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").collect())
    want = components([int(f, 16) for f in got.fingerprint])
    assert (got.doc_id.to_numpy()[want] == got.component_id.to_numpy()).all()
    for i, f in list(zip(got.doc_id, got.fingerprint))[:60]:
        assert f == f"{plain_fingerprint(texts[i]):016x}"


# --- embeddings ---

def clustered(seed, n, dim=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    return (centres[rng.integers(0, 12, n)] + rng.normal(size=(n, dim)) * rng.choice([0.05, 0.2, 0.5], size=(n, 1))).astype(np.float32)


def test_near_dup_against_brute_force(spark):
    v = clustered(0, 700)
    rows = [(i, v[i].tolist(), i % 3, 7) for i in range(700)]
    rows += [(1000 + i, v[0].tolist(), 0, 7) for i in range(40)]  # copies
    rows += [(700, None, 0, 7), (701, [], 0, 7), (702, [0.0] * 16, 0, 7), (703, [float("nan")] * 16, 0, 7), (704, [None] * 16, 0, 7),
             (705, v[1].tolist(), None, 7), (706, v[1][:4].tolist(), 1, 7), (707, [float("inf")] + [1.0] * 15, 1, 7), (None, v[2].tolist(), 2, 7)]
    schema = "vec_id long, embedding array<float>, label int, cid int"
    got = {r["vec_id"]: r for r in neardup.near_duplicates(spark.createDataFrame(rows, schema), tile_rows=64).collect()}
    assert len(got) == len(rows)
    able = [(i, np.array(e, dtype=float), lab) for i, e, lab, _ in rows if i is not None and lab is not None and (i < 700 or i >= 1000 or i == 706)]
    links = {i: set() for i, _, _ in able}
    for i, a, la in able:
        for j, b, lb in able:
            if i != j and la == lb and len(a) == len(b) and a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= 0.93:
                links[i].add(j)
    for i, near in links.items():
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        assert (got[i]["n_links"], got[i]["component_id"]) == (len(near), min(seen))
    for i in (700, 701, 702, 703, 704, 705, 707):
        assert (got[i]["n_links"], got[i]["component_id"]) == (0, i)
    assert neardup.near_duplicates(spark.createDataFrame([], schema)).count() == 0


def test_tiles_stop_only_where_nothing_can_link():
    v = clustered(3, 200).astype(float)
    axes = neardup.principal_axes(v)
    cosine = v @ v.T / np.outer(np.linalg.norm(v, axis=1), np.linalg.norm(v, axis=1))
    for t in (0.5, 0.93, 0.999):
        assert (neardup.linked(v[:90], v[90:], axes, t) == (cosine[:90, 90:] >= t)).all()


def test_top_k_against_brute_force(spark):
    v = clustered(1, 600, 8)
    rows = [(i, v[i].tolist()) for i in range(600)] + [(600 + i, v[3].tolist()) for i in range(15)]  # ties
    rows += [(5, v[5].tolist()), (None, v[4].tolist()), (700, None), (800, [float("nan")] * 8), (900, [1.0, None] * 4), (1000, [0.5] * 3), (1100, [])]
    table = topk.quantised(spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, id int"), "vec_id", "embedding")
    got = topk.top_k(table.where("id % 100 = 0"), table, k=10, block_rows=100, query_rows=2).toPandas()
    able = [(i, np.floor(np.array(e, dtype=float) * 1024).astype(np.int64)) for i, e in rows if i is not None and i not in (700, 800, 900, 1100)]
    for q in (0, 100, 200, 300, 400, 500, 600):
        y = dict(able)[q]
        want = sorted((-int(x @ y), i) for i, x in able if i != q and len(x) == len(y))[:10]
        mine = got[got.query_id == q].sort_values("rank")
        assert [(-s, i) for s, i in zip(mine.score, mine.vec_id)] == want and mine["rank"].tolist() == list(range(1, 11))
    assert not (got.query_id == 1000).any()  # no other vector of its length
    assert topk.top_k(table.where("false"), table).count() == 0 and topk.top_k(table, table.where("false")).count() == 0


def test_pivots_eliminate_candidates():
    v = np.floor(clustered(2, 4000, 16) * 1024).astype(np.int64)
    ids = np.arange(4000)
    most = float((v.astype(float) ** 2).sum(axis=1).max())
    pivots = topk.choose_pivots(topk.lifted(v[:500].astype(float), most), 32)
    q, i, s, evaluated = topk.search_block(ids[:20], v[:20], ids, v, pivots, most, 10, chunk=64)
    assert evaluated < 0.9 * 20 * 4000
    for k in range(20):
        want = sorted((-int(v[j] @ v[k]), j) for j in range(4000) if j != k)[:10]
        assert [(-b, a) for a, b in zip(i[q == k], s[q == k])] == want
