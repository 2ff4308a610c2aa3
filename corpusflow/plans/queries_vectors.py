"""Vector queries over ``embeddings`` as the points collection (label = source)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import ann
from ..operators import chunk as ch
from ..operators import embed as EM
from ..operators import vectors as V
from ..sources.tables import table
from .catalog import WS_SQL, query, sql_remove_tags, sql_word_tokens

TOP_K = 10
SCROLL_SOURCE = 3
SCROLL_PAGE = 20  # below the smallest source, so that the page ends and an offset follows


def _points(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", "embedding", "label")


@query("points_by_source", """
SELECT label AS source, count(*) AS n_points FROM embeddings GROUP BY label
""")
def points_by_source(spark, sf):
    """A2: points per source in one pass."""
    from ..operators.metrics import points_per_source
    return points_per_source(_points(spark, sf), "label").withColumnRenamed("label", "source")


@query("points_total", f"""
WITH t AS (SELECT len({sql_word_tokens(sql_remove_tags('text'))}) AS n FROM documents),
c AS (SELECT CAST(sum(CAST(ceil(n / {ch.DEFAULT_BUDGET}.0) AS BIGINT)) AS BIGINT) AS n_run_chunks FROM t),
p AS (SELECT count(*) AS n_points FROM embeddings)
SELECT n_points, n_run_chunks, n_points + n_run_chunks AS vector_count FROM p, c
""")
def points_total(spark, sf):
    """A3 + A4: points before the run, chunks of this run (documents), and
    the vector count saved for the day."""
    before = V.count_points(_points(spark, sf))
    docs = table(spark, sf, "documents").select("text").select(tx.remove_tags("text").alias("c"))
    run = docs.select(F.sum(ch.word_chunk_count("c")).cast("bigint")).scalar()
    return before.select("n_points", run.alias("n_run_chunks"),
                         (F.col("n_points") + run).alias("vector_count"))


@query("scroll_source", f"""
WITH s AS (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS rn FROM embeddings WHERE label = {SCROLL_SOURCE})
SELECT vec_id, label, (SELECT vec_id FROM s WHERE rn = {SCROLL_PAGE + 1}) AS next_offset FROM s WHERE rn <= {SCROLL_PAGE}
""")
def scroll_source(spark, sf):
    """SC10 / L1 / FL3: first page of one source's points, next offset."""
    page = V.scroll(_points(spark, sf), "label", SCROLL_SOURCE, id_col="vec_id", limit=SCROLL_PAGE)
    return page.select("vec_id", "label", "next_offset")


@query("mean_pool", """
WITH u AS (SELECT label, CASE WHEN vec_id % 3 <> 0 THEN 1 ELSE 0 END AS m, unnest(embedding) AS v,
                  generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings)
SELECT label, CAST(dim AS INTEGER) AS dim, round(sum(CAST(v AS DOUBLE) * m) / greatest(sum(m), 1e-9), 6) AS value
FROM u GROUP BY label, dim
""")
def mean_pool(spark, sf):
    """V1 + M3: masked mean of each source's vectors (every third is padding)."""
    c = V.centroids(_points(spark, sf), "label", mask=(F.col("vec_id") % 3 != 0).cast("int"))
    return c.select("label", "dim", F.round("value", 6).alias("value"))


_TOPK_SQL = f"""
WITH pts AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS v,
                    generate_subscripts(embedding, 1) AS d FROM embeddings),
cen AS (SELECT label AS q, d, sum(v) / count(*) AS c FROM pts GROUP BY label, d),
qn AS (SELECT q, sqrt(sum(c * c)) AS qn FROM cen GROUP BY q),
pn AS (SELECT vec_id, sqrt(sum(v * v)) AS pn FROM pts GROUP BY vec_id),
dots AS (SELECT cen.q, pts.vec_id, pts.label, sum(cen.c * pts.v) AS dot
         FROM cen JOIN pts ON cen.d = pts.d GROUP BY cen.q, pts.vec_id, pts.label),
sc AS (SELECT q, vec_id, label, dot / (qn.qn * pn.pn) AS score FROM dots JOIN qn USING (q) JOIN pn USING (vec_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id) AS rank FROM sc)
SELECT q AS query_label, CAST(rank AS INTEGER) AS rank, vec_id, label, round(score, 6) AS score
FROM r WHERE rank <= {TOP_K}
"""


@query("vector_topk", _TOPK_SQL)
def vector_topk(spark, sf):
    """V3 / V4 / K0: for each source centroid (V1), the 10 nearest points by
    cosine, best first, ties by id. Queries = one centroid per source."""
    pts = _points(spark, sf)
    q = V.centroid_vectors(V.centroids(pts, "label"), "label")
    res = V.topk_search(pts, q, TOP_K, id_col="vec_id", qid_col="label", payload=["label"])
    return res.select(F.col("query_id").alias("query_label"), "rank", "vec_id", "label",
                      F.round("score", 6).alias("score"))


def _semantic_sql():
    from .catalog import WS_SQL
    hexd = "'0123456789abcdef'"
    b = (f"((strpos({hexd}, substr(h, 1, 1)) - 1) * 16 + (strpos({hexd}, substr(h, 2, 1)) - 1)) % 64")
    sg = f"CASE WHEN (strpos({hexd}, substr(h, 3, 1)) - 1) % 2 = 0 THEN 1.0 ELSE -1.0 END"
    return f"""
WITH w AS (SELECT item_id, unnest(regexp_split_to_array(lower(text), '{WS_SQL}+')) AS w FROM benchmark),
hw AS (SELECT item_id, md5(w) AS h FROM w WHERE length(w) > 0),
q AS (SELECT item_id, {b} AS d, sum({sg}) AS v FROM hw GROUP BY ALL),
qn AS (SELECT item_id, sqrt(sum(v * v)) AS qn FROM q GROUP BY item_id HAVING sqrt(sum(v * v)) > 0),
pts AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x,
               generate_subscripts(embedding, 1) - 1 AS d FROM embeddings),
pn AS (SELECT vec_id, sqrt(sum(x * x)) AS pn FROM pts GROUP BY vec_id),
dots AS (SELECT q.item_id, pts.vec_id, pts.label, sum(q.v * pts.x) AS dot
         FROM q JOIN pts ON q.d = pts.d GROUP BY q.item_id, pts.vec_id, pts.label),
sc AS (SELECT item_id, vec_id, label, dot / (qn.qn * pn.pn) AS score FROM dots JOIN qn USING (item_id) JOIN pn USING (vec_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, vec_id) AS rank FROM sc)
SELECT item_id, CAST(rank AS INTEGER) AS rank, vec_id, label, round(score, 6) AS score FROM r WHERE rank <= 5
"""


@query("semantic_search", _semantic_sql())
def semantic_search(spark, sf):
    """V2q + V3: every ``benchmark`` text embedded (stand-in md5 feature
    hashing, 64 wide like the points, native so SQL can reproduce it) and
    searched top-5 by cosine over the points."""
    bench = table(spark, sf, "benchmark").select("item_id", "text")
    qv = EM.md5_hashing_vectors(bench, "item_id", "text", 64)
    res = V.topk_search(_points(spark, sf), qv, 5, id_col="vec_id", qid_col="item_id", payload=["label"])
    return res.select(F.col("query_id").alias("item_id"), "rank", "vec_id", "label", F.round("score", 6).alias("score"))


_PLANE = ("list_transform(range(64), lambda d: CASE WHEN strpos('02468ace', substr(md5(t || '-' || p || '-' || d), 1, 1)) > 0 THEN 1.0 ELSE -1.0 END)")

_APPROX_SQL = f"""
WITH planes AS (SELECT t, p, {_PLANE} AS plane FROM range({ann.TABLES}) a(t), range({ann.PLANES}) b(p)),
pts AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
dims AS (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM pts),
means AS (SELECT label, d, sum(x) / count(*) AS c FROM dims GROUP BY ALL),
cen AS (SELECT label AS q, list(c ORDER BY d) AS c FROM means GROUP BY label),
held AS (SELECT vec_id, t, sum(CASE WHEN list_dot_product(v, plane) >= 0 THEN 1 << p ELSE 0 END) AS bucket FROM pts, planes GROUP BY ALL),
sides AS (SELECT q, t, p, list_dot_product(c, plane) AS side FROM cen, planes),
own AS (SELECT q, t, sum(CASE WHEN side >= 0 THEN 1 << p ELSE 0 END) AS bucket FROM sides GROUP BY ALL),
near AS (SELECT q, t, p FROM sides QUALIFY row_number() OVER (PARTITION BY q, t ORDER BY abs(side)) <= {ann.PROBES}),
probes AS (SELECT q, t, CAST(bucket AS BIGINT) AS bucket FROM own
           UNION ALL SELECT q, t, xor(CAST(bucket AS BIGINT), CAST(1 << p AS BIGINT)) FROM own JOIN near USING (q, t)),
met AS (SELECT DISTINCT probes.q, vec_id FROM probes JOIN held ON probes.t = held.t AND probes.bucket = held.bucket),
sc AS (SELECT q, vec_id, label, list_dot_product(c, v) / (sqrt(list_dot_product(c, c)) * sqrt(list_dot_product(v, v))) AS score
       FROM met JOIN cen USING (q) JOIN pts USING (vec_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id) AS rank FROM sc)
SELECT q AS query_label, CAST(rank AS INTEGER) AS rank, vec_id, round(score, 6) AS score FROM r WHERE rank <= {TOP_K}
"""


@query("vector_topk_approx", _APPROX_SQL)
def vector_topk_approx(spark, sf):
    """V3, approximate mode: the queries of ``vector_topk`` through the hash index, found points scored exactly."""
    pts = _points(spark, sf)
    q = V.centroid_vectors(V.centroids(pts, "label"), "label")
    res = ann.approx_topk(pts, q, TOP_K, id_col="vec_id", qid_col="label")
    return res.select(F.col("query_id").alias("query_label"), "rank", "vec_id", F.round("score", 6).alias("score"))


STATE_WIDTH, STATE_LIMIT = 16, 64

_STATES_SQL = f"""
WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(CASE WHEN doc_id % 10 = 3 THEN '' ELSE text END, '{WS_SQL}+'), lambda w: w <> '') AS words FROM documents),
cut AS (SELECT doc_id, words[1:{STATE_LIMIT}] AS words, len(words) > {STATE_LIMIT} AS truncated FROM t),
d AS (SELECT unnest(range({STATE_WIDTH})) AS dim),
hashed AS (SELECT doc_id, unnest(list_transform(words, lambda w: md5(w))) AS h FROM cut),
means AS (SELECT doc_id, dim, sum(strpos('0123456789abcdef', substr(h, dim + 1, 1)) - 8.5) / count(*) AS value FROM hashed, d GROUP BY ALL)
SELECT cut.doc_id, CAST(d.dim AS INTEGER) AS dim, round(coalesce(value, 0), 6) AS value, CAST(len(words) AS INTEGER) AS n_tokens, truncated
FROM cut CROSS JOIN d LEFT JOIN means ON means.doc_id = cut.doc_id AND means.dim = d.dim
"""


@query("pooled_states", _STATES_SQL)
def pooled_states(spark, sf):
    """V2 + V1 + M3: token states of every document by the digest stand-in, cut at the model's limit,
    padded by length and pooled under the mask; every tenth text is emptied, its mask is all zeros."""
    docs = table(spark, sf, "documents").select("doc_id", F.when(F.col("doc_id") % 10 == 3, "").otherwise(F.col("text")).alias("text"))
    out = EM.pool_states(docs, "text", lambda: EM.digest_states(STATE_WIDTH, STATE_LIMIT))
    return (out.select("doc_id", F.posexplode("pooled.embedding").alias("dim", "value"), "pooled.n_tokens", "pooled.truncated")
            .withColumn("value", F.round("value", 6)))


PAGE_ROWS = 20

_PAGES_SQL = f"""
WITH r AS (SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS rn FROM embeddings WHERE label IS NOT NULL)
SELECT label, CAST(rn // {PAGE_ROWS} AS BIGINT) AS page, min(vec_id) AS first_id, max(vec_id) AS last_id, count(*) AS n_rows FROM r GROUP BY ALL
"""


@query("scroll_pages", _PAGES_SQL)
def scroll_pages(spark, sf):
    """SC10: the page index of every source, in one pass: where each page of 20 points begins and ends."""
    pts = _points(spark, sf).where("label is not null")
    return V.page_index(pts, "label", "vec_id", PAGE_ROWS)
