"""Monitoring queries: count tables (D8-D10, K3-K5), dashboard views (Q1-Q8),
Q&A figures (D11, V5, M1, M2, CA1, CA2, A6-A10, Q9, Q10) and the K1 sink rule.

Count tables come from ``events`` as landed points: one event = one point
stored on ``date(ts)`` for source ``event_type``. "Today" is the latest
landing day, never the wall clock; it is read first, as the run date of a daily
job is given, so that ranges of it are literals that reach the scan.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.vectors import softmax_at
from ..operators import chunk as ch
from ..operators import metrics as M
from ..operators import qa as QA
from ..sources import sinks
from ..session import cut_lineage
from ..sources.tables import table
from .catalog import query, sql_remove_tags, sql_word_tokens

_D = """d AS (SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS date, event_type AS source, count(*) AS count
      FROM events GROUP BY ALL)"""
_TOT = """tot AS (SELECT date, source,
        CAST(sum(count) OVER (PARTITION BY source ORDER BY date ROWS UNBOUNDED PRECEDING) AS BIGINT) AS nb_article
      FROM d)"""
_VEC = """vec AS (SELECT date, CAST(sum(n) OVER (ORDER BY date ROWS UNBOUNDED PRECEDING) AS BIGINT) AS vector_count
      FROM (SELECT date, sum(count) AS n FROM d GROUP BY date))"""
_TODAY = "(SELECT max(date) FROM d)"


def _daily(spark, sf):
    ev = table(spark, sf, "events").select("ts", F.col("event_type").alias("source"))
    return M.daily_counts(ev, F.col("ts"))


def _points(spark, sf):
    """Landed points and the day of the latest one, as a literal."""
    ev = table(spark, sf, "events").select("ts", F.col("event_type").alias("source"))
    return ev, run_day(ev)


def run_day(events):
    """Day of the latest event: one value comes to the driver and goes back as a literal."""
    return F.lit(events.agg(F.to_date(F.max("ts"))).first()[0]).cast("date")


def _before(day, days=0):
    """Points that landed before ``day + days``: a range of literals on the raw column,
    so it reaches the scan."""
    return F.col("ts") < F.date_add(day, days).cast("timestamp")


@query("daily_counts", f"WITH {_D} SELECT date, source, count FROM d")
def daily_counts(spark, sf):
    """D10 / Q6 (all dates): points stored per (date, source)."""
    return _daily(spark, sf)


@query("totals_by_source", f"WITH {_D}, {_TOT} SELECT date, source, nb_article AS count FROM tot")
def totals_by_source(spark, sf):
    """Collection size per source after each day, ``nb_article`` -> ``count``."""
    return M.totals_renamed(M.article_totals(_daily(spark, sf)))


@query("totals_over_time", f"""WITH {_D}, {_VEC}
SELECT strptime(date, '%Y-%m-%d') AS date_ts, date, vector_count AS count FROM vec""")
def totals_over_time(spark, sf):
    """Whole-collection size after each day, as a time series."""
    return M.vectors_over_time(M.vector_totals(_daily(spark, sf)))


@query("total_today", f"""WITH {_D}, {_VEC}
SELECT CAST(sum(vector_count) AS BIGINT) AS total FROM vec WHERE date = {_TODAY}""")
def total_today(spark, sf):
    """Q1 (FL1 + A5): the collection's size on its latest day, one pass, no history."""
    ev, today = _points(spark, sf)
    vec = (ev.where(_before(today, 1)).agg(F.count(F.lit(1)).alias("vector_count"))
             .withColumn("date", F.date_format(today, "yyyy-MM-dd")))
    return M.total_today(vec, F.col("date"))


@query("counts_today", f"""WITH {_D}, {_TOT}
SELECT source, nb_article AS count FROM tot WHERE date = {_TODAY}""")
def counts_today(spark, sf):
    """Q2 / Q3: per-source totals of today, date dropped, renamed."""
    ev, today = _points(spark, sf)
    per = (ev.where(_before(today, 1)).groupBy("source")
             .agg(F.count(F.lit(1)).alias("nb_article"), F.count_if(~_before(today)).alias("_landed"))
             .where("_landed > 0").select(F.date_format(today, "yyyy-MM-dd").alias("date"), "source", "nb_article"))
    return M.counts_by_source_on(per, F.col("date"))


@query("daily_on_date", f"""WITH {_D}
SELECT date, source, count FROM d
WHERE CAST(date AS DATE) = CAST({_TODAY} AS DATE) - INTERVAL 1 DAY""")
def daily_on_date(spark, sf):
    """Q7 (FL2 + DT4): daily counts on a chosen date (the day before today)."""
    ev, today = _points(spark, sf)
    day = ev.where(_before(today) & ~_before(today, -1))
    return M.daily_on(M.daily_counts(day, F.col("ts")), F.date_sub(today, 1))


@query("source_over_time", f"""WITH {_D}, {_TOT}
SELECT date, nb_article FROM tot WHERE source = (SELECT min(source) FROM d)""")
def source_over_time(spark, sf):
    """Q8 (A11 + FL3 + P6): totals of the first listed source over time."""
    d = _daily(spark, sf)
    return M.source_over_time(M.article_totals(d), d.select(F.min("source")).scalar())


@query("upsert_counts", f"""
WITH b1 AS (SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS date, event_type AS source, count(*) AS count
            FROM events
            WHERE ts < CAST((SELECT max(CAST(ts AS DATE)) FROM events) - INTERVAL 1 DAY AS TIMESTAMP) + INTERVAL 12 HOUR
            GROUP BY ALL),
b2 AS (SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS date, event_type AS source, count(*) AS count
       FROM events
       WHERE CAST(ts AS DATE) >= (SELECT max(CAST(ts AS DATE)) FROM events) - INTERVAL 1 DAY
       GROUP BY ALL),
u AS (SELECT date, source, count, row_number() OVER (PARTITION BY date, source ORDER BY batch DESC) AS rn
      FROM (SELECT *, 1 AS batch FROM b1 UNION ALL SELECT *, 2 AS batch FROM b2))
SELECT date, source, count FROM u WHERE rn = 1
""")
def upsert_counts(spark, sf):
    """K3-K5: a re-run with a one-day overlap replaces the keys it touches.

    Batch 1 ran at noon of yesterday (yesterday partly landed); batch 2
    recounts [today - 1, today]. The upsert keeps batch 1 rows whose key
    batch 2 does not carry, plus all of batch 2.
    """
    ev = table(spark, sf, "events").select("ts", F.col("event_type").alias("source"))
    today = run_day(ev)
    cut = F.to_timestamp(F.date_sub(today, 1)) + F.expr("INTERVAL 12 HOURS")
    # both batches from one pre-aggregation per (date, source): the rows are
    # read once; the upsert itself runs on per-day rows only
    per_day = (ev.groupBy(F.to_date("ts").alias("d"), "source")
                 .agg(F.count(F.lit(1)).alias("full"), F.count_if(F.col("ts") < cut).alias("early")))
    day = F.date_format("d", "yyyy-MM-dd").alias("date")
    b1 = per_day.where(F.col("early") > 0).select(day, "source", F.col("early").alias("count"))
    b2 = per_day.where(F.col("d") >= F.date_sub(today, 1)).select(day, "source", F.col("full").alias("count"))
    return sinks.upsert_frame(b1, b2, ["date", "source"])


# --- Q&A -----------------------------------------------------------------

_PAIRS = """pairs AS (
  SELECT u.conv_id, u.turn, u.text AS question, a.text AS answer
  FROM (SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text FROM conversations
        WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) u
  JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND u.next_role = 'assistant')"""
_QA = """qa AS (
  SELECT p.conv_id, p.turn, p.question, p.answer,
         CAST(coalesce(CASE WHEN l.quality = 1 THEN 1 ELSE 0 END, 0) AS INTEGER) AS upvote,
         CAST(coalesce(CASE WHEN l.quality = 0 THEN 1 ELSE 0 END, 0) AS INTEGER) AS downvote,
         CAST(coalesce(l.toxic, 0) AS INTEGER) AS flag,
         length(p.answer) / 100.0 AS l0, length(p.question) / 100.0 AS l1, 1.0 AS l2
  FROM pairs p LEFT JOIN labels l ON l.doc_id = p.conv_id),
sc AS (SELECT *, exp(l0 - greatest(l0, l1, l2)) / (exp(l0 - greatest(l0, l1, l2)) + exp(l1 - greatest(l0, l1, l2))
                 + exp(l2 - greatest(l0, l1, l2))) AS entailment FROM qa)"""


def qa_pairs_df(spark, sf):
    """D11 from ``conversations``: a user turn and the assistant turn right after it.

    Expressed as an equi-join on ``(conv_id, turn + 1)``: unique keys, so no
    conversation (however long) lands in one task, unlike ``lead`` over a
    window partitioned by conversation.
    """
    c = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    u = c.where(F.col("role") == "user").select("conv_id", (F.col("turn") + 1).alias("next_turn"),
                                               "turn", F.col("text").alias("question"))
    a = c.where(F.col("role") == "assistant").select("conv_id", F.col("turn").alias("next_turn"),
                                                    F.col("text").alias("answer"))
    return u.join(a, ["conv_id", "next_turn"], "inner").select("conv_id", "turn", "question", "answer")


def qa_log(spark, sf):
    """D11 with votes and flags: ``labels`` keyed by conversation id
    (quality 1 = upvote, 0 = downvote, toxic = flag; no label = no vote)."""
    lab = table(spark, sf, "labels").select(F.col("doc_id").alias("conv_id"), "quality", "toxic")
    q = qa_pairs_df(spark, sf).join(lab, "conv_id", "left")
    return q.select("conv_id", "turn", "question", "answer",
                    F.coalesce((F.col("quality") == 1).cast("int"), F.lit(0)).alias("upvote"),
                    F.coalesce((F.col("quality") == 0).cast("int"), F.lit(0)).alias("downvote"),
                    F.coalesce(F.col("toxic"), F.lit(0)).cast("int").alias("flag"),
                    F.lit(None).cast("timestamp").alias("timestamp"))


@query("qa_pairs", f"WITH {_PAIRS} SELECT conv_id, turn, question, answer FROM pairs")
def qa_pairs(spark, sf):
    """A user turn and the assistant turn right after it (equi-join)."""
    return qa_pairs_df(spark, sf)


@query("qa_kpis", f"""WITH {_PAIRS}, {_QA},
k AS (SELECT CAST(coalesce(sum(upvote), 0) AS BIGINT) AS upvotes, CAST(coalesce(sum(downvote), 0) AS BIGINT) AS downvotes,
             avg(CASE WHEN entailment > 0.2 THEN entailment END) AS avg_entailment,
             CAST(count(*) AS BIGINT) AS n_questions, CAST(coalesce(sum(flag), 0) AS BIGINT) AS n_flags FROM sc)
SELECT upvotes, downvotes, round(avg_entailment, 6) AS avg_entailment, n_questions, n_flags,
       round(CASE WHEN upvotes + downvotes > 0 THEN upvotes / (upvotes + downvotes) * 100.0 ELSE 0.0 END, 6) AS accuracy,
       CASE WHEN (CASE WHEN upvotes + downvotes > 0 THEN upvotes / (upvotes + downvotes) * 100.0 ELSE 0.0 END) < 50
            THEN 'bad' ELSE 'good' END AS accuracy_level,
       CASE WHEN avg_entailment < 0.5 THEN 'bad' ELSE 'good' END AS entailment_level,
       CASE WHEN n_flags <> 0 THEN 'warn' ELSE 'ok' END AS flags_level
FROM k""")
def qa_kpis(spark, sf):
    """Q9: accuracy (M1), mean entailment above 0.2 (FL4), questions, flags, levels (CA2)."""
    k = QA.kpis(QA.with_entailment(qa_log(spark, sf), "lengths"))
    return k.select("upvotes", "downvotes", F.round("avg_entailment", 6).alias("avg_entailment"),
                    "n_questions", "n_flags", F.round("accuracy", 6).alias("accuracy"),
                    "accuracy_level", "entailment_level", "flags_level")


@query("qa_rows", f"""WITH {_PAIRS}, {_QA}
SELECT conv_id, turn, substring(question, 1, 50) || '...' AS preview,
       CASE WHEN upvote = 1 THEN 'up' WHEN downvote = 1 THEN 'down' WHEN flag = 1 THEN 'flag' ELSE 'none' END AS state,
       round(entailment, 6) AS entailment, upvote, downvote, flag
FROM sc""")
def qa_rows(spark, sf):
    """Q10 (V5r + CA1 + T8)."""
    t = QA.qa_table(QA.with_entailment(qa_log(spark, sf), "lengths"))
    return t.select("conv_id", "turn", "preview", "state", F.round("Entailment", 6).alias("entailment"),
                    "upvote", "downvote", "flag")


@query("softmax0", """
WITH l AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS l, generate_subscripts(embedding, 1) AS d FROM embeddings),
m AS (SELECT vec_id, max(l) AS m FROM l GROUP BY vec_id)
SELECT vec_id, round(sum(CASE WHEN d = 1 THEN exp(l - m) ELSE 0 END) / sum(exp(l - m)), 6) AS p0
FROM l JOIN m USING (vec_id) GROUP BY vec_id
""")
def softmax0(spark, sf):
    """M2: class-0 probability of all values taken as logits."""
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return e.select("vec_id", F.round(softmax_at("embedding", 0), 6).alias("p0"))


# --- K1 ------------------------------------------------------------------

@query("incremental_points", f"""
WITH t AS (SELECT doc_id, source, {sql_word_tokens(sql_remove_tags('text'))} AS toks FROM documents),
c AS (SELECT doc_id, source, toks, unnest(range(0, CAST(ceil(len(toks) / {ch.DEFAULT_BUDGET}.0) AS BIGINT))) AS i FROM t),
k AS (SELECT doc_id, source, CAST(i AS INTEGER) AS chunk_idx,
             array_to_string(list_slice(toks, i * {ch.DEFAULT_BUDGET} + 1, (i + 1) * {ch.DEFAULT_BUDGET}), '') AS content FROM c)
SELECT DISTINCT sha256(concat_ws(chr(31), source, '', CAST(doc_id AS VARCHAR), CAST(chunk_idx AS VARCHAR), content)) AS point_id,
       source, doc_id, chunk_idx
FROM k
""")
def incremental_points(spark, sf):
    """K1: the same documents ingested twice; the second run adds no point."""
    docs = table(spark, sf, "documents").select("doc_id", "source", "text").select(
        "doc_id", "source", F.col("doc_id").cast("string").alias("title"),
        F.lit("").alias("publishdate"), tx.remove_tags("text").alias("content"))
    chunks = ch.word_chunks(docs, "content", keep=["doc_id", "source", "title", "publishdate"])
    # the id batch is materialised once (reliable checkpoint in the shared
    # folder): run 1 stores it, run 2 re-ingests the same batch against it
    batch = cut_lineage(sinks.with_point_id(chunks).select("point_id", "source", "doc_id", "chunk_idx"))
    run1 = sinks.new_points(batch, None)
    run2 = sinks.new_points(batch, run1)
    return run1.unionByName(run2)
