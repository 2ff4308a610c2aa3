"""Queries that make rules decide which the plain tables do not reach: extraction
rule rows (XO2-XO10, FL5), cleaning of stamped texts (T2, T5), poll envelopes built
from the given rows (SC1, SC3) and an append to a store that holds part of a batch."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import schemas
from ..functions import text as tx
from ..operators import chunk as ch
from ..operators import extract as X
from ..operators import ingest as J
from ..operators import qa as QA
from ..session import checkpoint_dir, cut_lineage
from ..sources import envelopes, registry, sinks
from ..sources.tables import table
from .catalog import WS_SQL, query, sql_remove_tags, sql_word_tokens
from .queries_order import _OUT, _std_stop_sql
from .queries_text import _extract_article_sql, _sql_unescape

# --- extraction rule rows -------------------------------------------------------

_BASE = registry._DEFAULTS
LI = {"tag": "li"}
RULES = {
    # paragraphs: last ones dropped, phrases skipped, pieces and literals deleted, pattern deleted, trimmed
    "nav": {**_BASE, "container": {"tag": "nav"}, "para": LI, "strip": True, "suffix": "\n", "drop_last": 1,
            "skip_if_contains": ["the"], "piece_deletes": ["a"], "literal_deletes": ["th"], "regex_deletes": ["o.n"],
            "trim": True, "status_policy": "none"},
    # dropped subtrees, one separator between strings, status below 400
    "rest": {**_BASE, "container": {"tag": "body"}, "drops": [{"tag": t} for t in ("nav", "article", "footer", "script")],
             "text_mode": "all", "separator": "|", "strip": True, "status_policy": "lt400"},
    # fallback container, status 200
    "ad": {**_BASE, "container": {"tag": "div", "cls": "absent"}, "fallback": {"tag": "div", "cls": "ad"},
           "text_mode": "all", "status_policy": "eq200"},
    # inner container, white space collapsed
    "foot": {**_BASE, "container": {"tag": "body"}, "inner": {"tag": "footer"}, "text_mode": "all", "separator": " \n",
             "collapse": True, "status_policy": "none"},
    # no container: empty by rule
    "none": {**_BASE, "container": {"tag": "main"}, "missing": "empty", "status_policy": "none"},
}


def _strip(e: str) -> str:
    return f"regexp_replace(regexp_replace({e}, '^{WS_SQL}+', ''), '{WS_SQL}+$', '')"


_LINKS = "regexp_extract_all(html, '<li><a[^>]*>([^<]*)</a></li>', 1)"
_FOOT = "replace(replace(regexp_extract(html, '<footer>([^<]*)</footer>', 1), '&copy;', chr(169)), '&middot;', chr(183))"
_AD = _sql_unescape("regexp_extract(html, '<div class=\"ad\">([^<]*)</div>', 1)")

RULE_ROWS_SQL = f"""
WITH p AS (SELECT page_id, html, CASE WHEN page_id % 5 = 0 THEN 404 WHEN page_id % 7 = 0 THEN 204 ELSE 200 END AS status FROM pages),
nav AS (SELECT page_id, {_LINKS} AS raw FROM p),
kept AS (SELECT page_id, list_transform(list_filter(list_transform(list_slice(raw, 1, greatest(len(raw) - 1, 0)),
            lambda x: {_strip(_sql_unescape('x'))}), lambda x: NOT contains(x, 'the')), lambda x: replace(x, 'a', '') || chr(10)) AS ps FROM nav)
SELECT page_id, 'nav' AS rule_id, {_strip("regexp_replace(replace(array_to_string(ps, ''), 'th', ''), 'o.n', '', 'g')")} AS content FROM kept
UNION ALL SELECT page_id, 'rest', CASE WHEN status < 400 THEN {_strip(_AD)} END FROM p
UNION ALL SELECT page_id, 'ad', CASE WHEN status = 200 THEN {_AD} END FROM p
UNION ALL SELECT page_id, 'foot', {_strip(f"regexp_replace({_sql_unescape(_FOOT)}, '{WS_SQL}+', ' ', 'g')")} FROM p
UNION ALL SELECT page_id, 'none', '' FROM p
"""


@query("extract_rule_rows", RULE_ROWS_SQL)
def extract_rule_rows(spark, sf):
    """XO2-XO10 / FL5: rule rows that use each sub-operator, all on one parse of every page."""
    status = F.when(F.col("page_id") % 5 == 0, 404).when(F.col("page_id") % 7 == 0, 204).otherwise(200)
    pages = table(spark, sf, "pages").select("page_id", "html", status.alias("status"), F.array(*map(F.lit, RULES)).alias("rules"))
    return X.extract_all(pages, RULES).select("page_id", "rule_id", "content")


# --- cleaning ---------------------------------------------------------------------

# Fixed value: what the cleaning rules delete, around text that stays.
STAMP = (" at 3.15pm GMT <b>or 11.05am gmt</b>\t© 2024 BBC. The BBC is not responsible for the content of external sites."
         " Read about our approach to external linking. end")
_STAMPED = "text || '" + STAMP.replace("\t", "' || chr(9) || '") + "'"


@query("clean_stamped", f"SELECT conv_id, turn, {sql_remove_tags(f'({_STAMPED})')} AS text FROM conversations")
def clean_stamped(spark, sf):
    """Every text with a clock stamp, a tag, a tab and the boilerplate put behind it."""
    c = table(spark, sf, "conversations")
    return c.select("conv_id", "turn", tx.remove_tags(F.concat("text", F.lit(STAMP))).alias("text"))


# --- envelopes --------------------------------------------------------------------

def _answers(spark, sf):
    """Poll answers as landed JSON text: one per conversation, its turns as articles;
    every tenth lacks the list, every seventh failed."""
    c = table(spark, sf, "conversations")
    stub = F.struct(F.col("role").alias("title"), F.concat(F.lit("u"), F.col("turn").cast("string")).alias("url"),
                    F.sha2("text", 256).alias("publishedAt"))
    per = c.groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("turn", stub.alias("s")))), lambda x: x["s"]).alias("a"))
    body = F.to_json(F.struct(F.lit("r").alias("run_id"), F.lit("s").alias("source"), F.col("conv_id").cast("int").alias("poll_no"),
                              F.when(F.col("conv_id") % 7 == 0, 500).otherwise(200).alias("status"),
                              F.when(F.col("conv_id") % 10 != 0, F.col("a")).alias("articles")))
    parsed = per.select(envelopes.parse_json_col(body, schemas.POLL_NEWSAPI).alias("p"))
    return parsed.select("p.*")


_TURNS = """SELECT CAST(conv_id AS INTEGER) AS poll_no, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS pos,
       role AS title, 'u' || turn AS url, sha256(text) AS publishdate,
       CASE WHEN conv_id % 7 = 0 THEN 500 ELSE 200 END AS status FROM conversations WHERE conv_id % 10 <> 0"""


@query("envelope_articles", _TURNS)
def envelope_articles(spark, sf):
    """SC1 / P1: articles of every answer in arrival order; a missing list is empty."""
    return envelopes.newsapi_articles(_answers(spark, sf)).select("poll_no", "pos", "title", "url", "publishdate", "status")


@query("envelope_set_aside", """
SELECT DISTINCT CAST(conv_id AS INTEGER) AS poll_no FROM conversations WHERE conv_id % 10 = 0 AND conv_id % 7 <> 0
""")
def envelope_set_aside(spark, sf):
    """SC3: answers of 200 without the required list."""
    return envelopes.strict_articles(_answers(spark, sf))[1].select("poll_no")


# --- K1 ----------------------------------------------------------------------------

@query("incremental_stored", f"""
WITH t AS (SELECT doc_id, source, {sql_word_tokens(sql_remove_tags('text'))} AS toks FROM documents WHERE doc_id % 3 <> 0)
SELECT doc_id, CAST(i AS INTEGER) AS chunk_idx
FROM (SELECT doc_id, unnest(range(0, CAST(ceil(len(toks) / {ch.DEFAULT_BUDGET}.0) AS BIGINT))) AS i FROM t)
""")
def incremental_stored(spark, sf):
    """K1: a batch of all documents onto a store that holds a third of them already, written and read."""
    docs = table(spark, sf, "documents").select("doc_id", "source", F.col("doc_id").cast("string").alias("title"),
                                                F.lit("").alias("publishdate"), tx.remove_tags("text").alias("content"))
    chunks = ch.word_chunks(docs, "content", keep=["doc_id", "source", "title", "publishdate"])
    batch = cut_lineage(sinks.with_point_id(chunks).select("source", "publishdate", "point_id", "doc_id", "chunk_idx"))
    store = f"{checkpoint_dir(spark)}/store-{uuid.uuid4().hex}"
    sinks.append_points(sinks.unstored(batch.where(F.col("doc_id") % 3 == 0), store), store)
    return sinks.unstored(batch, store).select("doc_id", "chunk_idx")


# --- a whole run ---------------------------------------------------------------------

class _Landed:
    """Pages as articles of three sources: thirty numbers a poll, the hour of the event
    of its number as publish date, the article's text as body."""

    @staticmethod
    def sql() -> str:
        return f"""x AS ({_extract_article_sql().strip()}),
a AS (SELECT 's' || (x.page_id % 3) AS source, CAST(floor(x.page_id / 30) AS INTEGER) AS poll_no, x.page_id AS pos, 'p' || x.page_id AS url,
             strftime(ts, '%Y-%m-%dT%H:00:00Z') AS publishdate, x.content FROM x JOIN events ON event_id = x.page_id)"""


def _run_sql() -> str:
    sql = _std_stop_sql(mapping=_Landed).replace("WITH x AS (\nWITH", "WITH x AS (WITH")
    return sql.replace(_OUT, f"SELECT source, poll_no, url, publishdate, {sql_remove_tags('content')} AS content")


@query("ingest_run", _run_sql())
def ingest_run(spark, sf):
    """Entry point A over the given pages: envelopes, settings, page lookup, extraction,
    cleaning and the arrival-order rules, by the run's own code."""
    from . import ingest
    pages = table(spark, sf, "pages").select("page_id", F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("url"),
                                             F.lit(200).alias("status"), "html")
    events = table(spark, sf, "events").select(F.col("event_id").alias("page_id"), F.date_format("ts", "yyyy-MM-dd'T'HH:00:00'Z'").alias("publishedAt"))
    stub = F.struct("page_id", F.struct(F.lit("t").alias("title"), "url", "publishedAt").alias("s"))
    polls = (pages.select("page_id", "url").join(events, "page_id")
             .groupBy(F.concat(F.lit("s"), (F.col("page_id") % 3).cast("string")).alias("source"), F.floor(F.col("page_id") / 30).cast("int").alias("poll_no"))
             .agg(F.transform(F.sort_array(F.collect_list(stub)), lambda x: x["s"]).alias("articles"))
             .select(F.lit("r").alias("run_id"), "source", "poll_no", F.lit(200).alias("status"),
                     F.size("articles").cast("long").alias("totalResults"), "articles"))
    settings = "label string, active boolean, rule_id string, null_policy string, stop_variant string, status_policy string, page_size int, window_days int, strict boolean"
    sources = spark.createDataFrame([(f"s{i}", True, "X14", "truncate", "std", "stop", 100, None, False) for i in range(3)], settings)
    run = ingest.collect_articles(spark, polls, pages.drop("page_id"), sources=sources)
    return run.select("source", "poll_no", "url", "publishdate", "content")


class _Inline:
    """Documents as articles with their body inline: forty numbers a poll, the half-hour of the event of
    its number as publish date."""

    @staticmethod
    def sql() -> str:
        return f"""a AS (SELECT 'g' || (doc_id % 3) AS source, CAST(floor(doc_id / 40) AS INTEGER) AS poll_no, doc_id AS pos, 'd' || doc_id AS url,
             strftime(ts, '%Y-%m-%dT%H:') || CASE WHEN minute(ts) < 30 THEN '00' ELSE '30' END || ':00Z' AS publishdate, text AS content
      FROM documents JOIN events ON event_id = doc_id)"""


@query("ingest_inline", _std_stop_sql(mapping=_Inline).replace(_OUT, f"SELECT source, poll_no, url AS title, publishdate, {sql_remove_tags('content')} AS content"))
def ingest_inline(spark, sf):
    """SC2 / X0 / U1: the run over answers that carry their bodies, beside a page source without any poll:
    envelopes of the other shape, no lookup, cleaning and the arrival-order rules."""
    from . import ingest
    docs = table(spark, sf, "documents").select("doc_id", "text")
    ts = F.col("ts")
    half = F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:"), F.when(F.minute(ts) < 30, "00").otherwise("30"), F.lit(":00Z"))
    events = table(spark, sf, "events").select(F.col("event_id").alias("doc_id"), half.alias("webPublicationDate"))
    item = F.struct("doc_id", F.struct("webPublicationDate", F.struct(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("headline"),
                                                                      F.col("text").alias("body")).alias("fields")).alias("s"))
    polls = (docs.join(events, "doc_id")
             .groupBy(F.concat(F.lit("g"), (F.col("doc_id") % 3).cast("string")).alias("source"), F.floor(F.col("doc_id") / 40).cast("int").alias("poll_no"))
             .agg(F.struct(F.transform(F.sort_array(F.collect_list(item)), lambda x: x["s"]).alias("results")).alias("response"))
             .select(F.lit("r").alias("run_id"), "source", "poll_no", F.lit(200).alias("status"), "response"))
    settings = "label string, active boolean, rule_id string, null_policy string, stop_variant string, status_policy string, page_size int, window_days int, strict boolean"
    sources = spark.createDataFrame([(f"g{i}", True, "X0", "truncate", "std", "stop", 100, None, False) for i in range(3)], settings)
    no_polls, no_pages = spark.createDataFrame([], schemas.POLL_NEWSAPI), spark.createDataFrame([], schemas.PAGES)
    run = ingest.collect_articles(spark, no_polls, no_pages, guardian_raw=polls, sources=sources)
    return run.select("source", "poll_no", "title", "publishdate", "content")


# --- SP6 -----------------------------------------------------------------------------

@query("poll_newest_first", """
WITH a AS (SELECT 's' || (event_id % 3) AS source, CAST(floor(event_id / 40) AS INTEGER) AS poll_no, event_id,
                  CASE WHEN event_id % 11 <> 0 THEN date_trunc('hour', ts) END AS t FROM events)
SELECT source, poll_no, 'e' || event_id AS url, CAST(row_number() OVER (PARTITION BY source, poll_no
       ORDER BY CASE WHEN source <> 's2' THEN t END DESC NULLS LAST, event_id) - 1 AS INTEGER) AS pos FROM a
""")
def poll_newest_first(spark, sf):
    """SP6 on answers: two sources ask for the newest first, one takes what landed; the hour of an event is
    its publish time, so many are equal, and every eleventh article has none."""
    from . import ingest
    time = F.when(F.col("event_id") % 11 != 0, F.date_format("ts", "yyyy-MM-dd'T'HH:00:00'Z'"))
    stub = F.struct(F.lit("t").alias("title"), F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("url"), time.alias("publishedAt"))
    polls = (table(spark, sf, "events")
             .groupBy(F.concat(F.lit("s"), (F.col("event_id") % 3).cast("string")).alias("source"), F.floor(F.col("event_id") / 40).cast("int").alias("poll_no"))
             .agg(F.transform(F.sort_array(F.collect_list(F.struct("event_id", stub.alias("s")))), lambda x: x["s"]).alias("articles"))
             .select(F.lit("r").alias("run_id"), "source", "poll_no", F.lit(200).alias("status"), F.size("articles").cast("long").alias("totalResults"), "articles"))
    return ingest.landed(polls, newest=["s0", "s1"])[0].select("source", "poll_no", "url", "pos")


@query("newest_positions", """
SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY date_trunc('day', ts) DESC NULLS LAST, event_id) - 1 AS position FROM events
""")
def newest_positions(spark, sf):
    """SP6 over a whole table: the place of every event among those of its type, newest day first; most days are equal."""
    events = table(spark, sf, "events").select("event_type", "event_id", F.date_trunc("day", "ts").alias("day"))
    return J.newest_positions(events, ["event_type"], "day", "event_id")


# --- V5 ------------------------------------------------------------------------------

def _overlap_scorer():
    """A pair scorer as it is injected: logits from the words a question and its answer share."""
    import numpy as np

    def logits(questions, answers):
        shared = [len(set(q.split(" ")) & set(a.split(" "))) for q, a in zip(questions, answers)]
        return np.array([[s, 1.0, len(a) / 200.0] for s, a in zip(shared, answers)])

    return logits


@query("qa_injected", """
WITH p AS (SELECT q.conv_id, q.turn, q.text AS question, a.text AS answer FROM conversations q
           JOIN conversations a ON a.conv_id = q.conv_id AND a.turn = q.turn + 1 WHERE q.role = 'user' AND a.role = 'assistant'),
l AS (SELECT conv_id, turn, len(list_intersect(list_distinct(string_split(question, ' ')), list_distinct(string_split(answer, ' '))))::DOUBLE AS l0,
             1.0::DOUBLE AS l1, length(answer) / 200.0::DOUBLE AS l2 FROM p)
SELECT conv_id, turn, round(exp(l0 - greatest(l0, l1, l2)) / (exp(l0 - greatest(l0, l1, l2)) + exp(l1 - greatest(l0, l1, l2))
       + exp(l2 - greatest(l0, l1, l2))), 6) AS entailment FROM l
""")
def qa_injected(spark, sf):
    """V5 / V5r: an injected pair scorer over every question and answer, its first class as probability."""
    from .queries_monitor import qa_pairs_df
    pairs = qa_pairs_df(spark, sf)
    scored = QA.with_entailment(pairs, QA.pair_logits_udf(_overlap_scorer)(F.col("question"), F.col("answer")))
    return scored.select("conv_id", "turn", F.round("Entailment", 6).alias("entailment"))
