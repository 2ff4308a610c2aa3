"""Text-side queries: cleaning (T1-T6), chunking (C1), chunk counts (A1),
scan filters (SP1, SP4), JSON envelope access (SC1, JS1), page lookup (J1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import chunk as ch
from ..sources import envelopes
from ..sources.tables import table
from .catalog import WS_SQL, query, sql_host, sql_remove_tags, sql_word_tokens

BUDGET = ch.DEFAULT_BUDGET


@query("clean_pages", f"""
SELECT page_id, {sql_remove_tags('html')} AS text FROM pages
""")
def clean_pages(spark, sf):
    """Every landed page's html through the remove-tags chain."""
    pages = table(spark, sf, "pages").select("page_id", "html")
    return pages.select("page_id", tx.remove_tags("html").alias("text"))


@query("chunks_per_source", f"""
WITH p AS (
  SELECT {sql_host('url')} AS source,
         len({sql_word_tokens(sql_remove_tags('html'))}) AS n_tok
  FROM pages)
SELECT source, CAST(sum(CAST(ceil(n_tok / {BUDGET}.0) AS BIGINT)) AS BIGINT) AS n_chunks
FROM p GROUP BY source
""")
def chunks_per_source(spark, sf):
    """Minimum slice: pages -> source = host -> T6 -> C1 (word mode) -> A1.

    Counting ``size(chunks)`` per page and summing per source is one
    partial+final hash aggregate; sources with no chunk still appear (0).
    """
    pages = table(spark, sf, "pages").select("url", "html")
    per_page = pages.select(
        tx.host_of("url").alias("source"),
        ch.word_chunk_count(tx.remove_tags("html"), BUDGET).alias("n"))
    return per_page.groupBy("source").agg(F.sum("n").cast("bigint").alias("n_chunks"))


@query("word_chunks", f"""
WITH t AS (SELECT doc_id, {sql_word_tokens(sql_remove_tags('text'))} AS toks FROM documents),
c AS (SELECT doc_id, toks, unnest(range(0, CAST(ceil(len(toks) / {BUDGET}.0) AS BIGINT))) AS i FROM t)
SELECT doc_id, CAST(i AS INTEGER) AS chunk_idx,
       array_to_string(list_slice(toks, i * {BUDGET} + 1, (i + 1) * {BUDGET}), '') AS content
FROM c
""")
def word_chunks(spark, sf):
    """C1 / AR1: every document cleaned (T6) and cut into chunks of at most
    512 words; chunk_idx dense, chunks concatenate back to the text."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    docs = docs.select("doc_id", tx.remove_tags("text").alias("content"))
    return ch.word_chunks(docs, "content", keep=["doc_id"], budget=BUDGET)


@query("lang_filter", """
SELECT doc_id, source, n_chars FROM documents WHERE lang = 'en'
""")
def lang_filter(spark, sf):
    """SP4: language equality, pushed into the parquet scan."""
    return table(spark, sf, "documents").where(F.col("lang") == "en").select("doc_id", "source", "n_chars")


@query("window_filter", """
SELECT event_id, event_type AS source, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day
FROM events
WHERE CAST(ts AS DATE) BETWEEN (SELECT max(CAST(ts AS DATE)) FROM events) - INTERVAL 1 DAY
                           AND (SELECT max(CAST(ts AS DATE)) FROM events)
""")
def window_filter(spark, sf):
    """SP1 / DT1 / DT2: keep [run_date - 1 day, run_date]; run_date = latest landing day."""
    ev = table(spark, sf, "events")
    from .queries_monitor import run_day
    run_date = run_day(ev)
    # a range of literals on the raw column, so it reaches the scan
    since, until = (F.date_add(run_date, k).cast("timestamp") for k in (-1, 1))
    return (ev.where((F.col("ts") >= since) & (F.col("ts") < until))
            .select("event_id", F.col("event_type").alias("source"),
                    F.date_format("ts", "yyyy-MM-dd").alias("day")))


@query("envelope_parse", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events
""")
def envelope_parse(spark, sf):
    """SC1 / JS1: nested key access in landed JSON text with an explicit schema."""
    ev = table(spark, sf, "events")
    return ev.select("event_id", envelopes.parse_json_col("props", "k INT").getField("k").alias("k"))


@query("sources_distinct", """
SELECT DISTINCT source FROM documents
""")
def sources_distinct(spark, sf):
    """Distinct sources (partial distinct before the shuffle)."""
    return table(spark, sf, "documents").select("source").distinct()


@query("page_lookup", """
SELECT d.doc_id, p.url, CAST(length(p.html) AS INTEGER) AS n_html, p.url IS NOT NULL AS has_page
FROM documents d LEFT JOIN (SELECT DISTINCT ON (url) page_id, url, html FROM pages ORDER BY url, page_id) p
  ON d.doc_id = p.page_id
""")
def page_lookup(spark, sf):
    """J1 / FL5: article stub -> landed page, equi left outer join.

    Stubs are ``documents`` (doc_id = page_id). Pages are deduplicated on
    url first so the join keeps the article cardinality; a missing page
    gives NULL html (handled by the null policy). Status is 200 for every
    landed stand-in page, so FL5 passes them all.
    """
    docs = table(spark, sf, "documents").select("doc_id")
    # only the length travels, not the html
    pages = (table(spark, sf, "pages").select("page_id", "url", F.length("html").alias("n_html"))
             .groupBy("url").agg(F.min("page_id").alias("page_id"), F.min_by("n_html", "page_id").alias("n_html")))
    j = docs.join(pages, docs.doc_id == pages.page_id, "left")
    return j.select("doc_id", "url", "n_html", F.col("url").isNotNull().alias("has_page"))


# named references decoded like the tree builder: with ';', or without it
# when the next character cannot continue a name (amp last: one decode only)
_ENT = [("lt", "<"), ("gt", ">"), ("quot", '"'), ("nbsp", "\xa0"), ("amp", "&")]


def _sql_unescape(expr: str) -> str:
    expr = f"replace({expr}, '&#39;', '{chr(39) * 2}')"
    for name, ch in _ENT:
        expr = f"regexp_replace({expr}, '&{name}(;|([^a-zA-Z0-9])|$)', '{ch}\\2', 'g')"
    return expr


def _extract_article_sql():
    ws = WS_SQL
    strip = lambda e: f"regexp_replace(regexp_replace({e}, '^{ws}+', ''), '{ws}+$', '')"
    return f"""
WITH a AS (SELECT page_id, regexp_extract(html, '(?s)<article>(.*)</article>', 1) AS inner_html FROM pages),
t AS (SELECT page_id, list_filter(list_transform(regexp_split_to_array(inner_html, '<[^>]*>'),
            lambda x: {strip(_sql_unescape('x'))}), lambda x: x <> '') AS parts FROM a)
SELECT page_id, {strip("array_to_string(parts, '') || chr(10) || chr(10)")} AS content FROM t
"""


@query("extract_article", _extract_article_sql())
def extract_article(spark, sf):
    """X14 / XO1 / XO5 / XO10: every ``article`` element's text (each string
    stripped, no separator), one piece per container + blank line, trimmed.
    Tree selection in an Arrow UDF over each page, the rest native."""
    from ..operators import extract as X
    from ..sources import registry
    pages = table(spark, sf, "pages").select("page_id", "html").withColumn("rule_id", F.lit("X14"))
    rules = {"X14": registry.RULES["X14"]}
    out = X.extract_bodies(pages, rules, status_col="_none")
    return out.select("page_id", "content")


# Fixed value: clusters of several code points (marks, a joined family, a flag, a syllable of letters).
CLUSTERS = "e\u0301a\u0308o\u0323\u0302" + "\U0001f469\u200d\U0001f469\u200d\U0001f467" + "\U0001f1eb\U0001f1f7" + "\U0001f44d\U0001f3fd" + "n\u0303"
TOKEN_BUDGET = 12


def _greedy_sql(pieces: str, budget: int) -> str:
    """Pieces joined from the left while the bytes fit (a fold over lists of chunks)."""
    return (f"list_reduce(list_transform({pieces}, lambda p: [p]), lambda acc, x: CASE WHEN strlen(acc[-1]) + strlen(x[1]) <= {budget} "
            "THEN list_concat(acc[:-2], [acc[-1] || x[1]]) ELSE list_concat(acc, x) END)")


def _token_chunks_sql():
    b = TOKEN_BUDGET
    return f"""
WITH t AS (SELECT conv_id, turn, {sql_remove_tags(f"text || '{CLUSTERS}' || text")} AS c FROM conversations),
s AS (SELECT conv_id, turn, c, {_greedy_sql("regexp_extract_all(c, '(?s).*?[.!?] +|.+$')", b)} AS runs FROM t WHERE c <> ''),
r AS (SELECT conv_id, turn, c, unnest(runs) AS run, generate_subscripts(runs, 1) AS i FROM s),
w AS (SELECT conv_id, turn, i, CASE WHEN strlen(run) <= {b} THEN [run] ELSE {_greedy_sql("regexp_extract_all(run, ' *[^ ]+ *| +')", b)} END AS words FROM r),
x AS (SELECT conv_id, turn, i, unnest(words) AS word, generate_subscripts(words, 1) AS j FROM w),
g AS (SELECT conv_id, turn, i, j, CASE WHEN strlen(word) <= {b} THEN [word]
        ELSE {_greedy_sql("list_transform(range(1, length_grapheme(word) + 1), lambda k: substring_grapheme(word, k, 1))", b)} END AS parts FROM x),
p AS (SELECT conv_id, turn, i, j, unnest(parts) AS content, generate_subscripts(parts, 1) AS k FROM g)
SELECT conv_id, turn, CAST(row_number() OVER (PARTITION BY conv_id, turn ORDER BY i, j, k) - 1 AS INTEGER) AS chunk_idx, content FROM p
"""


@query("token_chunks", _token_chunks_sql())
def token_chunks(spark, sf):
    """C1 under a token counter (bytes, 12 a chunk): sentences, words and grapheme clusters decide; every
    text holds clusters of several code points, none of which is cut."""
    c = table(spark, sf, "conversations").select("conv_id", "turn", tx.remove_tags(F.concat("text", F.lit(CLUSTERS), "text")).alias("content"))
    return ch.token_chunks(c, "content", ["conv_id", "turn"], TOKEN_BUDGET, ch.counter("bytes"))
