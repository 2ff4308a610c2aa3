"""W1-W8 driver queries over ``events`` as landed polls.

Mapping (FIXTURES.md section 4): ``event_type`` = source, a stretch of ``ts`` =
poll, ``event_id`` = arrival position, a truncated ``ts`` = publish date, a small
``value`` = failed extraction (NULL body). Each rule gets the stretch of time that
makes it decide the result: days and hours (``DAILY``), hours and quarter days
(``HOURLY``: polls without growth), three hours for both (``REPEATS``: one new article
and its repeats), days and minutes (``FRESH``: hardly a duplicate), many failures
(``FAILING``). Thresholds are the
reference's (4, 100, 5, 100).

The oracles are written row-by-row with window functions (``row_number``,
running sums over rows); the Spark side uses poll-level aggregates and joins.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import functions as F

from ..operators import order
from ..sources.tables import table
from .catalog import query

KEYS = ("source",)


@dataclass(frozen=True)
class Mapping:
    """How ``events`` becomes polls: what ``ts`` is truncated to for a poll and for
    a publish date (seconds), and below which ``value`` the body is missing."""

    poll_s: int
    date_s: int
    fails_below: float = 1.0

    def sql(self) -> str:
        return f"""a AS (
  SELECT event_type AS source, CAST(floor(epoch(ts) / {self.poll_s}) AS BIGINT) AS poll_no, event_id AS pos,
         CAST(CAST(floor(epoch(ts) / {self.date_s}) AS BIGINT) AS VARCHAR) AS publishdate,
         CASE WHEN value >= {self.fails_below} THEN props END AS content
  FROM events)"""


DAILY = Mapping(86400, 3600)
HOURLY = Mapping(3600, 6 * 3600)
REPEATS = Mapping(3 * 3600, 3 * 3600)
FRESH = Mapping(86400, 60)
FAILING = Mapping(86400, 3600, 20.0)


def events_as_polls(spark, sf, m: Mapping = DAILY):
    ev = table(spark, sf, "events").select("event_id", "ts", "event_type", "value", "props")
    seconds = F.unix_timestamp("ts")
    arts = ev.select(
        F.col("event_type").alias("source"),
        F.floor(seconds / m.poll_s).alias("poll_no"),
        F.col("event_id").alias("pos"),
        F.col("event_id").cast("string").alias("title"),
        F.floor(seconds / m.date_s).cast("string").alias("publishdate"),
        F.when(F.col("value") >= m.fails_below, F.col("props")).alias("content"),
    )
    polls = (arts.groupBy("source", "poll_no")
                 .agg(F.lit(200).alias("status"), F.count(F.lit(1)).alias("total_results")))
    return arts, polls


def _out(df):
    return df.select("source", "poll_no", F.col("pos").alias("event_id"), "publishdate")


_A = DAILY.sql()

_OUT = "SELECT source, poll_no, pos AS event_id, publishdate"

# rows kept by W1 (truncate at the first NULL body of each poll)
_T = """t AS (
  SELECT * FROM (
    SELECT *, min(CASE WHEN content IS NULL THEN pos END) OVER (PARTITION BY source, poll_no) AS ff FROM a)
  WHERE ff IS NULL OR pos < ff)"""

# W2 over the truncated rows
_N = """n AS (
  SELECT *, row_number() OVER (PARTITION BY source, publishdate ORDER BY poll_no, pos) = 1 AS is_new FROM t)"""

_ALLP = "allp AS (SELECT DISTINCT source, poll_no FROM a)"


def _std_stop_sql(extra_cte="", extra_cond="", mapping=DAILY, growth="cng >= 4 OR "):
    return f"""
WITH {mapping.sql()}, {_T}, {_N}, {_ALLP},
p AS (SELECT source, poll_no, count(*) AS n_rows,
             sum(CASE WHEN is_new THEN 1 ELSE 0 END) AS n_new,
             sum(CASE WHEN is_new THEN 0 ELSE 1 END) AS n_dup
      FROM n GROUP BY source, poll_no),
q AS (SELECT allp.source, allp.poll_no, coalesce(n_rows, 0) AS n_rows, coalesce(n_new, 0) AS n_new,
             coalesce(n_dup, 0) AS n_dup
      FROM allp LEFT JOIN p ON allp.source = p.source AND allp.poll_no = p.poll_no),
r AS (SELECT *, sum(CASE WHEN n_new = 0 THEN 1 ELSE 0 END) OVER w AS cng, sum(n_dup) OVER w AS cd
      FROM q WINDOW w AS (PARTITION BY source ORDER BY poll_no ROWS UNBOUNDED PRECEDING)){extra_cte},
s AS (SELECT source, min(CASE WHEN {growth}cd > 100{extra_cond} THEN poll_no END) AS stop FROM r GROUP BY source)
{_OUT} FROM n JOIN s USING (source) WHERE n.is_new AND (s.stop IS NULL OR n.poll_no <= s.stop)
"""


@query("first_seen", f"""
WITH {_A}
{_OUT} FROM (SELECT *, row_number() OVER (PARTITION BY source, publishdate ORDER BY poll_no, pos) AS rn FROM a)
WHERE rn = 1
""")
def first_seen(spark, sf):
    """First row per (source, publish date) in arrival order."""
    arts, _ = events_as_polls(spark, sf)
    return _out(order.first_seen(arts, order.PollRules(keys=KEYS)))


@query("truncate_on_null", f"""
WITH {_A}, {_T}
{_OUT} FROM t
""")
def truncate_on_null(spark, sf):
    """Rows at and after the first failed extraction of a poll are lost."""
    arts, _ = events_as_polls(spark, sf)
    r = order.PollRules(keys=KEYS)
    return _out(order.truncate_on_failure(arts, F.col("content").isNull(), r))


@query("poll_stop", _std_stop_sql())
def poll_stop(spark, sf):
    """W1 + W2 + W4 with the reference thresholds (4 polls, > 100 duplicates)."""
    arts, polls = events_as_polls(spark, sf)
    return _out(order.accept_articles(arts, polls, order.PollRules(keys=KEYS)))


@query("poll_stop_no_growth", _std_stop_sql(mapping=HOURLY))
def poll_stop_no_growth(spark, sf):
    """The fourth poll without a new article ends the run, long before 100 duplicates."""
    arts, polls = events_as_polls(spark, sf, HOURLY)
    return _out(order.accept_articles(arts, polls, order.PollRules(keys=KEYS)))


TRAILING = dict(mapping=REPEATS, extra_cte=""",
ix AS (SELECT source, poll_no, max(CASE WHEN is_new THEN idx END) AS mnew FROM (
         SELECT *, row_number() OVER (PARTITION BY source ORDER BY poll_no, pos) AS idx FROM n)
       GROUP BY source, poll_no),
r2 AS (SELECT r.*, sum(n_rows) OVER w2 AS srows, coalesce(max(ix.mnew) OVER w2, 0) AS lastnew
       FROM r LEFT JOIN ix ON r.source = ix.source AND r.poll_no = ix.poll_no
       WINDOW w2 AS (PARTITION BY r.source ORDER BY r.poll_no ROWS UNBOUNDED PRECEDING))""",
                extra_cond=" OR srows - lastnew = 5")


@query("trailing_repeat_stop", _std_stop_sql(**TRAILING).replace("FROM r GROUP BY source", "FROM r2 GROUP BY source"))
def trailing_repeat_stop(spark, sf):
    """Also stop when exactly 5 duplicates follow the last new article."""
    arts, polls = events_as_polls(spark, sf, REPEATS)
    r = order.PollRules(keys=KEYS, stop_variant="trailing_repeat", require_total_results=True)
    return _out(order.accept_articles(arts, polls, r))


CAP_SQL = f"""
WITH {FRESH.sql()}, {_T}, {_N}, {_ALLP},
p AS (SELECT source, poll_no, sum(CASE WHEN is_new THEN 1 ELSE 0 END) AS n_new,
             sum(CASE WHEN is_new THEN 0 ELSE 1 END) AS n_dup FROM n GROUP BY source, poll_no),
q AS (SELECT allp.source, allp.poll_no, coalesce(n_new, 0) AS n_new, coalesce(n_dup, 0) AS n_dup
      FROM allp LEFT JOIN p ON allp.source = p.source AND allp.poll_no = p.poll_no),
r AS (SELECT *, sum(CASE WHEN n_new = 0 THEN 1 ELSE 0 END) OVER w AS cng, sum(n_dup) OVER w AS cd,
             coalesce(sum(n_new) OVER (PARTITION BY source ORDER BY poll_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM q WINDOW w AS (PARTITION BY source ORDER BY poll_no ROWS UNBOUNDED PRECEDING)),
s AS (SELECT source, min(CASE WHEN cng >= 4 OR cd > 100 THEN poll_no END) AS stop,
             min(CASE WHEN before >= 100 THEN poll_no END) AS capstop FROM r GROUP BY source)
{_OUT} FROM n JOIN s USING (source)
WHERE n.is_new AND (s.capstop IS NULL OR n.poll_no < s.capstop)
  AND (s.stop IS NULL OR n.poll_no <= s.stop)
"""


@query("cap_between_polls", CAP_SQL)
def cap_between_polls(spark, sf):
    """Poll only while fewer than 100 articles were collected (may overshoot)."""
    arts, polls = events_as_polls(spark, sf, FRESH)
    r = order.PollRules(keys=KEYS, stop_variant="cap")
    return _out(order.accept_articles(arts, polls, r))


@query("null_as_dup", f"""
WITH {_A}, {_ALLP},
f AS (SELECT *, coalesce(content, '') <> '' AS elig FROM a),
n AS (SELECT *, elig AND row_number() OVER (PARTITION BY source, elig, publishdate ORDER BY poll_no, pos) = 1 AS is_new FROM f),
p AS (SELECT source, poll_no, sum(CASE WHEN is_new THEN 1 ELSE 0 END) AS n_new,
             sum(CASE WHEN is_new THEN 0 ELSE 1 END) AS n_dup FROM n GROUP BY source, poll_no),
q AS (SELECT allp.source, allp.poll_no, coalesce(n_new, 0) AS n_new, coalesce(n_dup, 0) AS n_dup
      FROM allp LEFT JOIN p ON allp.source = p.source AND allp.poll_no = p.poll_no),
r AS (SELECT *, sum(CASE WHEN n_new = 0 THEN 1 ELSE 0 END) OVER w AS cng, sum(n_dup) OVER w AS cd
      FROM q WINDOW w AS (PARTITION BY source ORDER BY poll_no ROWS UNBOUNDED PRECEDING)),
s AS (SELECT source, min(CASE WHEN cng >= 4 OR cd > 100 THEN poll_no END) AS stop FROM r GROUP BY source)
{_OUT} FROM n JOIN s USING (source) WHERE n.is_new AND (s.stop IS NULL OR n.poll_no <= s.stop)
""")
def null_as_dup(spark, sf):
    """A falsy body counts as a duplicate and the page continues."""
    arts, polls = events_as_polls(spark, sf)
    r = order.PollRules(keys=KEYS, null_policy="as_dup", status_policy="skip")
    return _out(order.accept_articles(arts, polls, r))


INPAGE_SQL = f"""
WITH {FAILING.sql()},
f AS (SELECT *, coalesce(content, '') <> '' AS elig FROM a),
n AS (SELECT *, elig AND row_number() OVER (PARTITION BY source, elig, publishdate ORDER BY poll_no, pos) = 1 AS is_new FROM f),
g AS (SELECT *, min(CASE WHEN is_new THEN pos END) OVER (PARTITION BY source, poll_no) AS fnp FROM n),
h AS (SELECT *, sum(CASE WHEN NOT elig AND (fnp IS NULL OR pos < fnp) THEN 1 ELSE 0 END)
                  OVER (PARTITION BY source ORDER BY poll_no, pos ROWS UNBOUNDED PRECEDING) AS cflag FROM g),
st AS (SELECT source, min(poll_no) AS sp FROM h WHERE cflag >= 4 GROUP BY source),
st2 AS (SELECT h.source, st.sp, min(h.pos) AS spos FROM h JOIN st ON h.source = st.source AND h.poll_no = st.sp
        WHERE h.cflag >= 4 GROUP BY h.source, st.sp),
pd AS (SELECT source, poll_no, sum(CASE WHEN elig AND NOT is_new THEN 1 ELSE 0 END) AS n_dup FROM n GROUP BY source, poll_no),
pc AS (SELECT source, poll_no, sum(n_dup) OVER (PARTITION BY source ORDER BY poll_no ROWS UNBOUNDED PRECEDING) AS cd FROM pd),
ds AS (SELECT source, min(CASE WHEN cd > 100 THEN poll_no END) AS dstop FROM pc GROUP BY source)
{_OUT} FROM n LEFT JOIN st2 USING (source) LEFT JOIN ds USING (source)
WHERE n.is_new AND (ds.dstop IS NULL OR n.poll_no <= ds.dstop)
  AND (st2.sp IS NULL OR n.poll_no < st2.sp OR (n.poll_no = st2.sp AND n.pos < st2.spos))
"""


@query("poll_stop_inpage", INPAGE_SQL)
def poll_stop_inpage(spark, sf):
    """Falsy bodies before the first new article of a poll feed a run-wide
    counter; at 4 the run ends mid-page."""
    arts, polls = events_as_polls(spark, sf, FAILING)
    r = order.PollRules(keys=KEYS, null_policy="skip_falsy", stop_variant="inpage")
    return _out(order.accept_articles(arts, polls, r))


@query("dup_counts", f"""
WITH {_A}, {_T}, {_N}, {_ALLP},
p AS (SELECT source, poll_no, count(*) AS n_rows, sum(CASE WHEN is_new THEN 1 ELSE 0 END) AS n_new,
             sum(CASE WHEN is_new THEN 0 ELSE 1 END) AS n_dup FROM n GROUP BY source, poll_no),
q AS (SELECT allp.source, allp.poll_no, coalesce(n_rows, 0) AS n_rows, coalesce(n_new, 0) AS n_new,
             coalesce(n_dup, 0) AS n_dup
      FROM allp LEFT JOIN p ON allp.source = p.source AND allp.poll_no = p.poll_no)
SELECT source, poll_no, CAST(n_new AS BIGINT) AS n_new,
       CAST(n_dup AS BIGINT) AS n_dup,
       CAST(sum(n_dup) OVER w AS BIGINT) AS cum_dups,
       CAST(sum(CASE WHEN n_new = 0 THEN 1 ELSE 0 END) OVER w AS BIGINT) AS cum_no_growth,
       (sum(CASE WHEN n_new = 0 THEN 1 ELSE 0 END) OVER w >= 4 OR sum(n_dup) OVER w > 100) AS stop
FROM q WINDOW w AS (PARTITION BY source ORDER BY poll_no ROWS UNBOUNDED PRECEDING)
""")
def dup_counts(spark, sf):
    """Per-poll new/duplicate counts and the running counters of W4."""
    arts, polls = events_as_polls(spark, sf)
    rep = order.poll_report(arts, polls, order.PollRules(keys=KEYS))
    return rep.select("source", "poll_no",
                      F.col("n_new").cast("bigint").alias("n_new"), F.col("n_dup").cast("bigint").alias("n_dup"),
                      F.col("cum_dups").cast("bigint").alias("cum_dups"),
                      F.col("cum_no_growth").cast("bigint").alias("cum_no_growth"), "stop")


WEEKLY = Mapping(7 * 86400, 3600)
PAGE_SIZES = {"view": 200}  # a source's page size; 100 for the others
PAGE_SIZE = 100


@query("page_limit", f"""
WITH {WEEKLY.sql()}
{_OUT} FROM (SELECT *, row_number() OVER (PARTITION BY source, poll_no ORDER BY pos) AS rn FROM a)
WHERE rn <= CASE source WHEN 'view' THEN {PAGE_SIZES['view']} ELSE {PAGE_SIZE} END
""")
def page_limit(spark, sf):
    """SP7 / L2: a poll answer holds at most its source's page size of articles."""
    from ..operators import ingest as J
    arts, _ = events_as_polls(spark, sf, WEEKLY)
    size = F.when(F.col("source") == "view", PAGE_SIZES["view"]).otherwise(PAGE_SIZE)
    return _out(J.first_n_per_poll(arts, ["source", "poll_no"], "pos", size, max(PAGE_SIZES.values())))


def _run_chunk_counts_sql():
    from .catalog import sql_word_tokens
    base = _std_stop_sql().strip()
    sel = base[base.rindex(_OUT):]
    ctes = base[:base.rindex(_OUT)]
    acc_body = sel.replace(f"{_OUT} FROM n JOIN s USING (source)",
                           "SELECT n.source, n.poll_no, n.content FROM n JOIN s USING (source)")
    return f"""{ctes.rstrip()},
acc AS ({acc_body.strip()})
SELECT source, poll_no,
       CAST(sum(CAST(ceil(len({sql_word_tokens('content')}) / 512.0) AS BIGINT)) AS BIGINT) AS n_chunks,
       CAST(count(*) AS BIGINT) AS n_articles
FROM acc GROUP BY source, poll_no
"""


@query("run_chunk_counts", _run_chunk_counts_sql())
def run_chunk_counts(spark, sf):
    """A1 on a run: the articles a run accepts (W1+W2+W4) cut into word
    chunks (C1) and counted per source and poll day -- what K5 stores."""
    from ..operators import chunk as ch
    arts, polls = events_as_polls(spark, sf)
    acc = order.accept_articles(arts, polls, order.PollRules(keys=KEYS))
    per = acc.select("source", "poll_no",
                     ch.word_chunk_count("content").alias("n"))
    return per.groupBy("source", "poll_no").agg(F.sum("n").cast("bigint").alias("n_chunks"),
                                                  F.count(F.lit(1)).alias("n_articles"))
