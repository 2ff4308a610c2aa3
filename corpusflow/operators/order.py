"""The arrival-order rules of a polling collector, as set-based Spark jobs.

A fetch run polls one source's API repeatedly. Each poll returns a page of
article stubs in arrival order; the collector keeps the first article per
publish date, counts duplicates and polls without growth, and stops on
thresholds. Here arrival order is data, ``(poll_no, pos)``, and a source's
policy is a column of its polls, so all policies run in one pass:

* polls: the status policy and W1's first failed position make one frame of
  polls that are read at all (poll-level rows only).
* rows: the narrow stubs (keys, order, flags) that survive W1, cut once; the
  payload never enters a shuffle before the last step.
* W2: the smallest arrival number per (key, publish date), one long, so a
  hash aggregate with a map-side partial: a publish date holding a third of
  all rows is collapsed before the shuffle. The minimum names the new rows,
  there is no join back to the rows.
* W3-W8: every counter of a poll (rows, eligible, new, first and last new
  position) comes from one aggregate; the stop rules are windows over the
  polls of one (run, source), never over articles.
* the accepted keys are semi-joined back to the payload, once.

A run can be taken up again (``continue_run``): what the rules need of the polls
before is one row of counters per run and the publish dates it has seen, so the
polls that came since are judged without those before.

Every rule returns whole results: no row is sampled or capped beyond the
rule itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import truthy
from ..session import cut_lineage

# An arrival number is the poll's turn in its run above the position in it.
POS_BITS = 40


@dataclass(frozen=True)
class PollRules:
    """Fetch behaviour of a source, and the names of the columns.

    null_policy:
      ``truncate``            NULL body ends the page (W1); '' is kept.
      ``truncate_skip_empty`` NULL ends the page; an empty cleaned body is
                              skipped without counting.
      ``never_null``/``keep`` no special handling.
      ``skip_falsy``          falsy bodies are skipped (with the W5 counter).
      ``as_dup``              falsy bodies count as duplicates (W8).
    stop_variant: ``std`` (W4), ``inpage`` (W5), ``trailing_repeat`` (W6),
      ``cap`` (W7).
    status_policy: ``stop`` (first non-200 poll ends the run), ``skip``
      (non-200 polls vanish), ``none`` (status not checked).
    A column of the polls named like one of these three takes precedence;
    W6 sources then need a positive total.
    """

    null_policy: str = "truncate"
    stop_variant: str = "std"
    status_policy: str = "stop"
    require_total_results: bool = False
    max_no_growth: int = 4
    max_dups: int = 100
    rep_stop: int = 5
    cap: int = 100
    keys: tuple = ("run_id", "source")
    date_keys: tuple = ("publishdate",)
    content: str = "content"
    cleaned: str | None = None


# Thresholds of the reference collector: 4 polls without growth, > 100 duplicates.
STD = PollRules()
VARIANTS = ("std", "inpage", "trailing_repeat", "cap")


def _pkeys(r: PollRules) -> list[str]:
    return list(r.keys) + ["poll_no"]


def _turns(r: PollRules) -> list[str]:
    return list(r.keys) + ["_turn"]


# ---------------------------------------------------------------------------
# the rules one by one

def truncate_on_failure(rows: DataFrame, failed: Column, r: PollRules) -> DataFrame:
    """Drop every row at or after the first failed extraction of its poll."""
    rows = rows.withColumn("_failed", failed)
    first = rows.where("_failed").groupBy(*_pkeys(r)).agg(F.min("pos").alias("_first_fail"))
    return (rows.join(first, _pkeys(r), "left")
                .where(F.col("_first_fail").isNull() | (F.col("pos") < F.col("_first_fail")))
                .drop("_first_fail", "_failed"))


def first_seen(rows: DataFrame, r: PollRules = STD) -> DataFrame:
    """The first row of each (key, publish date) in arrival order. NULL
    dates form one group. ``row_number() = 1`` plans as a group limit: a task
    keeps one row per date before the only shuffle."""
    w = Window.partitionBy(*r.keys, *r.date_keys).orderBy("poll_no", "pos")
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


# ---------------------------------------------------------------------------
# frames

def _bad(polls: DataFrame, r: PollRules) -> Column:
    """A poll that failed, or lacks the total its source needs."""
    bad = F.coalesce(F.col("status") != 200, F.lit(True))
    if "total_results" not in polls.columns:
        return bad
    needs_total = F.col("stop_variant") == "trailing_repeat" if "stop_variant" in polls.columns else F.lit(r.require_total_results)
    return bad | (needs_total & (F.coalesce("total_results", F.lit(0)) <= 0))


#: What a run's later polls need of those before: polls read, duplicates, polls without
#: growth, rows, rows up to the last new one less those behind it, new rows, falsy bodies
#: counted by W5; and whether a rule has ended the run.
COUNTERS = ["turns", "dups", "no_growth", "rows", "rows_at_new", "news", "flags"]


def read_polls(articles: DataFrame, polls: DataFrame, r: PollRules, before: DataFrame | None = None) -> DataFrame:
    """Polls the collector reads, with their turn, policy and W1 position. ``before``
    holds the counters of runs that are taken up again: one that ended reads nothing."""
    own = {c: F.col(c) if c in polls.columns else F.lit(getattr(r, c))
           for c in ("null_policy", "stop_variant", "status_policy")}
    bad = _bad(polls, r)
    run = Window.partitionBy(*r.keys)
    stops = F.min(F.when(F.col("_bad") & (F.col("status_policy") == "stop"), F.col("poll_no"))).over(run)
    p = polls.select(*_pkeys(r), *(c.alias(n) for n, c in own.items()), bad.alias("_bad"))
    turn = F.row_number().over(run.orderBy("poll_no"))
    if before is not None:
        p = p.join(before.select(*r.keys, "turns", "ended"), list(r.keys), "left").where(~F.coalesce("ended", F.lit(False)))
        turn = (turn + F.coalesce("turns", F.lit(0))).cast("int")
    p = (p.withColumn("_stops", stops)
          .where((F.col("status_policy") == "none") | ~F.col("_bad"))
          .where((F.col("status_policy") != "stop") | F.col("_stops").isNull() | (F.col("poll_no") < F.col("_stops")))
          .withColumn("_turn", turn)
          .select(*_turns(r), "poll_no", "null_policy", "stop_variant"))
    failed = (articles.where(F.col(r.content).isNull()).groupBy(*_pkeys(r))
                      .agg(F.min("pos").alias("_first_fail")))
    return p.join(failed, _pkeys(r), "left")


def surviving_rows(articles: DataFrame, polls: DataFrame, r: PollRules) -> DataFrame:
    """Narrow rows of the polls that are read, after W1: keys, turn, position,
    dates, eligibility (W8) and stop variant."""
    content = F.col(r.content)
    narrow = articles.select(*_pkeys(r), "pos", *r.date_keys, truthy(content).alias("_truthy"),
                             truthy(F.col(r.cleaned) if r.cleaned else content).alias("_clean_ok"))
    policy = F.col("null_policy")
    whole = (~policy.isin("truncate", "truncate_skip_empty") | F.col("_first_fail").isNull()
             | (F.col("pos") < F.col("_first_fail")))
    return (narrow.join(polls, _pkeys(r))
                  .where(whole & ((policy != "truncate_skip_empty") | F.col("_clean_ok")))
                  .select(*_turns(r), F.col("pos").cast("long").alias("pos"), *r.date_keys,
                          (~policy.isin("skip_falsy", "as_dup") | F.col("_truthy")).alias("_elig"), "stop_variant"))


def new_rows(rows: DataFrame, r: PollRules, seen: DataFrame | None = None) -> DataFrame:
    """W2 on narrow rows: (keys, date, turn, pos) of the first eligible row per date,
    without the dates a run has ``seen`` before: these came first, as number -1."""
    number = F.shiftleft(F.col("_turn").cast("long"), POS_BITS) + F.col("pos")
    dated = [*r.keys, *r.date_keys]
    numbered = rows.where("_elig").select(*dated, number.alias("_n"))
    if seen is not None:
        numbered = numbered.unionByName(seen.select(*dated, F.lit(-1).cast("long").alias("_n")))
    first = numbered.groupBy(*dated).agg(F.min("_n").alias("_n"))
    if seen is not None:
        first = first.where("_n >= 0")
    return first.select(*dated, F.shiftright("_n", POS_BITS).cast("int").alias("_turn"),
                        F.col("_n").bitwiseAND((1 << POS_BITS) - 1).alias("pos"))


def poll_counts(polls: DataFrame, rows: DataFrame, new: DataFrame, r: PollRules) -> DataFrame:
    """One row per poll with all its counters, polls without rows included."""
    none = F.lit(None)
    parts = (polls.select(*_turns(r), "poll_no", "null_policy", "stop_variant", F.lit(0).alias("row"),
                          F.lit(0).alias("elig"), none.cast("long").alias("at"))
             .unionByName(rows.select(*_turns(r), F.lit(1).alias("row"), F.col("_elig").cast("int").alias("elig")),
                          allowMissingColumns=True)
             .unionByName(new.select(*_turns(r), F.col("pos").alias("at")), allowMissingColumns=True))
    f = parts.groupBy(*_turns(r)).agg(
        F.max("poll_no").alias("poll_no"), F.max("null_policy").alias("null_policy"),
        F.max("stop_variant").alias("stop_variant"), F.coalesce(F.sum("row"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum("elig"), F.lit(0)).alias("_n_elig"), F.count("at").alias("n_new"),
        F.min("at").alias("_first_new"), F.max("at").alias("_last_new"))
    counted = F.when(F.col("null_policy") == "skip_falsy", F.col("_n_elig")).otherwise(F.col("n_rows"))
    return f.withColumn("n_dup", counted - F.col("n_new"))


def _row_counters(f: DataFrame, rows: DataFrame, r: PollRules, variants) -> DataFrame:
    """What W5 and W6 need from rows, joined to the poll frame.

    W6: rows after the last new one. W5: positions of falsy bodies before the
    first new article; more than the threshold per poll cannot matter, so a
    group limit keeps that many.
    """
    marks = f.select(*_turns(r), "_first_new", "_last_new")
    if "trailing_repeat" in variants:
        trail = (rows.where("stop_variant = 'trailing_repeat'").join(marks, _turns(r))
                     .where("pos > _last_new").groupBy(*_turns(r)).agg(F.count(F.lit(1)).alias("_trail")))
        f = f.join(trail, _turns(r), "left").fillna(0, subset=["_trail"])
    if "inpage" in variants:
        w = Window.partitionBy(*_turns(r)).orderBy("pos")
        flagged = (rows.where("stop_variant = 'inpage' and not _elig").join(marks, _turns(r))
                       .where("_first_new is null or pos < _first_new")
                       .withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= r.max_no_growth)
                       .groupBy(*_turns(r)).agg(F.sort_array(F.collect_list("pos")).alias("_flags")))
        f = f.join(flagged, _turns(r), "left").withColumn("_n_flag", F.coalesce(F.size("_flags"), F.lit(0)))
    return f


def stop_rules(f: DataFrame, r: PollRules, variants, before: DataFrame | None = None) -> DataFrame:
    """W4-W7 over the polls of a run: running counters, ``stop``, and the polls
    kept with the position before which their rows count (NULL: all). The counters
    of a run that is taken up again start at those ``before``."""
    run = Window.partitionBy(*r.keys)
    so_far = run.orderBy("_turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    variant = F.col("stop_variant")
    if before is not None:
        was = before.select(*r.keys, *(F.col(c).alias(f"_was_{c}") for c in COUNTERS))
        f = f.join(was, list(r.keys), "left").fillna(0, subset=[f"_was_{c}" for c in COUNTERS])

    def carried(name: str, value: Column) -> Column:
        return value if before is None else value + F.col(f"_was_{name}")

    f = (f.withColumn("cum_dups", carried("dups", F.sum("n_dup").over(so_far)))
          .withColumn("cum_no_growth", carried("no_growth", F.sum((F.col("n_new") == 0).cast("int")).over(so_far))))
    stop = ((F.col("cum_dups") > r.max_dups)
            | ((variant != "inpage") & (F.col("cum_no_growth") >= r.max_no_growth)))
    if "trailing_repeat" in variants:
        # repeats since the last new row = rows so far - rows up to it
        f = f.withColumn("_rows", carried("rows", F.sum("n_rows").over(so_far)))
        upto = F.max(F.when(F.col("n_new") > 0, F.col("_rows") - F.col("_trail"))).over(so_far)
        f = f.withColumn("_upto", F.coalesce(upto, F.lit(0) if before is None else F.col("_was_rows_at_new")))
        f = f.withColumn("_rep", F.col("_rows") - F.col("_upto"))
        stop = stop | ((variant == "trailing_repeat") & (F.col("_rep") == r.rep_stop))
    f = f.withColumn("stop", stop)
    last = F.min(F.when(F.col("stop"), F.col("_turn"))).over(run)
    limit = F.lit(None).cast("long")
    if "cap" in variants:
        # tested before a poll: the poll that meets a full collection is not made
        held = F.coalesce(F.sum("n_new").over(run.orderBy("_turn").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        f = f.withColumn("_full", (variant == "cap") & (carried("news", held) >= r.cap))
        last = F.least(last, F.min(F.when(F.col("_full"), F.col("_turn") - 1)).over(run))
    if "inpage" in variants:
        f = f.withColumn("_cum_flag", carried("flags", F.sum("_n_flag").over(so_far)))
        f = f.withColumn("_ends", F.min(F.when((variant == "inpage") & (F.col("_cum_flag") >= r.max_no_growth),
                                               F.col("_turn"))).over(run))
        last = F.least(last, F.col("_ends"))
        nth = F.lit(r.max_no_growth) - (F.col("_cum_flag") - F.col("_n_flag"))
        limit = F.when(F.col("_turn") == F.col("_ends"), F.get("_flags", (nth - 1).cast("int")))
    return f.withColumn("_last", last).withColumn("_limit", limit)


# ---------------------------------------------------------------------------
# the operator

def _frames(articles: DataFrame, polls: DataFrame, r: PollRules, materialize: bool, variants,
            before: DataFrame | None = None, seen: DataFrame | None = None):
    cut = cut_lineage if materialize else (lambda df: df)
    p = cut(read_polls(articles, polls, r, before))  # poll-level: read by the rows and the counters
    rows = cut(surviving_rows(articles, p, r))  # narrow: read by W2 and the counters
    new = new_rows(rows, r, seen)
    f = poll_counts(p, rows, new, r)
    if {"inpage", "trailing_repeat"} & set(variants):
        new, f = cut(new), cut(f)
        f = _row_counters(f, rows, r, variants)
    return new, stop_rules(f, r, variants, before)


def poll_report(articles: DataFrame, polls: DataFrame, r: PollRules = STD, materialize: bool = True) -> DataFrame:
    """W3 (+W4 counters): per poll that is read, new and duplicate counts, the
    running counters the stop rule reads, and the ``stop`` flag."""
    _, f = _frames(articles, polls, r, materialize, ())
    return f.select(*_pkeys(r), "n_rows", "n_new", "n_dup", "cum_dups", "cum_no_growth", "stop")


def _collected(articles: DataFrame, new: DataFrame, f: DataFrame, r: PollRules) -> DataFrame:
    kept = f.where(F.col("_last").isNull() | (F.col("_turn") <= F.col("_last"))).select(*_turns(r), "poll_no", "_limit")
    accepted = (new.join(kept, _turns(r)).where("_limit is null or pos < _limit")
                   .select(*_pkeys(r), "pos"))
    # payload back for the accepted rows only; (keys, poll_no, pos) is unique
    return articles.join(accepted, _pkeys(r) + ["pos"], "left_semi")


def accept_articles(articles: DataFrame, polls: DataFrame, r: PollRules = STD, materialize: bool = True) -> DataFrame:
    """The articles a fetch run collects, in the columns of ``articles``.

    ``articles`` holds (keys..., poll_no, pos, publishdate, content, ...);
    ``polls`` holds (keys..., poll_no, status[, total_results][, policy
    columns]) with one row per poll, zero-article polls included.
    """
    variants = VARIANTS if "stop_variant" in polls.columns else (r.stop_variant,)
    new, f = _frames(articles, polls, r, materialize, variants)
    return _collected(articles, new, f, r)


def continue_run(articles: DataFrame, polls: DataFrame, before: DataFrame, seen: DataFrame,
                 r: PollRules = STD) -> tuple[DataFrame, DataFrame, DataFrame]:
    """W1-W8 on the polls that came since: (articles collected, counters after them, dates
    they add to those seen).

    ``before`` has one row per run (keys, ``COUNTERS``, ``ended``; a run without a row
    begins), ``seen`` its dates. ``polls`` come after all that ``before`` counts. Runs
    without a poll here have no row in the counters after.
    """
    before, seen = cut_lineage(before), cut_lineage(seen)
    new, f = _frames(articles, polls, r, True, VARIANTS, before, seen)
    new, f = cut_lineage(new), cut_lineage(f)
    # a poll of a bad status ends its run where the policy says so, read or not
    policy = F.col("status_policy") if "status_policy" in polls.columns else F.lit(r.status_policy)
    stopped = polls.groupBy(*r.keys).agg(F.max(_bad(polls, r) & (policy == "stop")).alias("_stopped"))
    counted = f.groupBy(*r.keys).agg(
        F.max("_turn").alias("turns"), F.max("cum_dups").alias("dups"), F.max("cum_no_growth").alias("no_growth"),
        F.max("_rows").alias("rows"), F.max("_upto").alias("rows_at_new"),
        (F.sum("n_new") + F.max("_was_news")).alias("news"), F.max("_cum_flag").alias("flags"),
        F.max(F.col("_last").isNotNull()).alias("_over"))
    was = before.select(*r.keys, *(F.col(c).alias(f"_was_{c}") for c in [*COUNTERS, "ended"]))
    after = (stopped.join(counted, list(r.keys), "left").join(was, list(r.keys), "left")
             .select(*r.keys, *(F.coalesce(c, f"_was_{c}", F.lit(0)).cast("long").alias(c) for c in COUNTERS),
                     F.expr("coalesce(_stopped, false) or coalesce(_over, false) or coalesce(_was_ended, false)").alias("ended")))
    return _collected(articles, new, f, r), after, new.select(*r.keys, *r.date_keys)
