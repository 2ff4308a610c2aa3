"""Entry point A as one lazy plan up to the points write.

read polls -> explode (SC1/SC2/SC3) -> request settings and registry (J2, SP1,
SP7) -> page lookup per distinct url (J1) -> extract (X*) -> clean (T6) ->
arrival-order rules, every source's policy in one pass (W1-W8) -> chunk (C1)
-> embed (V2) -> append points (K1) -> counts from what was written (A1-A4,
K3-K5).

The batch of new points is checkpointed into the shared checkpoint folder
before the write, so the write and the counts read one materialised batch (no
second extraction pass, and no re-evaluation against the updated table). The
stream (``streaming/ingest.py``) runs the same steps on what has landed so far.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import chunk as ch
from ..operators import embed as EM
from ..operators import extract as X
from ..operators import ingest as J
from ..operators import metrics as M
from ..operators import order
from ..session import cut_lineage, ship_package
from ..sources import envelopes, registry, sinks

POLICY = ["rule_id", "null_policy", "stop_variant", "status_policy", "page_size", "window_days", "strict"]


def landed(raw: DataFrame, shape: str = "newsapi", newest: list[str] | tuple = ()) -> tuple[DataFrame, DataFrame]:
    """(stubs, polls) of landed answers: stubs ``run_id, source, poll_no, pos, title,
    url, publishdate, inline``; polls with ``no_list`` (200 without the articles key).
    Answers of the sources ``newest`` are put in order of publish time first (SP6)."""
    raw = envelopes.newest_first(raw, list(newest), shape)
    if shape == "guardian":
        stubs = envelopes.guardian_articles(raw).withColumnRenamed("content", "inline")
    else:
        stubs = envelopes.newsapi_articles(raw).withColumn("inline", F.lit(None).cast("string"))
    return stubs.drop("status"), envelopes.poll_table(raw, shape)


def with_policy(polls: DataFrame, sources: DataFrame) -> DataFrame:
    """Polls of sources that are run, with their settings. A source the registry
    lists as inactive is not run; one it does not list runs under the plain
    settings and the default rule."""
    reg = sources.select(F.col("label").alias("source"), "active", *POLICY)
    plain = {"rule_id": registry.DEFAULT_RULE, "null_policy": "truncate", "stop_variant": "std",
             "status_policy": "stop", "page_size": registry.DEFAULT_REQUEST["page_size"], "strict": False}
    listed = F.col("active").isNotNull()
    out = J.attach_registry(polls, reg, label_col="source").where(F.coalesce("active", F.lit(True)))
    settings = {c: F.when(listed, F.col(c)).otherwise(F.lit(v)) for c, v in plain.items()}
    settings["window_days"] = F.when(listed, F.col("window_days")).otherwise(F.lit(registry.DEFAULT_REQUEST["window_days"]))
    return out.withColumns(settings).drop("active")


def requested(stubs: DataFrame, polls: DataFrame, run_date: str | None) -> DataFrame:
    """Stubs of ``polls`` as the source's request asks for them: its page size (SP7)
    and, with a run date, its window of publish days (SP1; undated stubs stay)."""
    out = stubs.join(polls.select("run_id", "source", "poll_no", "rule_id", "page_size", "window_days"),
                     ["run_id", "source", "poll_no"]).where("pos < page_size")
    if run_date is not None:
        day = F.to_date(F.try_to_timestamp("publishdate"))
        until = F.to_date(F.lit(run_date))
        inside = (day >= F.date_sub(until, F.col("window_days"))) & (day <= until)
        out = out.where(F.col("window_days").isNull() | F.coalesce(inside, F.lit(True)))
    return out.drop("page_size", "window_days")


def with_bodies(stubs: DataFrame, pages: DataFrame) -> DataFrame:
    """Stubs with ``raw`` (inline, or extracted from the page), ``cleaned`` and
    ``extract_error`` (why an extraction failed). A page polled again, or wanted under
    several rules, is looked up and parsed once."""
    asked = stubs.where("inline is null").groupBy("url").agg(F.collect_set("rule_id").alias("rules"))
    todo = J.lookup_pages(asked, pages)
    bodies = (X.extract_all(todo, registry.RULES, status_col="page_status")
               .select("url", "rule_id", F.col("content").alias("body"), "extract_error"))
    out = stubs.join(bodies, ["url", "rule_id"], "left")
    raw = F.when((F.col("rule_id") == "X0") | F.col("inline").isNotNull(), F.col("inline")).otherwise(F.col("body"))
    return out.withColumn("raw", raw).withColumn("cleaned", tx.remove_tags("raw")).drop("body", "inline")


def failures(rows: DataFrame) -> DataFrame:
    """Quarantine of a batch: every page whose extraction failed, once per rule, with the reason."""
    return rows.where("extract_error is not null").select("source", "url", "rule_id", "extract_error").distinct()


def accept(arts: DataFrame, polls: DataFrame) -> DataFrame:
    """The articles a run keeps, all policies in one pass."""
    out = order.accept_articles(arts, polls, order.PollRules(content="raw", cleaned="cleaned"))
    return out.select("run_id", "source", "poll_no", "pos", "title", "url", "publishdate",
                      F.col("cleaned").alias("content"))


def resume(arts: DataFrame, polls: DataFrame, before: DataFrame, seen: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``accept`` for polls that came since: (articles, counters after them, dates they add)."""
    out, after, dates = order.continue_run(arts, polls, before, seen, order.PollRules(content="raw", cleaned="cleaned"))
    out = out.select("run_id", "source", "poll_no", "pos", "title", "url", "publishdate", F.col("cleaned").alias("content"))
    return out, after, dates


def collect_articles(spark: SparkSession, polls_raw: DataFrame, pages: DataFrame,
                     guardian_raw: DataFrame | None = None, sources: DataFrame | None = None,
                     run_date: str | None = None, newest: list[str] | tuple = ()) -> DataFrame:
    """Accepted articles of one run: ``run_id, source, poll_no, pos, title,
    url, publishdate, content`` (content = cleaned body). Answers of the
    sources ``newest`` (``registry.newest_first_labels()``: those that ask for it) are put in that
    order, all others stay as landed."""
    return _collect(spark, polls_raw, pages, guardian_raw, sources, run_date, newest)[0]


def _collect(spark, polls_raw, pages, guardian_raw=None, sources=None, run_date=None, newest=()):
    """(accepted articles, polls that were read, polls set aside, failed extractions)."""
    ship_package(spark)
    sources = sources if sources is not None else registry.sources_df(spark, active_only=False)
    stubs, polls = landed(polls_raw, newest=newest)
    if guardian_raw is not None:
        g_stubs, g_polls = landed(guardian_raw, "guardian", newest)
        stubs, polls = stubs.unionByName(g_stubs), polls.unionByName(g_polls)
    polls = cut_lineage(with_policy(polls, sources))  # one row per API call
    aside = polls.where("strict and no_list")  # SC3: an answer without its list is set aside
    polls = polls.where("not (strict and no_list)")
    # extracted and cleaned once; the order rules and the payload join read this copy
    arts = cut_lineage(with_bodies(requested(stubs, polls, run_date), pages))
    return accept(arts, polls), polls, aside, failures(arts)


def to_points(arts: DataFrame, embedder, budget: int = ch.DEFAULT_BUDGET, counter=None) -> DataFrame:
    """Chunks of accepted articles (word mode, or ``counter``: a factory of a token
    counter) with their vectors."""
    keep = ["source", "title", "publishdate"]
    if counter is None:
        chunks = ch.word_chunks(arts.select(*keep, "content"), "content", keep=keep, budget=budget)
    else:
        chunks = ch.token_chunks(arts.select(*keep, "content"), "content", keep, budget, counter)
    return EM.embed_column(chunks, "content", EM.resolve(embedder))


def run_ingest(spark: SparkSession, polls_raw: DataFrame, pages: DataFrame, run_date: str,
               points_path: str, counts_root: str, embedder=None,
               guardian_raw: DataFrame | None = None, budget: int = ch.DEFAULT_BUDGET,
               id_mode: str = "content", counter=None, sources: DataFrame | None = None,
               newest: list[str] | tuple = ()) -> dict:
    """Run one ingest; returns the written frames (new points, daily counts), the polls
    set aside for their missing list and the pages whose extraction failed."""
    EM.resolve(embedder)  # before any work
    sources = sources if sources is not None else registry.sources_df(spark, active_only=False)
    arts, polls, aside, failed = _collect(spark, polls_raw, pages, guardian_raw, sources, run_date, newest)
    batch = cut_lineage(sinks.with_point_id(to_points(arts, embedder, budget, counter), id_mode))
    new = cut_lineage(sinks.unstored(batch, points_path, id_mode))
    if not new.isEmpty():  # a first run without an article leaves no store, not a folder that cannot be read
        sinks.append_points(new, points_path)

    # every source that is run reports, with 0 if it has nothing: the active ones of
    # the registry, those polled, and those stored
    day = F.lit(run_date)
    run = sources.where("active").select(F.col("label").alias("source")).union(polls.select("source")).distinct()
    daily = (M.chunks_per_source(batch, run.withColumnRenamed("source", "label"))
              .select(day.alias("date"), "source", F.col("nb_chunks").alias("count")))
    stored = M.points_per_source(sinks.read_points(spark, points_path, batch))
    totals = (stored.join(run, "source", "full")
                    .select(day.alias("date"), "source", F.coalesce("n_points", F.lit(0)).cast("long").alias("nb_article")))
    totals = cut_lineage(totals)  # one row per source
    vec = totals.agg(F.sum("nb_article").alias("vector_count")).select(day.alias("date"), "vector_count")
    sinks.upsert_counts(daily, os.path.join(counts_root, "daily_counts"), ["date", "source"])
    sinks.upsert_counts(totals, os.path.join(counts_root, "article_counts"), ["date", "source"])
    sinks.upsert_counts(vec, os.path.join(counts_root, "vector_counts"), ["date"])
    return {"batch": batch, "daily": daily, "set_aside": aside, "failed": failed}
