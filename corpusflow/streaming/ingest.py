"""ST1-ST3: incremental ingest with Structured Streaming, for every source.

* ST1: ``readStream`` over the landing folder of poll answers (explicit schema),
  trigger ``availableNow`` for the daily run.
* ST2: a run is taken up where its last batch left it. The state holds, per run,
  the number of the next poll, the counters of the arrival-order rules and whether
  a rule ended it; the publish dates it has seen; and the polls that landed ahead
  of a missing one. All are dealt to buckets by a hash of the run, one folder per
  micro-batch and bucket, so a batch reads the buckets of its own runs (partition
  filters) and of these no article that was judged before. The rules are those of
  the batch job, continued (``order.continue_run``), so polls may arrive in any
  file, batch or order. A poll whose predecessor has not landed waits, and the gap
  is reported. A strict source's answer without its list (SC3) has landed, so
  nothing waits for it; it is set aside before the rules and reported, as in the
  batch job. A poll that landed twice is judged once, by its first answer.
* ST3: ``foreachBatch`` chunks, embeds and appends the newly accepted articles
  with content ids, and adds the batch's own new points to the counts. Every
  source that is run, polled or stored has a total, 0 if it has nothing.

State folder: ``runs`` (next poll, counters, what a run waits for), ``dates``,
``waiting_polls`` and ``waiting_rows``, all by bucket; ``set_aside``, ``polled``
(sources), ``failed`` (pages whose extraction failed, and why), ``added`` (new points
per publish day and source), ``base`` (the same of a store that was there before),
``gaps`` (all runs that wait for a missing poll).
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators import chunk as ch
from ..operators import embed as EM
from ..operators import order
from ..plans import ingest as plan
from ..session import cut_lineage, path_exists, ship_package
from ..sources import registry, sinks

RUN = ["run_id", "source"]
POLL = RUN + ["poll_no"]
#: Buckets of the state: a batch reads those its runs fall into.
BUCKETS = 64
RUN_STATE = ("run_id string, source string, next_poll int, last_landed int, "
             + ", ".join(f"{c} long" for c in order.COUNTERS) + ", ended boolean")


def landing_stream(spark: SparkSession, landing: str, shape: str = "newsapi", files_per_batch: int | None = None) -> DataFrame:
    """ST1: landed poll answers as a streaming DataFrame."""
    reader = spark.readStream.schema(schemas.POLL_GUARDIAN if shape == "guardian" else schemas.POLL_NEWSAPI)
    raw = (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).json(landing)
    return raw.withColumn("run_id", F.coalesce(F.col("run_id"), F.lit("")))


def bucket_of(df: DataFrame) -> Column:
    return F.pmod(F.xxhash64(*(df[c] for c in RUN)), F.lit(BUCKETS)).cast("int")


def contiguous(polls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(polls from their run's ``next_poll`` up to the first missing number, all others).
    Poll-level rows only."""
    run = Window.partitionBy(*RUN)
    placed = polls.withColumn("_place", F.row_number().over(run.orderBy("poll_no")) - 1 + F.col("next_poll"))
    placed = placed.withColumn("_gap", F.min(F.when(F.col("poll_no") != F.col("_place"), F.col("_place"))).over(run)).drop("_place")
    ready = F.col("_gap").isNull() | (F.col("poll_no") < F.col("_gap"))
    return placed.where(ready).drop("_gap"), placed.where(~ready).drop("_gap")


def one_answer(polls: DataFrame) -> DataFrame:
    """One row of each poll: an answer that landed twice is one poll, set aside only if
    every answer is."""
    w = Window.partitionBy(*POLL).orderBy("set_aside")
    return polls.withColumn("_copy", F.row_number().over(w)).where("_copy = 1").drop("_copy")


class State:
    """Tables of the state folder, one sub-folder per micro-batch, written with overwrite: a
    retried batch replaces its own. Tables of runs are dealt to buckets below it."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def path(self, name: str) -> str:
        return os.path.join(self.root, name)

    def put(self, name: str, df: DataFrame, epoch: int, by_bucket: bool = False) -> None:
        out = df.withColumn("bucket", bucket_of(df)) if by_bucket else df
        w = out.write.mode("overwrite").option("partitionOverwriteMode", "static")
        (w.partitionBy("bucket") if by_bucket else w).parquet(os.path.join(self.path(name), f"epoch={epoch}"))

    def has(self, name: str, epoch: int | None = None) -> bool:
        return path_exists(self.spark, self.path(name) if epoch is None else os.path.join(self.path(name), f"epoch={epoch}"))

    def get(self, name: str, like: T.StructType, before: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        """Batches of a table (with their ``epoch``), or those before one, and of some buckets."""
        keys = [T.StructField("epoch", T.LongType())] + ([] if buckets is None else [T.StructField("bucket", T.IntegerType())])
        schema = T.StructType([*like.fields, *keys])
        if not self.has(name):
            return self.spark.createDataFrame([], schema).drop("bucket")
        t = self.spark.read.schema(schema).option("basePath", self.path(name)).parquet(self.path(name))
        if before is not None:
            t = t.where(F.col("epoch") < before)
        return t if buckets is None else t.where(F.col("bucket").isin(buckets)).drop("bucket")


def as_of(runs: DataFrame) -> DataFrame:
    """What the last batch that touched a run left of it (its ``epoch`` included)."""
    value = F.struct(*(c for c in runs.columns if c not in RUN))
    return runs.groupBy(*RUN).agg(F.max_by(value, "epoch").alias("_last")).select(*RUN, "_last.*")


def points_sink(pages_path: str | None, points_path: str, counts_root: str, state_root: str, embedder,
                shape: str = "newsapi", run_date: str | None = None, budget: int = ch.DEFAULT_BUDGET, counter=None,
                newest: list[str] | tuple = ()):
    """ST2 + ST3: a ``foreachBatch`` function from landed answers to points and counts.

    Daily counts (K5) are keyed by publish day; with ``run_date`` that day's
    collection totals (K4 per source, K3 overall) are upserted too. ``newest`` as in the
    batch job: answers of these sources are put in order as they land.
    """

    def run(raw: DataFrame, epoch: int) -> None:
        spark = raw.sparkSession
        state = State(spark, state_root)
        sources = registry.sources_df(spark, active_only=False)
        pages = (spark.read.parquet(pages_path).select("url", "status", "html") if pages_path
                 else spark.createDataFrame([], schemas.PAGES))
        raw = cut_lineage(raw)
        stubs, polls = plan.landed(raw, shape, newest)
        polls = cut_lineage(one_answer(plan.with_policy(polls, sources).withColumn("set_aside", F.expr("strict and no_list"))))
        stubs = stubs.dropDuplicates([*POLL, "pos"])
        rows = cut_lineage(plan.with_bodies(plan.requested(stubs, polls, run_date), pages))
        state.put("set_aside", polls.where("set_aside").drop("set_aside"), epoch)
        state.put("polled", polls.select("source").distinct(), epoch)
        state.put("failed", plan.failures(rows), epoch)

        # the runs of this batch as the last batch that touched each left it
        touched = cut_lineage(polls.select(*RUN).distinct())
        buckets = [r[0] for r in touched.select(bucket_of(touched)).distinct().collect()]  # at most BUCKETS numbers
        schema = spark.createDataFrame([], RUN_STATE).schema
        was = cut_lineage(touched.join(as_of(state.get("runs", schema, epoch, buckets)), RUN, "left").fillna(0, ["next_poll", "last_landed", *order.COUNTERS])
                          .withColumn("ended", F.coalesce("ended", F.lit(False))))
        mine = was.where("epoch is not null").select(*RUN, "epoch")
        ahead = lambda name, like: state.get(name, like.schema, epoch, buckets).join(mine, [*RUN, "epoch"], "left_semi").drop("epoch")
        landed = one_answer(ahead("waiting_polls", polls).unionByName(polls)).join(was.select(*RUN, "next_poll"), RUN).where("poll_no >= next_poll")
        ready, early = (cut_lineage(x) for x in contiguous(landed))
        here = ahead("waiting_rows", rows).unionByName(rows).dropDuplicates([*POLL, "pos"])
        seen = state.get("dates", T.StructType([rows.schema[c] for c in (*RUN, "publishdate")]), epoch, buckets).drop("epoch").join(touched, RUN, "left_semi")
        fresh, after, dates = plan.resume(here.join(ready.select(*POLL), POLL, "left_semi"), ready.where("not set_aside").drop("set_aside"), was, seen)
        fresh = cut_lineage(fresh)
        reached = ready.groupBy(*RUN).agg((F.max("poll_no") + 1).cast("int").alias("_next"))
        furthest = landed.groupBy(*RUN).agg(F.max("poll_no").alias("_far"))
        after = after.select(*RUN, *(F.col(c).alias(f"_{c}") for c in [*order.COUNTERS, "ended"]))
        now = cut_lineage(was.join(reached, RUN, "left").join(furthest, RUN, "left").join(after, RUN, "left")
                          .select(*RUN, F.coalesce("_next", "next_poll").alias("next_poll"),
                                  F.greatest("last_landed", F.coalesce("_far", F.lit(0))).cast("int").alias("last_landed"),
                                  *(F.coalesce(f"_{c}", c).alias(c) for c in [*order.COUNTERS, "ended"])))
        state.put("runs", now, epoch, by_bucket=True)
        state.put("dates", dates, epoch, by_bucket=True)
        state.put("waiting_polls", early.drop("next_poll"), epoch, by_bucket=True)
        state.put("waiting_rows", here.join(early.select(*POLL), POLL, "left_semi"), epoch, by_bucket=True)
        waits = F.col("last_landed") >= F.col("next_poll")
        if not state.has("gaps") or not now.unionByName(was.select(now.columns)).where(waits).isEmpty():
            # run-level rows: a batch that neither leaves nor ends a gap does not read them
            every = as_of(state.get("runs", schema, epoch + 1))
            every.where(waits).select(*RUN, F.col("next_poll").alias("missing_poll"), "last_landed").write.mode("overwrite").parquet(state.path("gaps"))

        points = sinks.with_point_id(plan.to_points(fresh, embedder, budget, counter))
        if not state.has("base"):
            before = (sinks.read_points(spark, points_path).groupBy(*sinks.PARTITIONS).agg(F.count(F.lit(1)).alias("n"))
                      if path_exists(spark, points_path) else spark.createDataFrame([], "source string, publishday string, n long"))
            state.put("base", before, 0)
        new = cut_lineage(sinks.unstored(points, points_path))
        if not state.has("added", epoch):  # a retry keeps what the first try counted, before it stored
            state.put("added", new.groupBy(*sinks.PARTITIONS).agg(F.count(F.lit(1)).alias("n")), epoch)
        if not new.isEmpty():  # a folder without a file could not be read by the next batch
            sinks.append_points(new, points_path)
        counts(spark, state, counts_root, epoch, run_date, sources)

    return run


def counts(spark: SparkSession, state: State, counts_root: str, epoch: int, run_date: str | None, sources: DataFrame) -> None:
    """K3-K5 from the batches' own additions; the store is not read. Totals start from the
    sources that are run: the active ones of the registry, those polled and those stored."""
    like = spark.createDataFrame([], "source string, publishday string, n long").schema
    added = state.get("base", like).unionByName(state.get("added", like))
    touched = spark.read.parquet(os.path.join(state.path("added"), f"epoch={epoch}")).select(*sinks.PARTITIONS).distinct()
    per_day = added.groupBy(*sinks.PARTITIONS).agg(F.sum("n").alias("n"))
    daily = (per_day.join(touched, sinks.PARTITIONS, "left_semi").where(F.col("publishday") != sinks.UNDATED)
                    .select(F.col("publishday").alias("date"), "source", F.col("n").alias("count")))
    sinks.upsert_counts(daily, os.path.join(counts_root, "daily_counts"), ["date", "source"])
    if run_date is not None:
        day = F.lit(run_date)
        polled = state.get("polled", T.StructType([T.StructField("source", T.StringType())])).select("source")
        run = sources.where("active").select(F.col("label").alias("source")).union(polled)
        totals = (added.select("source", "n").union(run.select("source", F.lit(0).cast("long")))
                  .groupBy("source").agg(F.sum("n").alias("nb_article")).select(day.alias("date"), "source", "nb_article"))
        sinks.upsert_counts(totals, os.path.join(counts_root, "article_counts"), ["date", "source"])
        vec = added.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("vector_count")).select(day.alias("date"), "vector_count")
        sinks.upsert_counts(vec, os.path.join(counts_root, "vector_counts"), ["date"])


def start(spark: SparkSession, landing: str, points_path: str, counts_root: str, checkpoint: str, embedder,
          shape: str = "newsapi", pages_path: str | None = None, run_date: str | None = None,
          budget: int = ch.DEFAULT_BUDGET, counter=None, files_per_batch: int | None = None, newest: list[str] | tuple = ()):
    """Run the stream over what has landed (availableNow) and return the query. The
    state tables live beside the stream's checkpoint."""
    ship_package(spark)
    EM.resolve(embedder)
    sink = points_sink(pages_path, points_path, counts_root, os.path.join(checkpoint, "run-state"), embedder, shape, run_date, budget, counter, newest)
    return (landing_stream(spark, landing, shape, files_per_batch).writeStream.foreachBatch(sink).option("checkpointLocation", os.path.join(checkpoint, "stream"))
            .trigger(availableNow=True).start())
