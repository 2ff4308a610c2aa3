"""ST2 in event time: the articles of overlapping polls once each, with state that ends.

A daily request asks for two days of articles, so polls of following days overlap. Where
no stop rule of a run matters (a feed that is read to its end), an article is new if its
source has not published under that date within the window: ``dropDuplicatesWithinWatermark``
on (source, publish date), with the publish time as event time and the window as delay.
Spark keeps one small row per article in the state store and removes it once the watermark
has passed the end of its window, so the state is bounded by what is published in a window,
however long the stream runs. An article older than the watermark is late: it is not taken,
and the number of late rows is reported per batch, with the rows the state holds and has
removed. Articles without a readable publish date have no event time; they pass, and only
their content ids keep them from being stored twice.

Each micro-batch extracts, cleans, chunks, embeds and appends as the batch job does, and a
retried batch adds nothing (content ids).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import chunk as ch
from ..operators import embed as EM
from ..plans import ingest as plan
from ..session import cut_lineage, ship_package
from ..sources import registry, sinks
from .ingest import landing_stream

WINDOW_DAYS = 2
REPORT = ("batch long, watermark string, rows_in long, state_rows long, state_removed long, late_rows long")


def stubs_stream(raw: DataFrame, sources: DataFrame, shape: str = "newsapi") -> DataFrame:
    """Article stubs of landed answers of status 200, with their rule and ``published`` (event time)."""
    stubs, _ = plan.landed(raw.where("status = 200"), shape)
    own = sources.select(F.col("label").alias("source"), "active", F.col("rule_id").alias("_rule"))
    known = stubs.join(F.broadcast(own), "source", "left").where(F.coalesce("active", F.lit(True)))
    return known.select(*stubs.columns, F.coalesce("_rule", F.lit(registry.DEFAULT_RULE)).alias("rule_id"),
                        F.try_to_timestamp("publishdate").alias("published"))


def first_within(stubs: DataFrame, days: int = WINDOW_DAYS) -> DataFrame:
    """The first row of each (source, publish date) within the window; undated rows pass."""
    dated = stubs.where("published is not null").withWatermark("published", f"{days} days")
    once = dated.dropDuplicatesWithinWatermark(["source", "publishdate"])
    return once.unionByName(stubs.where("published is null"))


def append_sink(pages_path: str | None, points_path: str, counts_root: str, embedder, budget: int = ch.DEFAULT_BUDGET, counter=None):
    """``foreachBatch``: bodies, chunks, vectors, append, and the counts of the days it touches (K5)."""

    def run(stubs: DataFrame, epoch: int) -> None:
        spark = stubs.sparkSession
        pages = (spark.read.parquet(pages_path).select("url", "status", "html") if pages_path
                 else spark.createDataFrame([], schemas.PAGES))
        arts = plan.with_bodies(cut_lineage(stubs.drop("published")), pages).where("raw is not null").withColumn("content", F.col("cleaned"))
        points = sinks.with_point_id(plan.to_points(arts, embedder, budget, counter))
        new = cut_lineage(sinks.unstored(points, points_path))
        if new.isEmpty():
            return
        sinks.append_points(new, points_path)
        touched = new.select(*sinks.PARTITIONS).where(F.col("publishday") != sinks.UNDATED).distinct()
        daily = (sinks.read_points(spark, points_path).join(touched, sinks.PARTITIONS, "left_semi").groupBy(*sinks.PARTITIONS)
                 .agg(F.count(F.lit(1)).alias("count")).select(F.col("publishday").alias("date"), "source", "count"))
        sinks.upsert_counts(daily, os.path.join(counts_root, "daily_counts"), ["date", "source"])

    return run


def start(spark: SparkSession, landing: str, points_path: str, counts_root: str, checkpoint: str, embedder,
          shape: str = "newsapi", pages_path: str | None = None, days: int = WINDOW_DAYS, budget: int = ch.DEFAULT_BUDGET,
          counter=None, files_per_batch: int | None = None):
    """Run the event-time stream over what has landed (availableNow) and return the query. State and
    watermark live in the checkpoint, so the next run goes on from them."""
    ship_package(spark)
    EM.resolve(embedder)
    raw = landing_stream(spark, landing, shape, files_per_batch)
    once = first_within(stubs_stream(raw, registry.sources_df(spark, active_only=False), shape), days)
    sink = append_sink(pages_path, points_path, counts_root, embedder, budget, counter)
    return (once.writeStream.foreachBatch(sink).option("checkpointLocation", os.path.join(checkpoint, "window-stream"))
            .trigger(availableNow=True).start())


def report(query, path: str | None = None) -> DataFrame:
    """What the batches of a finished query did to the state: rows held, rows removed behind the
    watermark, late rows not taken. With ``path`` it is appended there."""
    spark = query.sparkSession if hasattr(query, "sparkSession") else SparkSession.getActiveSession()
    rows = []
    for p in query.recentProgress:
        ops = p["stateOperators"]
        rows.append((p["batchId"], (p["eventTime"] or {}).get("watermark"), p["numInputRows"], sum(o["numRowsTotal"] for o in ops),
                     sum(o["numRowsRemoved"] for o in ops), sum(o["numRowsDroppedByWatermark"] for o in ops)))
    out = spark.createDataFrame(rows, REPORT)
    if path:
        out.write.mode("append").parquet(path)
    return out
