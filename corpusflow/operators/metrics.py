"""A1-A5, A11, K3-K5 helpers and the monitoring queries Q1-Q8.

Count tables are keyed by a date kept as text ``yyyy-MM-dd`` (D8-D10). All
counts are computed from the written points, so they can never lead the
data. Running totals are windows over *per-day* rows (one row per date, or
per date and source), never over raw points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def chunks_per_source(chunks: DataFrame, sources: DataFrame | None = None,
                      source_col: str = "source") -> DataFrame:
    """A1: chunk rows per source for one run; registry sources without a
    chunk report 0 (left join from the registry)."""
    counts = chunks.groupBy(source_col).agg(F.count(F.lit(1)).alias("nb_chunks"))
    if sources is None:
        return counts
    reg = sources.select(F.col("label").alias(source_col)).distinct()
    return reg.join(counts, source_col, "left").fillna(0, subset=["nb_chunks"])


def points_per_source(points: DataFrame, source_col: str = "source") -> DataFrame:
    """A2: one pass over the collection instead of one filtered count per source."""
    return points.groupBy(source_col).agg(F.count(F.lit(1)).alias("n_points"))


def daily_counts(points: DataFrame, date: Column, source_col: str = "source") -> DataFrame:
    """D10 from points: rows landed per (date, source)."""
    return (points.select(F.date_format(date, "yyyy-MM-dd").alias("date"), F.col(source_col).alias("source"))
                  .groupBy("date", "source").agg(F.count(F.lit(1)).alias("count")))


def article_totals(daily: DataFrame) -> DataFrame:
    """Collection size per source after each day's run (running sum over
    the per-day rows of that source)."""
    w = Window.partitionBy("source").orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.select("date", "source", F.sum("count").over(w).cast("bigint").alias("nb_article"))


def vector_totals(daily: DataFrame) -> DataFrame:
    """Whole-collection size after each day's run (A4: before + run).

    The per-date rows (one per run day) are reduced first; the running sum
    is over that small day series only.
    """
    per_day = daily.groupBy("date").agg(F.sum("count").alias("n"))
    w = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_day.select("date", F.sum("n").over(w).cast("bigint").alias("vector_count"))


# --- dashboard views (Q1-Q8); ``today`` is a parameter Column, never now()

def total_today(vector_counts: DataFrame, today: Column) -> DataFrame:
    """Q1 (FL1 + A5): sum of ``vector_count`` on the given date (0 rows -> NULL)."""
    return vector_counts.where(F.col("date") == today).agg(F.sum("vector_count").cast("bigint").alias("total"))


def counts_by_source_on(article_counts: DataFrame, day: Column) -> DataFrame:
    """Q2/Q3 (FL1 + P2 + P3 + P6): drop the date, ``nb_article`` -> ``count``."""
    return (article_counts.where(F.col("date") == day).drop("date")
                          .withColumnRenamed("nb_article", "count"))


def vectors_over_time(vector_counts: DataFrame) -> DataFrame:
    """Q4 (P3 + DT3 + P6): date parsed to a timestamp axis, ``count`` series."""
    # zone-free timestamp: the axis value does not depend on the session time zone
    return vector_counts.select(F.to_timestamp_ntz("date", F.lit("yyyy-MM-dd")).alias("date_ts"), "date",
                                F.col("vector_count").alias("count"))


def totals_renamed(article_counts: DataFrame) -> DataFrame:
    """Q5 (P3)."""
    return article_counts.withColumnRenamed("nb_article", "count")


def daily_on(daily: DataFrame, day: Column) -> DataFrame:
    """Q6/Q7 (FL1/FL2 + DT4): rows of one date, compared as dates."""
    return daily.where(F.to_date("date") == F.to_date(day)).select("date", "source", "count")


def source_over_time(article_counts: DataFrame, source: Column) -> DataFrame:
    """Q8 (FL3 + P6): totals of one source over time."""
    return article_counts.where(F.col("source") == source).select("date", "nb_article")
