"""Entry point C: the monitoring views (Q1-Q10) over the stored count and Q&A tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import metrics as M
from ..operators import qa as QA
from ..sources import tables


def views(spark: SparkSession, counts_root: str, day: str, source: str | None = None,
          qa: DataFrame | None = None, scorer=None) -> dict[str, DataFrame]:
    """All dashboard views for ``day`` (and a chosen source); empty tables
    give empty views (FL7: the caller shows "no data"). A Q&A table without
    stored scores needs a pair scorer."""
    vec = tables.read_count_table(spark, os.path.join(counts_root, "vector_counts"), "vector")
    tot = tables.read_count_table(spark, os.path.join(counts_root, "article_counts"), "total")
    daily = tables.read_count_table(spark, os.path.join(counts_root, "daily_counts"), "daily")
    d = F.lit(day)
    out = {
        "total_today": M.total_today(vec, d),                       # Q1
        "counts_by_source_today": M.counts_by_source_on(tot, d),     # Q2, Q3
        "vectors_over_time": M.vectors_over_time(vec),               # Q4
        "totals_by_source": M.totals_renamed(tot),                   # Q5
        "daily_today": M.daily_on(daily, d),                         # Q6
        "daily_all": daily,                                          # Q6
        "sources": tot.select("source").distinct(),                  # A11
    }
    if source is not None:
        out["source_over_time"] = M.source_over_time(tot, F.lit(source))  # Q8
    if qa is not None:
        scored = qa if "Entailment" in qa.columns else QA.with_entailment(tables.read_qa(qa), scorer)
        out["qa_kpis"] = QA.kpis(scored)                              # Q9
        out["qa_table"] = QA.qa_table(scored)                         # Q10
    return out


def daily_on(spark: SparkSession, counts_root: str, day: str) -> DataFrame:
    """Q7: daily counts of a chosen date, by source."""
    daily = tables.read_count_table(spark, os.path.join(counts_root, "daily_counts"), "daily")
    return M.daily_on(daily, F.lit(day))


def materialise_scores(qa: DataFrame, out_path: str, logits) -> DataFrame:
    """Score every Q&A row once (V5r) and store it, so views read the score
    instead of running the pair model on each render. Appends only rows not
    scored yet (keyed by question, answer, timestamp)."""
    from ..session import path_exists
    base = tables.read_qa(qa)
    spark = qa.sparkSession
    if path_exists(spark, out_path):
        keys = ["question", "answer", "timestamp"]
        done = spark.read.parquet(out_path).select(*[F.col(k).alias(f"_d_{k}") for k in keys])
        cond = None
        for k in keys:  # null-safe: a missing timestamp is still the same row
            c = base[k].eqNullSafe(done[f"_d_{k}"])
            cond = c if cond is None else cond & c
        base = base.join(done, cond, "left_anti")
    scored = QA.with_entailment(base, logits)
    scored.write.mode("append").parquet(out_path)
    return spark.read.parquet(out_path)
