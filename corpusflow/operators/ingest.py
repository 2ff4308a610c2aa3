"""J1 / J2 / FL5 / SP*: join article stubs to pages and to the source registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def dedupe_pages(pages: DataFrame, order_col: str | None = None) -> DataFrame:
    """One page per url: one that answered 200 before others, then the first
    landed (``order_col``), then the smallest html, so a re-run picks the same.

    ``row_number() = 1`` plans as a group limit (a task keeps one page per url),
    and the join on url that follows reuses its partitioning.
    """
    by = [F.coalesce(F.col("status") == 200, F.lit(False)).desc()] if "status" in pages.columns else []
    by += [F.col(order_col)] if order_col else []
    by += [F.col("html").asc_nulls_last()] if "html" in pages.columns else []
    w = Window.partitionBy("url").orderBy(*by)
    return pages.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def lookup_pages(articles: DataFrame, pages: DataFrame) -> DataFrame:
    """``articles LEFT JOIN pages USING (url)``.

    Pages are deduplicated on url first so the article cardinality is
    kept; an article without a page gets NULL html/status. Join strategy is
    left to AQE (pages are large: shuffle join on url).
    """
    p = dedupe_pages(pages.select("url", "status", "html"))
    return articles.join(p.withColumnRenamed("status", "page_status"), "url", "left")


def attach_registry(articles: DataFrame, sources: DataFrame, on: str = "source",
                    label_col: str = "label") -> DataFrame:
    """Bind each article to its source settings (Spark broadcasts the registry
    by its size at run time)."""
    reg = sources.withColumnRenamed(label_col, on) if label_col != on else sources
    return articles.join(reg, on, "left")


def date_window(publishdate: Column, run_date: Column, days: int = 1) -> Column:
    """SP1: ``to_date(publishdate)`` in ``[run_date - days, run_date]``."""
    d = F.to_date(F.try_to_timestamp(publishdate))
    return d.between(F.date_sub(run_date, days), run_date)


def request_filter(articles: DataFrame, *, selector_col: str | None = None, selector: str | None = None,
                   lang_col: str | None = None, lang: str | None = None,
                   topic: str | None = None, text_cols=("title", "content"),
                   country_col: str | None = None, country: str | None = None,
                   page_size: int | None = None, rank_col: str = "pos") -> DataFrame:
    """SP2-SP7 on landed data: the predicates a news API applied on request.

    SP2 source/domain equality, SP3 topic as a text match on title/body
    (relevance ranking of the API is not reproducible), SP4 language, SP5
    country, SP7 page size as ``pos < page_size`` (position within the poll
    answer). Every predicate is a plain Column, so Catalyst pushes the
    equalities into the parquet scan.
    """
    df = articles
    if selector is not None and selector_col:
        df = df.where(F.col(selector_col) == selector)
    if lang is not None and lang_col:
        df = df.where(F.col(lang_col) == lang)
    if country is not None and country_col:
        df = df.where(F.col(country_col) == country)
    if topic is not None:
        cond = None
        for c in text_cols:
            if c in df.columns:
                m = F.lower(F.col(c)).contains(topic.lower())
                cond = m if cond is None else cond | m
        if cond is not None:
            df = df.where(cond)
    if page_size is not None:
        df = df.where(F.col(rank_col) < page_size)
    return df


def newest_positions(rows: DataFrame, keys: list[str], time_col: str, id_col: str) -> DataFrame:
    """SP6 over any rows: ``keys``, ``id_col`` and ``position``, the row's place (from 0) among the rows of
    its keys by time, newest first; equal times go by the smaller id, rows without a time come last.

    Rows are range-partitioned by (keys, time, id), so a source with a third of all rows is spread over
    many tasks; a place is the rank within the part plus the rows of the same keys in the parts before, a
    prefix sum over one row per keys and part. Null keys are keys like others; repeated ids of one time
    get places next to each other."""
    narrow = rows.select(*keys, F.col(time_col).alias("_time"), F.col(id_col).alias("_id"))
    by = [F.col("_time").desc_nulls_last(), F.col("_id").asc_nulls_last()]
    parts = cut_lineage(narrow.repartitionByRange(*(F.col(k).asc_nulls_first() for k in keys), *by).withColumn("_part", F.spark_partition_id()))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = parts.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(*(F.col(k).alias(f"_{i}") for i, k in enumerate(keys)), F.col("_part").alias("_p"),
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*by))
    same = F.col("_part") == F.col("_p")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_{i}"))
    placed = parts.withColumn("_rank", inside).join(offsets, same)
    return placed.select(*keys, F.col("_id").alias(id_col), (F.col("_before") + F.col("_rank") - 1).alias("position"))


def first_n_per_poll(rows: DataFrame, keys: list[str], order_col: str, n: Column | int, most: int | None = None) -> DataFrame:
    """SP7 / L2: the first ``n`` rows of each poll answer, ``n`` a number or a
    column of at most ``most``. ``row_number() <= most`` plans as a group limit:
    each map task keeps at most that many rows per poll before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(order_col)
    rows = rows.withColumn("_rn", F.row_number().over(w))
    if most is not None:
        rows = rows.where(F.col("_rn") <= most)
    return rows.where(F.col("_rn") <= n).drop("_rn")
