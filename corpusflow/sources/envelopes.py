"""SC1-SC3: landed API answers (one JSON object per poll) as DataFrames.

Schemas are explicit (never inferred). Arrival order survives as
``(poll_no, pos)`` columns, so no later shuffle can lose it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas


def parse_json_col(c, ddl: str) -> Column:
    """JS1: nested key access in JSON text with an explicit DDL schema."""
    col = F.col(c) if isinstance(c, str) else c
    return F.from_json(col, ddl)


def read_polls(spark: SparkSession, path: str, shape: str = "newsapi") -> DataFrame:
    """Poll envelopes with an explicit schema; a missing run id reads as ''
    (the order rules join on it, and NULL keys never match)."""
    schema = schemas.POLL_GUARDIAN if shape == "guardian" else schemas.POLL_NEWSAPI
    raw = spark.read.schema(schema).json(path)
    return raw.withColumn("run_id", F.coalesce(F.col("run_id"), F.lit("")))


def asked_folders(windows: dict[str, int | None], run_date: str, default: int | None, date_col: str = "landing_date") -> Column:
    """Folders (``landing_date``, ``source``) that a run of ``run_date`` reads: for each source those of
    its own request window in days, all of one without a window, and those of the ``default`` for
    sources that are not listed. Literals on partition columns, so the rest is pruned."""
    import datetime as dt

    day = dt.date.fromisoformat(run_date)
    by_window: dict[int | None, list[str]] = {}
    for source, days in windows.items():
        by_window.setdefault(days, []).append(source)

    def inside(days: int | None) -> Column:
        if days is None:
            return F.col(date_col) <= run_date
        return F.col(date_col).between((day - dt.timedelta(days=days)).isoformat(), run_date)

    asked = ~F.col("source").isin(sorted(windows)) & inside(default)
    for days, names in by_window.items():
        asked = asked | (F.col("source").isin(sorted(names)) & inside(days))
    return asked


def read_polls_window(spark: SparkSession, root: str, run_date: str, days: int | None = 1, shape: str = "newsapi",
                      date_col: str = "landing_date", windows: dict[str, int | None] | None = None) -> DataFrame:
    """SP1 / SP2 on landed data: a landing folder partitioned by ``landing_date=`` (yyyy-MM-dd), and
    below it by ``source=`` if ``windows`` gives each source its own, read for the days that are asked
    for only. The predicates are on the partition columns, so other folders are pruned, not read."""
    from pyspark.sql import types as T
    base = schemas.POLL_GUARDIAN if shape == "guardian" else schemas.POLL_NEWSAPI
    schema = T.StructType(base.fields + [T.StructField(date_col, T.StringType())])
    raw = spark.read.schema(schema).option("basePath", root).json(root)
    raw = raw.where(asked_folders(windows or {}, run_date, days, date_col))
    return raw.withColumn("run_id", F.coalesce(F.col("run_id"), F.lit("")))


def newest_first(raw: DataFrame, sources: list[str], shape: str = "newsapi") -> DataFrame:
    """SP6: the answers of ``sources`` with their articles by publish time, newest first; articles of one
    time keep the order in which they landed, and those without a readable time come last. An answer is
    one row, so this is a sort within the row: no shuffle, and the positions that follow are the new order."""
    if not sources:
        return raw
    items = F.col("response.results") if shape == "guardian" else F.col("articles")
    time = "webPublicationDate" if shape == "guardian" else "publishedAt"
    age = lambda a: F.coalesce(-F.unix_micros(F.try_to_timestamp(a[time])), F.lit((1 << 63) - 1))
    keyed = F.transform(items, lambda a, i: F.struct(age(a).alias("age"), i.alias("i"), a.alias("a")))
    ordered = F.transform(F.array_sort(keyed), lambda x: x["a"])
    ordered = F.when(F.col("source").isin(sources), ordered).otherwise(items)
    if shape == "guardian":
        return raw.withColumn("response", F.when(F.col("response").isNotNull(), F.struct(ordered.alias("results"))))
    return raw.withColumn("articles", ordered)


def poll_table(raw: DataFrame, shape: str = "newsapi") -> DataFrame:
    """One row per poll, zero-article polls included (needed by W4); ``no_list``
    marks an answer of 200 without its ``articles`` key (SC3)."""
    tr, missing = F.lit(None).cast("bigint"), F.lit(False)
    if shape != "guardian":
        tr, missing = F.col("totalResults"), F.coalesce((F.col("status") == 200) & F.col("articles").isNull(), F.lit(False))
    return raw.select("run_id", "source", "poll_no", "status", tr.alias("total_results"), missing.alias("no_list"))


def newsapi_articles(raw: DataFrame) -> DataFrame:
    """SC1: ``articles`` in arrival order; a missing list reads as empty."""
    ex = raw.select("run_id", "source", "poll_no", "status",
                    F.posexplode(F.coalesce("articles", F.array())).alias("pos", "a"))
    return ex.select("run_id", "source", "poll_no", "pos", F.col("a.title").alias("title"),
                     F.col("a.url").alias("url"), F.col("a.publishedAt").alias("publishdate"),
                     "status")


def guardian_articles(raw: DataFrame) -> DataFrame:
    """SC2: stubs with the body inline; no page lookup and no status check."""
    ex = raw.select("run_id", "source", "poll_no", "status",
                    F.posexplode(F.coalesce("response.results", F.array())).alias("pos", "r"))
    return ex.select("run_id", "source", "poll_no", "pos",
                     F.col("r.fields.headline").alias("title"), F.lit(None).cast("string").alias("url"),
                     F.col("r.webPublicationDate").alias("publishdate"),
                     F.col("r.fields.body").alias("content"), "status")


def strict_articles(raw: DataFrame, on_missing: str = "quarantine"):
    """SC3: the ``articles`` key is required on a successful poll.

    ``on_missing="quarantine"`` returns ``(good, quarantine)``: polls
    answering 200 without ``articles`` are set aside instead of aborting the
    whole run. ``on_missing="error"`` fails the job on the first such poll
    (``raise_error``), like a strict key access.
    """
    bad = (F.col("status") == 200) & F.col("articles").isNull()
    if on_missing == "error":
        # a predicate, so the check is evaluated on every poll (never pruned)
        fail = F.raise_error(F.concat(F.lit("poll without articles: "), F.col("source"),
                                      F.lit(" #"), F.col("poll_no").cast("string")))
        return newsapi_articles(raw.where(F.when(bad, fail).isNull()))
    return newsapi_articles(raw.where(~bad)), raw.where(bad)
