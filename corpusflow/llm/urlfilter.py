"""URL filters: a temporal list join.

Dated list entries (pattern, time, action) become validity intervals: an entry holds from its time
until the next entry of its pattern; ``remove`` ends one without starting another. An as-of join
finds, for every pattern that a capture's URL falls under, the interval active at its fetch time;
the most specific pattern decides. A pattern is a domain (it covers its subdomains) or a host and
first path segment.

The as-of join works on buckets of time: within a bucket a window carries the last entry forward,
and what a bucket starts with comes from one summary row per pattern and bucket. Buckets are minutes: a
host with a third of all captures, or a pattern with most entries, is dealt to as many groups as its
time range has minutes, also if all of it is one day's crawl. The summary rows are carried on within
a day (1,440 at most), those of days within the pattern (365 a year): bounded by time, not by captures.

Defined results: a null or unparsable URL falls under no pattern, a null fetch time under no
interval: both are allowed with no pattern. A host of more than 253 characters, which no domain name
has, is unparsable; a URL may be of any length. Entries with a null pattern, time or unknown action
are ignored; of several entries of a pattern at one time ``block`` wins over ``allow`` over
``remove``; an entry is active at its own time. Repeated captures give one row; empty tables of
captures give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from .common import prepare

RANK = {"remove": 0, "allow": 1, "block": 2}
#: Unit of time of a bucket of the as-of join; any that ``date_trunc`` knows gives the same rows.
BUCKET = "minute"
#: Unit of time within which the buckets' summary rows of a pattern meet.
SPAN = "day"


def host_of(url: Column) -> Column:
    """Lower-case host of a URL, without user, port and the dots behind a rooted name; empty if it
    is longer than a domain name can be."""
    host = F.rtrim(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?([^/?#:@]+)", 1)), F.lit("."))
    return F.regexp_replace(host, r"(?s)^.{254,}$", "")


def segment_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^/?#]+)", 1)


def intervals(entries: DataFrame, bucket: str = BUCKET) -> DataFrame:
    """Validity intervals (pattern, action, valid_from, valid_to) of dated entries (pattern, ts,
    action); ``valid_to`` is null while an entry still holds."""
    rank = F.when(F.col("action") == "block", 2).when(F.col("action") == "allow", 1).when(F.col("action") == "remove", 0)
    dated = (entries.select("pattern", "ts", rank.alias("rank")).where("pattern is not null and ts is not null and rank is not null")
             .groupBy("pattern", "ts").agg(F.max("rank").alias("rank")).withColumn("bucket", F.date_trunc(bucket, "ts")))
    # the next entry: in the same bucket, else the first one of the pattern's next bucket
    summary = dated.groupBy("pattern", "bucket").agg(F.min("ts").alias("first_ts"))
    after = _beside(summary, "first_ts", F.min("first_ts"), F.lead("first_ts").over, "later").drop("first_ts")
    following = F.lead("ts").over(Window.partitionBy("pattern", "bucket").orderBy("ts"))
    return (dated.withColumn("following", following).join(after, ["pattern", "bucket"])
            .where("rank > 0")
            .select("pattern", F.when(F.col("rank") == 2, "block").otherwise("allow").alias("action"), F.col("ts").alias("valid_from"),
                    F.coalesce("following", "later").alias("valid_to")))


def _beside(summary: DataFrame, value: str, of_span: Column, function: Callable[[WindowSpec], Column], name: str) -> DataFrame:
    """``summary`` (pattern, bucket, ``value``) with ``name``: the ``value`` that ``function`` finds over a
    pattern's buckets in order, in the bucket's own span, else over the spans, of which each stands for
    its buckets by the aggregate ``of_span``."""
    spanned = summary.withColumn("span", F.date_trunc(SPAN, "bucket"))
    own = spanned.withColumn("own", function(Window.partitionBy("pattern", "span").orderBy("bucket")))
    spans = spanned.groupBy("pattern", "span").agg(of_span.alias(value))
    spans = spans.withColumn("far", function(Window.partitionBy("pattern").orderBy("span"))).drop(value)
    return own.join(spans, ["pattern", "span"]).withColumn(name, F.coalesce("own", "far")).drop("span", "own", "far")


def with_patterns(captures: DataFrame, url_col: str = "url") -> DataFrame:
    """``captures`` with one row for each pattern its URL falls under (a null one if there is none):
    its host and parent domains of at least two labels, and host/first segment; ``specific``
    orders them. Host and labels are columns, so that each URL is taken apart once."""
    url, n = F.col(url_col), F.size("labels")
    taken = captures.withColumns({"host": host_of(url), "segment": segment_of(url)}).withColumn("labels", F.split("host", r"\."))
    domains = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.struct(
        F.array_join(F.slice("labels", i, n), ".").alias("pattern"), (n - i + 1).alias("specific")))
    path = F.when(F.col("segment") != "", F.array(F.struct(F.concat("host", F.lit("/"), "segment").alias("pattern"), (n + 1).alias("specific"))))
    under = F.when(F.coalesce("host", F.lit("")) != "", F.concat(domains, F.coalesce(path, F.slice(domains, 1, 0))))
    return taken.withColumn("p", F.explode_outer(under)).select(*captures.columns, "p.pattern", "p.specific")


def evaluate(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", time_col: str = "fetch_ts",
             bucket: str = BUCKET) -> DataFrame:
    """Every capture with its verdict: id, url, fetch_ts, allowed, and the deciding interval's
    pattern, action and valid_from (null if none)."""
    prepare(captures.sparkSession)
    caps = captures.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(time_col).alias("fetch_ts")).distinct()
    keyed = with_patterns(caps)
    spans = intervals(entries, bucket)
    # as of the fetch time, within a bucket; equal pattern, time and bucket are one lookup
    looked = keyed.where("pattern is not null and fetch_ts is not null").select("pattern", F.col("fetch_ts").alias("ts")).distinct()
    empty = F.lit(None).cast("struct<valid_from:timestamp,valid_to:timestamp,action:string>")
    held = F.struct("valid_from", "valid_to", "action")
    both = (looked.select("pattern", "ts", empty.alias("held"))
            .unionByName(spans.select("pattern", F.col("valid_from").alias("ts"), held.alias("held")))
            .withColumn("bucket", F.date_trunc(bucket, "ts")))
    inside = Window.partitionBy("pattern", "bucket").orderBy("ts", F.col("held").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    asof = both.withColumn("last", F.last("held", ignorenulls=True).over(inside)).where("held is null").drop("held")
    # what a bucket starts with: the last interval that starts in an earlier bucket of the pattern
    starts = (both.groupBy("pattern", "bucket").agg(F.max_by("held", F.when(F.col("held").isNotNull(), F.col("ts"))).alias("latest")))
    newest = F.max_by("latest", F.when(F.col("latest").isNotNull(), F.col("bucket")))
    carried = _beside(starts, "latest", newest, lambda w: F.last("latest", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)),
                      "carried").drop("latest")
    active = (asof.join(carried, ["pattern", "bucket"]).withColumn("held", F.coalesce("last", "carried"))
              .where("held is not null and (held.valid_to is null or ts < held.valid_to)")
              .select("pattern", F.col("ts").alias("fetch_ts"), "held"))
    decided = (keyed.join(active, ["pattern", "fetch_ts"]).groupBy("id", "url", "fetch_ts")
               .agg(F.max(F.struct("specific", "pattern", F.col("held.action").alias("action"), F.col("held.valid_from").alias("valid_from"))).alias("d")))
    decided = decided.select(*(F.col(c).alias(f"_{c}") for c in ("id", "url", "fetch_ts")), "d")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("id", "url", "fetch_ts")]
    return (caps.join(decided, same[0] & same[1] & same[2], "left")
            .select(F.col("id").alias(id_col), F.col("url").alias(url_col), F.col("fetch_ts").alias(time_col),
                    F.coalesce(F.col("d.action") != "block", F.lit(True)).alias("allowed"),
                    F.col("d.pattern").alias("pattern"), F.col("d.action").alias("action"), F.col("d.valid_from").alias("valid_from")))
