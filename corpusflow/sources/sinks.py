"""K1-K5: points table and keyed count tables.

* K1 append points: content ids by default (``sha2`` over the payload), a
  ``left_anti`` against the ids stored under the batch's own sources and
  publish days (dynamic partition pruning reads only those folders), then an
  append partitioned by ``source`` and ``publishday``, sorted by id. A re-run
  appends nothing; a task retry recomputes the same ids (``uuid()`` would
  not). ``id_mode='random'`` mirrors the reference's fresh id per row
  (re-runs duplicate).
* K3-K5 upserts: set-or-insert by key = dynamic partition overwrite of the
  touched keys only; ``upsert_frame`` is the same rule as a DataFrame
  (old rows whose key is not in the batch, plus the batch).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists

ID_SEP = "\u001f"
NULL_TAG = "\u001e"  # a missing value and '' are different contents
UNDATED = "undated"
PARTITIONS = ["source", "publishday"]


def publish_day(publishdate) -> Column:
    """Folder of a point: its publish day, ``undated`` if that does not parse."""
    return F.coalesce(F.date_format(F.try_to_timestamp(publishdate), "yyyy-MM-dd"), F.lit(UNDATED))


def read_points(spark: SparkSession, path: str, like: DataFrame | None = None) -> DataFrame:
    """The stored points; partition values stay text whatever the session infers. A store
    that is not there yet is one without points, with the columns of ``like``."""
    if like is not None and not path_exists(spark, path):
        return like.limit(0)
    stored = spark.read.parquet(path)
    return stored.withColumns({c: F.col(c).cast("string") for c in PARTITIONS if c in stored.columns})


def with_point_id(df: DataFrame, mode: str = "content",
                  cols=("source", "publishdate", "title", "chunk_idx", "content")) -> DataFrame:
    if mode == "random":
        return df.withColumn("point_id", F.expr("uuid()"))
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_TAG)) for c in cols]
    return df.withColumn("point_id", F.sha2(F.concat_ws(ID_SEP, *parts), 256))


def new_points(batch: DataFrame, existing: DataFrame | None) -> DataFrame:
    """Rows of ``batch`` whose id is not stored yet (and once per id)."""
    b = batch.dropDuplicates(["point_id"])
    if existing is None:
        return b
    keys = [c for c in PARTITIONS if c in b.columns and c in existing.columns] + ["point_id"]
    return b.join(existing.select(*keys), keys, "left_anti")


def unstored(batch: DataFrame, path: str, id_mode: str = "content") -> DataFrame:
    """The points of a batch (with ``publishday``) that ``path`` does not hold yet."""
    b = batch if "point_id" in batch.columns else with_point_id(batch, id_mode)
    b = b.withColumn("publishday", publish_day(F.col("publishdate")))
    if id_mode == "random":
        return b
    existing = None
    if path_exists(b.sparkSession, path):
        existing = read_points(b.sparkSession, path).join(b.select(*PARTITIONS).distinct(), PARTITIONS, "left_semi")
    return new_points(b, existing)


def append_points(new: DataFrame, path: str, max_records_per_file: int | None = None) -> None:
    """K1: append points that are new (``unstored``), in folders by source and
    publish day, sorted by id so that a page of ids reads few row groups.

    K2: file writers batch on their own; ``max_records_per_file`` bounds the
    file size when many small appends would otherwise make large files.
    """
    w = new.sortWithinPartitions(*PARTITIONS, "point_id").write.mode("append").partitionBy(*PARTITIONS)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.parquet(path)


def upsert_frame(old: DataFrame | None, new: DataFrame, keys: list[str]) -> DataFrame:
    """K3-K5 rule as a frame: a later batch replaces the rows of its keys."""
    if old is None:
        return new
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def upsert_counts(df: DataFrame, path: str, keys: list[str]) -> None:
    """K3-K5 physically: overwrite only the partitions of the touched keys.

    Needs ``spark.sql.sources.partitionOverwriteMode=dynamic`` (set by
    ``session.get_spark``); the key columns are the partition columns.
    """
    spark = df.sparkSession
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    df.write.mode("overwrite").partitionBy(*keys).parquet(path)
