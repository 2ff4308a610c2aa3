"""Readers for the landed parquet tables (SC4, SC6-SC9, driver stand-ins).

Every reader selects the columns it needs so Catalyst prunes the parquet
scan (``ReadSchema``) and pushes filters into it (``PushedFilters``).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..session import path_exists

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table, ``{sf_dir}/{name}.parquet``."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    for n in names:
        p = os.path.join(sf_dir, f"{n}.parquet")
        if path_exists(spark, p):
            spark.read.parquet(p).createOrReplaceTempView(n)


def read_count_table(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """SC6-SC8: a count table; a stray ``_id`` column is dropped, an absent
    table reads as empty (the reference raised on an empty collection)."""
    schema = {"vector": schemas.VECTOR_COUNTS, "total": schemas.ARTICLE_COUNTS,
              "daily": schemas.DAILY_COUNTS}[kind]
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    df = spark.read.parquet(path)
    if "_id" in df.columns:
        df = df.drop("_id")
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def read_qa(df: DataFrame) -> DataFrame:
    """SC9: project the Q&A log to its six columns."""
    if "_id" in df.columns:
        df = df.drop("_id")
    return df.select(*schemas.QA_COLUMNS)
