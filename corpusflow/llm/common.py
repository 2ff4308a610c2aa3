"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusflow.session import checkpoint_dir, cut_lineage, ship_package

#: Rows of one Arrow batch: bounds the texts a Python worker holds at a time.
ARROW_ROWS = 256


def prepare(spark: SparkSession) -> None:
    """Ship the package to the executors and bound the Arrow batches of text operators."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a table in the shared checkpoint folder and reread it. The table goes
    when the session's file system closes, or before, by ``removed``."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    folder, fs = _folder(spark, path)
    fs.deleteOnExit(folder)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def removed(table: DataFrame) -> None:
    """Delete the table behind what ``written`` returned, once nothing will read it again; any other
    frame is left alone."""
    path = vars(table).get("written_at")
    if path:
        folder, fs = _folder(table.sparkSession, path)
        fs.delete(folder, True)


def _folder(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest node of the component of every node that has an edge.

    ``edges`` has two long columns ``a`` and ``b``; the result has ``node`` and ``root``.
    Alternating large-star and small-star rounds: each is a partial minimum per node and a
    join back, so a node with very many edges is pre-aggregated and AQE can split its join.
    Every round is a reliable checkpoint; no edge or label reaches the driver, only one count
    and checksum a round. Null ends and self-loops are ignored; no edges give an empty result.
    """
    e = (edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
         .where("a is not null and b is not null and a <> b").distinct())
    e = cut_lineage(e)
    seen = None
    while True:
        # large-star: every larger neighbour of u points to the smallest of u's neighbourhood
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        # small-star: u and its smaller neighbours point to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        e = (joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
             .unionByName(joined.select("u", F.col("m").alias("v"))).distinct())
        e = cut_lineage(e)
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == now:
            break
        seen = now
    # converged: every edge joins a node to the root of its component
    return (e.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
