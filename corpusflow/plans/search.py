"""Entry point B: semantic search over the points table (V2q + V3 + payload)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import embed as EM
from ..operators import vectors as V
from ..sources import sinks


def search(points: DataFrame, queries: DataFrame, k: int, embedder,
           text_col: str = "text", id_col: str = "query_id", metric: str = "cosine") -> DataFrame:
    """Best ``k`` points per query text, best first, with their payload.

    ``queries`` holds ``(query_id, text)``; texts are embedded by the embedder
    given (Arrow UDF), points scanned once.
    """
    qv = EM.embed_column(queries.select(id_col, text_col), text_col, EM.resolve(embedder))
    payload = [c for c in ("title", "content", "publishdate", "source") if c in points.columns]
    res = V.topk_search(points, qv, k, id_col="point_id", qid_col=id_col, metric=metric, payload=payload)
    return res.withColumnRenamed("query_id", id_col)


def search_texts(spark: SparkSession, points_path: str, texts: list[str], k: int = 5, **kw) -> DataFrame:
    """Convenience form: a handful of query strings against a stored points table."""
    q = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "query_id long, text string")
    return search(sinks.read_points(spark, points_path), q, k, **kw).orderBy("query_id", "rank")


def count_by_source(points: DataFrame, source: str | None = None) -> DataFrame:
    """Filtered count (one source, partition-pruned) or all sources at once."""
    if source is not None:
        return points.where(F.col("source") == source).agg(F.count(F.lit(1)).alias("count"))
    return points.groupBy("source").agg(F.count(F.lit(1)).alias("count"))
