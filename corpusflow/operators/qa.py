"""Q&A quality figures: V5 / V5r entailment, CA1 row state, CA2 KPI levels,
A6-A10 aggregates, M1 guarded accuracy, FL4 threshold, T8 preview (Q9, Q10).

The pair scorer is injected: any callable ``(questions, answers) -> logits``
run inside an Arrow ``pandas_udf`` (model loaded once per Python worker).
``stub_pair_logits`` is a deterministic stand-in for tests and the driver
tables; it is a length heuristic, not an entailment model.
"""

from __future__ import annotations

from typing import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import preview
from ..functions.vectors import softmax_at

ENTAILMENT_MIN = 0.2  # rows at or below are left out of the mean (FL4)


def stub_pair_logits(question, answer) -> Column:
    """Deterministic 3-class logits from text lengths (stand-in only)."""
    q = F.coalesce(F.length(question), F.lit(0)).cast("double")
    a = F.coalesce(F.length(answer), F.lit(0)).cast("double")
    return F.array(a / 100.0, q / 100.0, F.lit(1.0).cast("double"))


def pair_logits_udf(factory: Callable[[], Callable[[list, list], np.ndarray]]):
    """V5: injected scorer as an Arrow UDF returning ARRAY<DOUBLE> logits."""
    state = {}

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def _score(q: pd.Series, a: pd.Series) -> pd.Series:
        if "fn" not in state:
            state["fn"] = factory()
        logits = np.asarray(state["fn"](q.fillna("").tolist(), a.fillna("").tolist()), dtype="float64")
        return pd.Series(list(logits))

    return _score


def with_entailment(qa: DataFrame, logits: Column | str) -> DataFrame:
    """V5r: add ``Entailment`` = softmax(logits)[0] per row. ``logits`` is a column
    (``pair_logits_udf``), or ``"lengths"`` for the stand-in."""
    from ..session import ship_package
    ship_package(qa.sparkSession)
    if logits is None or (isinstance(logits, str) and logits != "lengths"):
        raise ValueError("name a pair scorer: a column, or 'lengths' for the stand-in")
    lg = stub_pair_logits(F.col("question"), F.col("answer")) if isinstance(logits, str) else logits
    # logits land in their own column first: an injected (Python) scorer may
    # not sit inside the higher-order functions of the native softmax
    return qa.withColumn("_logits", lg).withColumn("Entailment", softmax_at(F.col("_logits"), 0)).drop("_logits")


def with_cosine_similarity(qa: DataFrame, question_vec: str, answer_vec: str) -> DataFrame:
    """V4r: ``cosine_similarity`` of a question vector and an answer vector
    (two real vectors; the token-0 / token-1 quirk is not mirrored)."""
    from ..functions.vectors import cosine
    return qa.withColumn("cosine_similarity", cosine(question_vec, answer_vec))


def row_state(upvote="upvote", downvote="downvote", flag="flag") -> Column:
    """CA1: first match wins: up, down, flag, none."""
    return (F.when(F.col(upvote) == 1, "up").when(F.col(downvote) == 1, "down")
             .when(F.col(flag) == 1, "flag").otherwise("none"))


def kpis(qa_scored: DataFrame) -> DataFrame:
    """Q9: A6-A10 in one global aggregate, then M1 and CA2."""
    agg = qa_scored.agg(
        F.coalesce(F.sum("upvote"), F.lit(0)).cast("bigint").alias("upvotes"),
        F.coalesce(F.sum("downvote"), F.lit(0)).cast("bigint").alias("downvotes"),
        F.avg(F.when(F.col("Entailment") > ENTAILMENT_MIN, F.col("Entailment"))).alias("avg_entailment"),
        F.count(F.lit(1)).cast("bigint").alias("n_questions"),
        F.coalesce(F.sum("flag"), F.lit(0)).cast("bigint").alias("n_flags"),
    )
    votes = F.col("upvotes") + F.col("downvotes")
    acc = F.when(votes > 0, F.col("upvotes") / votes * 100.0).otherwise(F.lit(0.0))
    return (agg.withColumn("accuracy", acc)
               .withColumn("accuracy_level", F.when(F.col("accuracy") < 50, "bad").otherwise("good"))
               # an empty mean is NULL and falls to otherwise, like NaN < 0.5 in pandas
               .withColumn("entailment_level", F.when(F.col("avg_entailment") < 0.5, "bad").otherwise("good"))
               .withColumn("flags_level", F.when(F.col("n_flags") != 0, "warn").otherwise("ok")))


def qa_table(qa_scored: DataFrame) -> DataFrame:
    """Q10: rows with state and preview."""
    return qa_scored.withColumn("state", row_state()).withColumn("preview", preview("question", 50))
