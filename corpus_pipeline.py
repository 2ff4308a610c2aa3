"""Documents to training sequences: toxicity, language, near-duplicates, packing.

``run`` applies the stages to the documents table, writing and rereading each stage's rows in the
shared checkpoint folder; a stage's input goes once its output is written. Every stage but the last
returns the columns of its input unchanged. The models are learned from the tables in ``sf_dir``,
whatever documents a stage is given.

Defined results: a null text is an empty one to every stage (not toxic, no language, so it ends at the
second stage); a document without an id is a document of its own, told by its text; of repeated rows
the SimHash stage keeps one; texts are taken whole, whatever their length; an empty table gives an
empty result; other columns are carried through and may have any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from corpusflow.llm import langid, packing, simhash, toxicity
from corpusflow.llm.common import prepare, removed, table, written
from corpusflow.llm.queries import byte_bpe_encoder, language_model, toxicity_model


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose toxicity score is below 0.3."""
    prepare(spark)
    verdict = toxicity.scorer(toxicity_model(spark, sf_dir))(F.col("text"))
    return docs.where(verdict["score"] < 0.3)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without text or any letter (``und``). Which language is predicted, and with
    what score, has no effect here: a text with letters in no learned language passes."""
    prepare(spark)
    verdict = langid.scorer(language_model(spark, sf_dir))(F.col("text"))
    return docs.where(verdict["lang"] != "und")


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each SimHash component: one with the smallest id whose own text lies in the
    component, or, of a component without ids, one of its rows. Different texts under one id that
    are no near copies of each other are in components of their own, and each has a row kept."""
    key, text_hash, turn = (_unused(docs, name) for name in ("key of the row", "hash of the text", "copy of a kept row"))
    # a row without an id is told by its text; such keys follow those of rows with an id
    by_text = F.shiftrightunsigned(F.xxhash64("text"), 2).bitwiseOR(F.lit(1 << 62))
    keyed = docs.withColumns({key: F.coalesce("doc_id", by_text), text_hash: F.xxhash64("text")})
    found = simhash.components(keyed, id_col=key, words_per_shingle=3, radius=3, also=(text_hash,))
    keep = (found.where("doc_id = component_id").groupBy(F.col("doc_id").alias(key), "root")
            .agg(F.min(text_hash).alias(text_hash)).drop("root"))
    same = [key, text_hash]
    once = Window.partitionBy(*same).orderBy(text_hash)
    return (keyed.join(keep, same, "left_semi").withColumn(turn, F.row_number().over(once))
            .where(F.col(turn) == 1).select(*docs.columns))


def _unused(docs: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``docs`` has it."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of at most 2048 tokens; one row per piece."""
    return packing.pieces(packing.pack(docs, byte_bpe_encoder, end_id=1, cut=True))


STAGES = [
    ("toxicity", toxicity_stage),
    ("language id", language_stage),
    ("simhash near-dedup", simhash_stage),
    ("packing", packing_stage),
]

#: SQL has neither the learners, XXH64 nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        kept = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        removed(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
