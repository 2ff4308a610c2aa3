"""The pipeline's stages: columns, decisions and edge cases."""

import __spark_entry__ as E
import corpus_pipeline
from corpusflow.llm import queries, simhash
from conftest import SF01

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, fp int, lang_pred string"


def test_registered():
    names = E.queries()
    assert {"pipeline", *queries.QUERIES} <= set(names) and len([n for n in names if n.startswith("op")]) == 13
    assert [len(s) for s in corpus_pipeline.STAGES] == [2] * 4 and corpus_pipeline.ORACLE_SQL is None


def test_stages_keep_columns_and_decide(spark):
    clean = "The quick thing and the other thing are here with the rest of that. "
    texts = [clean * 3, clean * 3, clean.upper() * 3, None, "", "12 34", "stupid idiot moron scum " + clean, "Der schein und die auf der einen ist das nicht mit den", clean * 20_000]
    rows = [(i, t, None, "s", 1, 0.1, 2, "x") for i, t in enumerate(texts)] + [(7, texts[7], None, "s", 1, 0.1, 2, "x")]
    docs = spark.createDataFrame(rows, SCHEMA)
    (_, toxicity), (_, language), (_, dedup), (_, pack) = corpus_pipeline.STAGES
    kept = toxicity(spark, docs, SF01)
    assert kept.columns == docs.columns and {r[0] for r in kept.select("doc_id").collect()} == {0, 1, 2, 3, 4, 5, 7, 8}
    known = language(spark, spark.read.parquet(f"{SF01}/documents.parquet"), SF01)
    assert known.columns == ["doc_id", "text", "lang", "source", "n_chars"] and known.count() == 1000
    one = dedup(spark, docs, SF01)
    assert one.columns == docs.columns
    found = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    ids = sorted(r[0] for r in one.select("doc_id").collect())
    assert ids == sorted({c for c in found.values()}) and found[1] == found[2] == 0
    assert pack(spark, docs, SF01).where("doc_id = 8").agg({"length": "sum"}).first()[0] > 200_000
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), SF01).count() == 0


def test_dedup_stage_keeps_documents_without_an_id(spark):
    one, two, three = ("one text that stands for itself", "another text and nothing like it", "a third one with other words in it")
    rows = [(None, one), (4, one), (None, two), (None, two), (9, three), (9, three), (None, None), (3, "")]
    docs = spark.createDataFrame([(i, t, None, "s", 1, 0.1, 2, "x") for i, t in rows], SCHEMA)
    kept = corpus_pipeline.STAGES[2][1](spark, docs, SF01)
    assert kept.columns == docs.columns
    assert sorted(((r[0] or 0), r[1]) for r in kept.select("doc_id", "text").collect()) == [(0, two), (3, ""), (4, one), (9, three)]


def test_dedup_stage_keeps_a_row_of_every_component(spark):
    """One id with several texts, of which some are copies of other ids' rows."""
    one, two, three = ("one text that stands for itself", "another text and nothing like it", "a third one with other words in it")
    rows = [(2, one), (2, two), (2, two), (5, two), (5, three), (7, three), (1, one)]
    docs = spark.createDataFrame([(i, t, None, "s", 1, 0.1, 2, "x") for i, t in rows], SCHEMA)
    kept = corpus_pipeline.STAGES[2][1](spark, docs, SF01)
    assert sorted(map(tuple, kept.select("doc_id", "text").collect())) == [(1, one), (2, two), (5, three)]
    apart = docs.where("doc_id = 2")
    kept = corpus_pipeline.STAGES[2][1](spark, apart, SF01)
    assert sorted(map(tuple, kept.select("doc_id", "text").collect())) == sorted([(2, one), (2, two)])


def test_language_stage_drops_only_what_has_no_letter(spark):
    table = spark.read.parquet(f"{SF01}/documents.parquet")
    extra = spark.createDataFrame([(10**6, None, None, None, None), (10**6 + 1, "", None, None, None), (10**6 + 2, "1 + 1", None, None, None)], table.schema)
    kept = corpus_pipeline.STAGES[1][1](spark, table.unionByName(extra), SF01)
    assert kept.count() == 1000


def test_dedup_stage_carries_columns_of_any_name(spark):
    names = ["key of the row", "Hash of the text", "copy of a kept row", "copy of a kept row_"]
    docs = spark.createDataFrame([(1, "one text here", 1, 2, 3, 4), (2, "one text here", 5, 6, 7, 8)], ["doc_id", "text", *names])
    kept = corpus_pipeline.STAGES[2][1](spark, docs, SF01)
    assert kept.columns == docs.columns and [tuple(r)[2:] for r in kept.collect()] == [(1, 2, 3, 4)]


def test_run_equals_its_stages(spark):
    import os
    from corpusflow.session import checkpoint_dir
    folder = checkpoint_dir(spark).removeprefix("file:")
    there = set(os.listdir(folder))
    got = corpus_pipeline.run(spark, SF01).toPandas()
    # of the stages' tables only the one the result reads is left
    left = {n for n in set(os.listdir(folder)) - there if n.startswith(("toxicity-", "language-id-", "simhash-near-dedup-"))}
    assert len(left) == 1 and left.pop().startswith("simhash-near-dedup-")
    toxic = {r[0] for r in queries.op4(spark, SF01).where("predicted = 1").select("doc_id").collect()}
    left = spark.read.parquet(f"{SF01}/documents.parquet").where(~simhash.F.col("doc_id").isin(list(toxic)))
    keep = {r[0] for r in simhash.near_duplicates(left).where("doc_id = component_id").select("doc_id").collect()}
    assert set(got.doc_id) == keep
    by = got.groupby("doc_id")
    assert (by["length"].sum() == by["doc_tokens"].first()).all()
