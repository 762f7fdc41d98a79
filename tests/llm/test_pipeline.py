import brute
from test_operators import SCHEMA, edge_rows

import __spark_entry__ as driver
import corpus_pipeline
from evpipe.llm import lang_id


def test_every_operator_is_registered():
    names = [n for n in driver.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in driver.queries()


def test_stages_follow_each_other(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    before = docs
    for name, function in corpus_pipeline.STAGES:
        after = function(spark, before, sf_dir).cache()
        rows = [(r["doc_id"], r["text"]) for r in before.collect()]
        if name == "token_output":
            assert after.count() == len(rows)
            break
        assert after.columns == docs.columns
        ids = sorted(r["doc_id"] for r in after.select("doc_id").collect())
        if name == "language_id":
            assert len(ids) > 0.95 * len(rows)
        elif name == "near_dedup":
            assert ids == sorted(r[0] for r in brute.near(rows) if r[3])
        elif name == "decontamination":
            assert ids == sorted(r[0] for r in brute.contamination(rows, items) if not r[5])
        elif name == "mixing":
            assert set(ids) <= {r[0] for r in rows}
            assert max(ids.count(i) for i in set(ids)) <= 3
        before = after


def test_stages_on_edges(spark, sf_dir):
    for rows in (edge_rows(), []):
        docs = spark.createDataFrame(rows, SCHEMA)
        for name, function in corpus_pipeline.STAGES:
            docs = function(spark, docs, sf_dir)
            if name != "token_output":
                assert docs.columns == SCHEMA.names
            docs = docs.cache()
            docs.count()


def test_language_stage_rejects_what_has_no_letters(spark, sf_dir):
    docs = spark.createDataFrame(edge_rows(), SCHEMA)
    kept = {r["doc_id"] for r in corpus_pipeline.language_id(spark, docs, sf_dir).collect()}
    for row in edge_rows():
        if not lang_id.has_letter(row[1]):
            assert row[0] not in kept


def test_language_stage_without_languages_keeps_texts_with_letters(spark, sf_dir):
    rows = [(*r[:2], None, *r[3:]) for r in edge_rows()]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = corpus_pipeline.language_id(spark, docs, sf_dir)
    assert found.columns == SCHEMA.names
    kept = sorted(r["doc_id"] for r in found.collect())
    assert kept == [r[0] for r in rows if lang_id.has_letter(r[1])]


def test_language_stage_rejects_no_clean_document(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.language_id(spark, docs, sf_dir).collect()}
    clean = [r["doc_id"] for r in docs.collect() if r["lang"] and lang_id.has_letter(r["text"])]
    assert clean and kept.issuperset(clean)
