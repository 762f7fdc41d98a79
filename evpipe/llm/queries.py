"""The operators of this folder as queries over the given tables, with SQL where it can tell."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evpipe.llm import (
    byte_bpe,
    collocations,
    decontam,
    lang_id,
    licenses,
    line_dedup,
    mixing,
    near_dedup,
    spelling,
    sql,
    substring_dedup,
    token_output,
    topk,
    toxicity,
)
from evpipe.llm.util import read


def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = lang_id.train(docs.filter(~lang_id.held_out()))
    found = lang_id.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", lang_id.held_out().alias("held_out"), "lang_pred", "score")


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    return decontam.contamination(docs, items)


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.round_trip(read(spark, sf_dir, "documents"))


def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = toxicity.train(
        docs.filter(~toxicity.held_out()), labels.filter(~toxicity.held_out())
    )
    found = toxicity.score(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id", toxicity.held_out().alias("held_out"), "score", "predicted",
        F.size("passages").cast("long").alias("n_passages"),
    )


def license_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.best_licenses(read(spark, sf_dir, "documents"), licenses.template_frame(spark))


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.best_notices(read(spark, sf_dir, "documents"), licenses.notice_frame(spark))


def near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"))


def mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix_digest(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(read(spark, sf_dir, "documents"))


def nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0), 5)


def substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(read(spark, sf_dir, "documents"))


def spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(read(spark, sf_dir, "documents")))


def byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digest(read(spark, sf_dir, "documents"))


def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": language,
    "op2_decontamination": decontamination,
    "op3_token_output": tokens,
    "op4_toxicity": toxic,
    "op5_license_scan": license_scan,
    "license_lines": license_lines,
    "op6_near_dedup": near,
    "op7_mixing": mix,
    "op8_line_dedup": lines,
    "op9_top_k": nearest,
    "op10_substring_dedup": substrings,
    "op11_spelling_variants": spellings,
    "op12_byte_bpe": byte_pairs,
    "op13_collocations": phrases,
    "pipeline": pipeline,
}

# Learned models, random rounding, tokenizers and checksums can't be told in SQL: those are tested
# against held-out rows and plain versions.
ORACLES: dict[str, str] = {
    "op2_decontamination": sql.DECONTAMINATION,
    "license_lines": sql.LICENSES,
    "op6_near_dedup": sql.NEAR,
    "op8_line_dedup": sql.LINES,
    "op9_top_k": sql.NEAREST,
    "op10_substring_dedup": sql.SUBSTRINGS,
    "op13_collocations": sql.COLLOCATIONS,
}
