"""A corpus from raw documents to token files, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which `run` writes to the shared
folder and reads again as the next stage's `docs`. All but the last return the columns of the
documents; what a stage rejects is gone for those behind it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from evpipe.llm import decontam, lang_id, mixing, near_dedup, token_output
from evpipe.llm.util import read, stage

# A text whose best language is less likely than this is rejected, and so is one without letters.
LEAST_LANGUAGE_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a recognised language. The model learns from this stage's own input.

    When no training row has a language there is nothing to learn from, and all texts with letters
    stay.
    """
    model = lang_id.train(docs.filter(~lang_id.held_out()))
    if model is None:
        return docs.filter(docs["text"].rlike(r"\p{L}"))
    # A table may have columns named like the results; the documents' own columns stay.
    named = docs.select(*(docs[c].alias(f"own_{c}") for c in docs.columns))
    found = lang_id.predict(named, model, "own_text")
    kept = found.filter(
        (found["lang_pred"] != lang_id.UNDETERMINED) & (found["score"] >= LEAST_LANGUAGE_SCORE)
    )
    return kept.select(*(kept[f"own_{c}"].alias(c) for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return near_dedup.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontam.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of their sources takes them."""
    return mixing.mixed(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The digest of the token files, one row per document of the mixture."""
    return token_output.round_trip(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixture),
    ("token_output", token_files),
]

# Learned models, random rounding and a tokenizer can't be told in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
