"""Comparison of runs from their summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evpipe.schema import EXPERIMENT_COLUMNS


def top_reason(reasons: Column) -> Column:
    """`name (count)` of the largest count, the first name among equals, `none` when empty."""
    entries = F.transform(
        F.map_entries(reasons),
        lambda e: F.struct((-e["value"]).alias("order"), e["key"].alias("name")),
    )
    first = F.array_min(entries)
    text = F.concat(first["name"], F.lit(" ("), (-first["order"]).cast("string"), F.lit(")"))
    return F.when(F.coalesce(F.size(reasons), F.lit(0)) <= 0, F.lit("none")).otherwise(text)


def event_mix(counts: Column) -> Column:
    """`name:count` of every type in name order, `none` when empty."""
    parts = F.transform(
        F.array_sort(F.map_entries(counts)),
        lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string")),
    )
    return F.when(F.coalesce(F.size(counts), F.lit(0)) <= 0, F.lit("none")).otherwise(
        F.array_join(parts, ", ")
    )


def quarantine_percent(accepted_percent: Column) -> Column:
    return F.round(F.lit(100.0) - accepted_percent, 2)


def experiment_rows(summaries: DataFrame) -> DataFrame:
    """One flat row per run summary (columns of the summary document plus `run`)."""
    number = lambda path, kind: F.coalesce(F.col(path), F.lit(0)).cast(kind)
    latency = lambda name: F.round(F.col(f"latency_ms.{name}"), 2)
    accepted = F.col("totals.accepted_percent")
    return summaries.select(
        "run",
        number("producer.sent", "bigint").alias("events_sent"),
        number("producer.patients", "bigint").alias("patients"),
        number("producer.rate_limit_events_per_sec", "double").alias("rate_limit"),
        F.round(number("producer.throughput_events_per_sec", "double"), 2).alias(
            "producer_events_per_sec"
        ),
        F.col("totals.valid").alias("valid"),
        F.col("totals.quarantine").alias("quarantine"),
        F.col("totals.alerts").alias("alerts"),
        accepted.alias("accepted_percent"),
        quarantine_percent(accepted).alias("quarantine_percent"),
        latency("avg_ms").alias("avg_latency_ms"),
        latency("p50_ms").alias("p50_latency_ms"),
        latency("p95_ms").alias("p95_latency_ms"),
        latency("max_ms").alias("max_latency_ms"),
        top_reason(F.col("quarantine_reasons")).alias("top_quarantine_reason"),
        event_mix(F.col("event_counts")).alias("event_mix"),
    )


def best_runs(experiments: DataFrame) -> DataFrame:
    """The fastest run and the one with the lowest p95 latency, the first name among equals."""
    fastest = F.min_by("run", F.struct(-F.col("producer_events_per_sec"), "run"))
    lowest = F.min_by("run", F.struct("p95_latency_ms", "run"))
    return experiments.agg(
        fastest.alias("fastest_run"),
        F.max("producer_events_per_sec").alias("producer_events_per_sec"),
        lowest.alias("lowest_latency_run"),
        F.min("p95_latency_ms").alias("p95_latency_ms"),
    )


def experiment_overview(experiments: DataFrame) -> DataFrame:
    return experiments.agg(
        F.count(F.lit(1)).alias("runs"),
        F.coalesce(F.sum("events_sent"), F.lit(0)).alias("events_sent"),
    )


def experiments_markdown(
    experiments: DataFrame, columns: Sequence[str] = EXPERIMENT_COLUMNS
) -> DataFrame:
    """Markdown table lines with their position: header, rule, then the runs by name."""
    spark = experiments.sparkSession
    head = "| " + " | ".join(columns) + " |"
    rule = "| " + " | ".join("---" for _ in columns) + " |"
    top = spark.createDataFrame(
        [(0, "", head), (1, "", rule)], "part int, run string, line string"
    )
    cells = F.concat_ws(" | ", *[F.col(c).cast("string") for c in columns])
    body = experiments.select(
        F.lit(2).alias("part"), "run", F.concat(F.lit("| "), cells, F.lit(" |")).alias("line")
    )
    return top.unionByName(body).orderBy("part", "run").select("line")
