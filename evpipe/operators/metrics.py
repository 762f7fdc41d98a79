"""Counts, totals, throughput and the run summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evpipe.functions.numeric import accepted_percent, number_or_zero, share_of_max
from evpipe.functions.text import preview
from evpipe.operators.percentiles import latency_summary, nearest_rank, values_at_ranks
from evpipe.operators.prefix import dense_positions, running_max
from evpipe.schema import (
    ALERT_TYPE,
    SUMMARY_EVENT_TYPES,
    SUMMARY_REASONS,
    THROUGHPUT_BUCKET,
)

def count_by(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def count_by_type(accepted: DataFrame) -> DataFrame:
    return count_by(accepted, "event_type")


def count_by_reason(quarantined: DataFrame) -> DataFrame:
    return count_by(quarantined, "reason")


def count_for_keys(
    df: DataFrame, key: str, wanted: Sequence[str], drop_zeros: bool = False
) -> DataFrame:
    """Counts for a fixed list of keys, zero for absent ones; other keys are not reported."""
    keys = df.sparkSession.createDataFrame(
        [(i, name) for i, name in enumerate(wanted)], f"position int, {key} string"
    )
    counts = count_by(df.filter(F.col(key).isin(*wanted)), key)
    found = keys.join(counts, key, "left").select(
        key, F.coalesce("n", F.lit(0)).alias("n"), "position"
    )
    kept = found.filter("n > 0") if drop_zeros else found
    return kept.drop("position")


def alert_count(alerts: DataFrame) -> DataFrame:
    return count_by(alerts, "alert_type")


def event_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def run_totals(events: DataFrame, alerts: DataFrame) -> DataFrame:
    """valid, quarantine, alerts, processed, accepted_percent of routed events."""
    counted = events.agg(
        F.count_if("accepted").alias("valid"),
        F.count_if(~F.col("accepted")).alias("quarantine"),
    )
    n_alerts = alerts.agg(F.count(F.lit(1)).alias("alerts"))
    total = F.col("valid") + F.col("quarantine")
    return counted.crossJoin(n_alerts).select(
        "valid",
        "quarantine",
        "alerts",
        total.alias("processed"),
        accepted_percent(F.col("valid"), total).alias("accepted_percent"),
    )


def outcome_counters(routed: DataFrame) -> DataFrame:
    """Counters of a local-profile run (alerts are counted by `alert_count`)."""
    return routed.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("accepted").alias("accepted"),
        F.count_if(~F.col("accepted")).alias("quarantined"),
        F.count_if(F.col("reason") == "duplicate_event_id").alias("duplicates"),
        F.count_if(F.col("reason") == "late_event").alias("late"),
        F.count_if(F.col("accepted") & F.col("out_of_order")).alias("out_of_order"),
    )


def counts_map(counts: DataFrame, key: str, out: str) -> DataFrame:
    """A (small) count table as one map with its keys in order."""
    pairs = F.array_sort(F.collect_list(F.struct(key, "n")))
    return counts.agg(F.map_from_entries(pairs).alias(out))


def reason_map(quarantined: DataFrame) -> DataFrame:
    return counts_map(count_by_reason(quarantined), "reason", "reasons")


def ranked_reasons(quarantined: DataFrame) -> DataFrame:
    """Reasons by falling count, with the bar length relative to the largest."""
    counts = count_by_reason(quarantined)
    return counts.select(
        F.col("reason").alias("name"),
        F.col("n").alias("value"),
        share_of_max(F.col("n")).alias("percent_of_max"),
    ).orderBy(F.desc("value"), "name")


def quarantine_samples(quarantined: DataFrame, n: int = 5) -> DataFrame:
    """The first quarantined records in arrival order, with a preview of the record text."""
    return (
        quarantined.orderBy("arrival_seq")
        .limit(n)
        .select("arrival_seq", "reason", preview(F.col("raw")).alias("preview"))
    )


def run_throughput(events: DataFrame) -> DataFrame:
    """Duration between first and last ingest, and records per second.

    Both are null when all records have one ingest time, as the lines of a text batch do: nothing
    was measured then.
    """
    spanned = events.agg(
        F.count(F.lit(1)).alias("total"),
        ((F.max("processed_ms") - F.min("processed_ms")) / 1000.0).alias("seconds"),
    )
    duration = F.when(F.col("seconds") > 0, F.col("seconds"))
    return spanned.select(
        "total",
        duration.alias("duration_sec"),
        (F.col("total") / duration).alias("throughput_eps"),
    )


def throughput_buckets(events: DataFrame, size: int = THROUGHPUT_BUCKET) -> DataFrame:
    """Records per second of each `size` consecutive arrivals, and of the rest at the end.

    A bucket lasts from the end of the one before (the first: from the first ingest) to its own,
    where an end is the largest ingest time so far. `arrival_seq` is unique and may have gaps: a
    bucket is `size` arrivals whatever their numbers.
    """
    narrow = events.select("arrival_seq", "processed_ms")
    placed = dense_positions(narrow, "arrival_seq", "_position")
    buckets = placed.groupBy(F.expr(f"_position div {size}").alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"),
        F.max("processed_ms").alias("_end"),
    )
    start = events.agg(F.min("processed_ms").alias("_start"))
    ends = running_max(buckets, "bucket", "_end", "_before", inclusive=False)
    begin = F.coalesce("_before", "_start")
    seconds = F.greatest(
        (F.greatest("_end", begin) - begin) / 1000.0, F.lit(1e-9)
    )
    return ends.crossJoin(F.broadcast(start)).select(
        "bucket", "n", seconds.alias("seconds"), (F.col("n") / seconds).alias("events_per_sec")
    )


def build_summary(
    events: DataFrame, alerts: DataFrame, producer: DataFrame, name: str = "event run"
) -> DataFrame:
    """The run summary as one nested row.

    `events` are routed events with `ingestion_latency_ms`; `producer` has at most one row.
    Only the listed types and reasons are counted, as in the fixed report.
    """
    accepted = events.filter("accepted")
    by_type = counts_map(
        count_for_keys(accepted, "event_type", SUMMARY_EVENT_TYPES), "event_type", "event_counts"
    )
    by_reason = counts_map(
        count_for_keys(events.filter("not accepted"), "reason", SUMMARY_REASONS, drop_zeros=True),
        "reason",
        "quarantine_reasons",
    )
    raised = alerts.filter(F.col("alert_type") == ALERT_TYPE).agg(
        F.count(F.lit(1)).alias("alerts")
    )
    latency = latency_summary(accepted).select(
        F.struct("avg_ms", "p50_ms", "p95_ms", "max_ms").alias("latency_ms")
    )
    several = F.raise_error(F.lit("more than one producer document"))
    run = producer.agg(
        F.when(F.count(F.lit(1)) > 1, several.cast("int")).alias("_check"),
        F.first(F.struct(*producer.columns)).alias("producer"),
    ).filter("_check IS NULL").drop("_check")
    add = lambda acc, v: acc + v
    valid = F.aggregate(F.map_values("event_counts"), F.lit(0).cast("bigint"), add)
    rejected = F.aggregate(F.map_values("quarantine_reasons"), F.lit(0).cast("bigint"), add)
    # Every side is a single row.
    parts = by_type.crossJoin(by_reason).crossJoin(raised).crossJoin(latency).crossJoin(run)
    return parts.withColumns({"valid": valid, "quarantine": rejected}).select(
        F.lit(name).alias("pipeline"),
        F.unix_millis(F.current_timestamp()).alias("generated_at_epoch_ms"),
        F.struct(
            "valid",
            "quarantine",
            "alerts",
            (F.col("valid") + F.col("quarantine")).alias("processed"),
            accepted_percent(F.col("valid"), F.col("valid") + F.col("quarantine")).alias(
                "accepted_percent"
            ),
        ).alias("totals"),
        "event_counts",
        "quarantine_reasons",
        "latency_ms",
        "producer",
    )


def run_metrics(routed: DataFrame, alerts: DataFrame, size: int = THROUGHPUT_BUCKET) -> DataFrame:
    """All counters of a local-profile run in one row, latencies of accepted records included.

    The records per second of each `size` arrivals are a table of their own (`throughput_buckets`):
    there is one for every `size` records, so the row holds only how many there are, and the least,
    mean and largest rate.
    """
    rate = F.col("events_per_sec")
    buckets = throughput_buckets(routed, size).agg(
        F.struct(
            F.count(F.lit(1)).alias("buckets"), F.min(rate).alias("min_eps"),
            F.avg(rate).alias("mean_eps"), F.max(rate).alias("max_eps"),
        ).alias("bucket_throughput")
    )
    accepted = routed.filter("accepted")
    percentiles = values_at_ranks(
        accepted, "ingestion_latency_ms", {"p50": nearest_rank(50), "p95": nearest_rank(95)}
    ).select(
        F.coalesce("p50", F.lit(0.0)).alias("p50_latency_ms"),
        F.coalesce("p95", F.lit(0.0)).alias("p95_latency_ms"),
    )
    mean = accepted.agg(
        F.coalesce(F.avg("ingestion_latency_ms"), F.lit(0.0)).alias("mean_latency_ms")
    )
    return (
        outcome_counters(routed)
        .crossJoin(alerts.agg(F.count(F.lit(1)).alias("alerts")))
        .crossJoin(run_throughput(routed).drop("total"))
        .crossJoin(percentiles)
        .crossJoin(mean)
        .crossJoin(reason_map(routed.filter("not accepted")))
        .crossJoin(buckets)
    )


def local_summary(routed: DataFrame, alerts: DataFrame) -> DataFrame:
    """Types, reasons, samples, alert count and metrics of a local-profile run in one row."""
    rejected = routed.filter("not accepted")
    types = counts_map(count_by_type(routed.filter("accepted")), "event_type", "event_types")
    samples = quarantine_samples(rejected).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("arrival_seq", "reason", "preview"))),
            lambda s: F.struct(s["reason"].alias("reason"), s["preview"].alias("preview")),
        ).alias("samples")
    )
    metrics = run_metrics(routed, alerts)
    return (
        types.crossJoin(reason_map(rejected))
        .crossJoin(samples)
        .crossJoin(alerts.agg(F.count(F.lit(1)).alias("alert_count")))
        .crossJoin(metrics.select(F.struct("*").alias("metrics")))
    )


def summary_series(summary: DataFrame) -> DataFrame:
    """Name/value series of a run summary: outcome pair and performance figures."""
    z = number_or_zero
    points = [
        ("validity", "valid", z(F.col("totals.valid"))),
        ("validity", "quarantined", z(F.col("totals.quarantine"))),
        ("performance", "events/sec", z(F.col("producer.throughput_events_per_sec"))),
        ("performance", "avg ms", z(F.col("latency_ms.avg_ms"))),
        ("performance", "p50 ms", z(F.col("latency_ms.p50_ms"))),
        ("performance", "p95 ms", z(F.col("latency_ms.p95_ms"))),
    ]
    rows = [
        F.struct(F.lit(s).alias("series"), F.lit(n).alias("name"), v.alias("value"))
        for s, n, v in points
    ]
    return summary.select(F.inline(F.array(*rows)))


def count_series(summary: DataFrame, column: str) -> DataFrame:
    """Rows (name, value) of one count map of a run summary."""
    return summary.select(F.explode(column).alias("name", "value")).select(
        "name", number_or_zero(F.col("value")).alias("value")
    )
