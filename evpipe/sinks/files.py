"""Topic, JSON, CSV and Markdown outputs of a run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evpipe.functions.json import canonical_json, quoted
from evpipe.operators.experiments import experiments_markdown
from evpipe.schema import EXPERIMENT_COLUMNS


def record_json(records: DataFrame):
    """A routed record as JSON with the field names of the quarantine topic."""
    zero = F.lit(0).cast("bigint")
    return F.to_json(
        F.struct(
            F.col("accepted").alias("valid"),
            F.col("record_key").alias("eventId"),
            F.coalesce("patient_id", F.lit("")).alias("patientId"),
            F.coalesce("event_type", F.lit("")).alias("eventType"),
            F.coalesce("event_time", F.lit("")).alias("eventTime"),
            F.coalesce("source", F.lit("")).alias("source"),
            F.coalesce("payload_json", F.lit("{}")).alias("payloadJson"),
            F.col("patient_metadata").alias("patientMetadataJson"),
            F.col("raw").alias("rawJson"),
            F.col("errors"),
            F.coalesce("event_ms", F.lit(-1).cast("bigint")).alias("eventEpochMillis"),
            F.coalesce("emit_ms", zero - 1).alias("sourceEmitEpochMillis"),
            F.col("processed_ms").alias("processedAtMillis"),
            F.col("ingestion_latency_ms").alias("ingestionLatencyMs"),
        )
    )


def alert_json(details):
    """An alert as JSON with the field names of the alert topic."""
    return F.to_json(
        F.struct(
            F.col("patient_id").alias("patientId"),
            F.col("alert_type").alias("alertType"),
            F.col("alert_time_ms").alias("alertTimeMillis"),
            F.col("event_id").alias("eventId"),
            details.alias("detailsJson"),
        )
    )


def write_topic(values: DataFrame, target: dict[str, str], batch_id: int | None = None) -> None:
    """Write a one-column `value` table to a topic.

    `{"format": "kafka", ...}` uses the options as they are and delivers at least once;
    `{"format": "text", "path": ...}` keeps one folder per batch, which a replay replaces.
    """
    options = dict(target)
    fmt = options.pop("format")
    if fmt == "kafka":
        values.write.format("kafka").options(**options).save()
        return
    path = options.pop("path")
    if batch_id is not None:
        path = f"{path}/batch_id={batch_id}"
    values.write.mode("overwrite").format(fmt).options(**options).save(path)


def write_valid(accepted: DataFrame, target: dict[str, str], batch_id: int | None = None) -> None:
    write_topic(accepted.select(F.col("raw").alias("value")), target, batch_id)


def write_quarantine(
    quarantined: DataFrame, target: dict[str, str], batch_id: int | None = None
) -> None:
    write_topic(quarantined.select(record_json(quarantined).alias("value")), target, batch_id)


def write_alerts(
    alerts: DataFrame, details, target: dict[str, str], batch_id: int | None = None
) -> None:
    write_topic(alerts.select(alert_json(details).alias("value")), target, batch_id)


def _mode(reset: bool) -> str:
    return "overwrite" if reset else "append"


def append_quarantine(quarantined: DataFrame, root: str, reset: bool = False) -> None:
    """Reason and record, as a table and as JSON lines with sorted keys."""
    _write_quarantine(quarantined, f"{root}/quarantine", f"{root}/quarantine_jsonl", _mode(reset))


def replace_quarantine(quarantined: DataFrame, table: str, lines: str) -> None:
    """The same as one part of a table and one of the lines, which are replaced."""
    _write_quarantine(quarantined, table, lines, "overwrite")


def replace_events(events: DataFrame, path: str) -> None:
    events.write.mode("overwrite").parquet(path)


def _write_quarantine(quarantined: DataFrame, table: str, lines: str, mode: str) -> None:
    # A text that is no JSON is kept as a JSON string.
    event = F.coalesce(canonical_json(F.col("raw")), quoted(F.col("raw")))
    rows = quarantined.select("reason", event.alias("event_json"), "arrival_seq")
    rows.write.mode(mode).parquet(table)
    line = F.concat(
        F.lit('{"event": '),
        F.col("event_json"),
        F.lit(', "reason": '),
        quoted(F.col("reason")),
        F.lit("}"),
    )
    rows.select(line.alias("value")).write.mode(mode).text(lines)


def append_alerts(alerts: DataFrame, root: str, reset: bool = False) -> None:
    alerts.write.mode(_mode(reset)).parquet(f"{root}/alerts")


def append_events(events: DataFrame, root: str, reset: bool = False) -> None:
    events.write.mode(_mode(reset)).parquet(f"{root}/events")


def stored_ids(spark: SparkSession, root: str) -> DataFrame | None:
    """The ids that earlier runs accepted, None when there are none."""
    try:
        events = spark.read.schema("event_id string").parquet(f"{root}/events")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return events.select(F.coalesce("event_id", F.lit("None")).alias("event_id")).distinct()


def save_run_metrics(metrics: DataFrame, root: str, buckets: DataFrame | None = None) -> None:
    """Replace the single stored metrics row, and the table of throughput buckets."""
    metrics.write.mode("overwrite").json(f"{root}/run_metrics")
    if buckets is not None:
        buckets.write.mode("overwrite").json(f"{root}/run_metrics_buckets")


def write_summary(summary: DataFrame, path: str) -> None:
    summary.write.mode("overwrite").json(path)


def write_experiments(experiments: DataFrame, root: str) -> None:
    """CSV and JSON of the run comparison, one row per run."""
    ordered = experiments.orderBy("run")
    ordered.write.mode("overwrite").option("header", True).csv(f"{root}/experiments_csv")
    ordered.write.mode("overwrite").json(f"{root}/experiments_json")


def write_experiments_markdown(
    experiments: DataFrame, root: str, columns: Sequence[str] = EXPERIMENT_COLUMNS
) -> None:
    # A few hundred bytes per run; one file keeps the lines in order.
    lines = experiments_markdown(experiments, columns)
    lines.coalesce(1).write.mode("overwrite").text(f"{root}/experiments_md")
