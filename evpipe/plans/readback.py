"""Documents written as JSON or Markdown text, read back and compared field by field."""

from __future__ import annotations

from pyspark.sql import functions as F

from evpipe.functions import json as J
from evpipe.operators.alerts import alert_details
from evpipe.plans import catalog
from evpipe.plans.catalog import query
from evpipe.plans.oracle import over
from evpipe.schema import ALERT_RULE_TEXT, EXPERIMENT_COLUMNS, SUMMARY_SCHEMA
from evpipe.sources.fixtures import raw_events


@query(
    over(
        "event_view",
        """SELECT arrival_seq, event_id, event_type, source, 'ehr.v1' AS schema_version,
        7 + CAST(patient_id IS NOT NULL AS INT) + CAST(has_phi AS INT) AS n_keys, true AS sorted
        FROM event_view""",
    )
)
def canonical_json_fields(spark, sf):
    text = raw_events(spark, sf).select("arrival_seq", J.canonical_json(F.col("raw")).alias("c"))
    names = F.json_object_keys("c")
    fields = "event_id string, event_type string, source string, schema_version string"
    return text.select(
        "arrival_seq", F.from_json("c", fields).alias("r"), F.size(names).alias("n_keys"),
        (F.array_sort(names) == names).alias("sorted"),
    ).select("arrival_seq", "r.*", "n_keys", "sorted")


@query(
    over(
        "routed_stream",
        """SELECT arrival_seq, accepted AS valid, event_id AS "eventId",
        coalesce(patient_id, '') AS "patientId", event_type AS "eventType", source,
        array_to_string(errors, ',') AS errors, coalesce(event_time_ms, -1) AS "eventEpochMillis",
        processed_ms AS "processedAtMillis",
        CAST(processed_ms - emit_ms AS DOUBLE) AS "ingestionLatencyMs" FROM routed_stream""",
    )
)
def record_json_fields(spark, sf):
    fields = (
        "valid boolean, eventId string, patientId string, eventType string, source string, "
        "errors array<string>, eventEpochMillis bigint, processedAtMillis bigint, "
        "ingestionLatencyMs double"
    )
    read = catalog.record_json(spark, sf).select("arrival_seq", F.from_json("record", fields).alias("r"))
    found = read.select("arrival_seq", "r.*")
    return found.withColumn("errors", F.array_join("errors", ","))


@query(
    over(
        "alerts_stream",
        f"""SELECT patient_id, event_time_ms AS alert_time_ms, heart_rate, temperature_c, wbc, lactate,
        '{ALERT_RULE_TEXT.replace("'", "''")}' AS rule FROM alerts_stream""",
    )
)
def alert_details_fields(spark, sf):
    fields = "heart_rate double, temperature_c double, wbc double, lactate double, rule string"
    alerts = catalog._alerts(spark, sf).select("patient_id", "alert_time_ms", alert_details().alias("d"))
    return alerts.select("patient_id", "alert_time_ms", F.from_json("d", fields).alias("r")).select(
        "patient_id", "alert_time_ms", "r.*"
    )


@query(
    over(
        "routed_stream",
        """SELECT count(*) FILTER (accepted) AS valid, count(*) FILTER (NOT accepted) AS quarantine,
        (SELECT count(*) FROM alerts_stream) AS alerts, count(*) AS processed,
        max(CAST(processed_ms - emit_ms AS DOUBLE)) FILTER (accepted) AS max_ms,
        count(*) FILTER (accepted AND event_type = 'lab') AS labs FROM routed_stream""",
        "alerts_stream",
    )
)
def build_summary_fields(spark, sf):
    """The summary as the JSON document that is stored."""
    summary = catalog._summary(spark, sf)
    text = summary.select(F.to_json(F.struct(*summary.columns)).alias("s"))
    read = text.select(F.from_json("s", SUMMARY_SCHEMA).alias("s"))
    return read.select(
        "s.totals.valid", "s.totals.quarantine", "s.totals.alerts", "s.totals.processed",
        F.col("s.latency_ms.max_ms").alias("max_ms"), F.col("s.event_counts")["lab"].alias("labs"),
    )


@query(
    over(
        "routed_local",
        """SELECT count(*) AS total, count(*) FILTER (accepted) AS accepted,
        (SELECT count(*) FROM alerts_local) AS alert_count,
        count(*) FILTER (reason = 'late_event') AS late,
        count(*) FILTER (accepted AND event_type = 'vital') AS vitals,
        least(5, count(*) FILTER (NOT accepted)) AS samples FROM routed_local""",
        "alerts_local",
    )
)
def local_summary_fields(spark, sf):
    """The local run's summary as the JSON document that is stored."""
    summary = catalog.local_summary(spark, sf)
    text = summary.select(F.to_json(F.struct(*summary.columns)).alias("s"))
    fields = (
        "event_types map<string,bigint>, reasons map<string,bigint>, alert_count bigint, "
        "samples array<struct<reason:string,preview:string>>, "
        "metrics struct<total:bigint,accepted:bigint>"
    )
    read = text.select(F.from_json("s", fields).alias("s"))
    return read.select(
        "s.metrics.total", "s.metrics.accepted", "s.alert_count",
        F.col("s.reasons")["late_event"].alias("late"),
        F.col("s.event_types")["vital"].alias("vitals"), F.size("s.samples").alias("samples"),
    )


@query(
    over(
        "days",
        """SELECT run, CAST(sent AS BIGINT) AS events_sent, CAST(valid AS BIGINT) AS valid,
        CAST(quarantine AS BIGINT) AS quarantine FROM days""",
    )
)
def experiments_markdown_fields(spark, sf):
    """The cells of the table's lines, without its two header lines."""
    lines = catalog.experiments_markdown(spark, sf)
    cells = F.transform(F.split(F.col(lines.columns[-1]), r"\|"), lambda x: F.trim(x))
    at = {name: EXPERIMENT_COLUMNS.index(name) + 1 for name in ("run", "events_sent", "valid", "quarantine")}
    rows = lines.select(cells.alias("c")).filter(F.get("c", F.lit(at["run"])).startswith("day-"))
    return rows.select(
        F.get("c", F.lit(at["run"])).alias("run"),
        *[F.get("c", F.lit(at[n])).cast("bigint").alias(n) for n in ("events_sent", "valid", "quarantine")],
    )
