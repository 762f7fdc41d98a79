"""Every operator as a query over the given tables, with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evpipe.functions import json as J
from evpipe.functions import numeric as num
from evpipe.functions import text as txt
from evpipe.functions import time as tm
from evpipe.operators import experiments as exp
from evpipe.operators import metrics as met
from evpipe.operators import percentiles as pct
from evpipe.operators import reads
from evpipe.operators.alerts import (
    alert_details,
    alerts_with_cooldown,
    patient_signal_state,
    rule_hits,
)
from evpipe.operators.enrich import enrich, patient_metadata
from evpipe.operators.eventtime import flag_out_of_order, is_late, running_max_event_time
from evpipe.operators.parse import base_record, parse_events
from evpipe.operators.route import mark_duplicates, route
from evpipe.operators.skew import HOT_PATIENT_ROWS, find_hot_patients, mark_hot
from evpipe.operators.validate import (
    first_reason,
    has_phi_keys,
    has_phi_text,
    in_list,
    in_range,
    is_valid,
    joined_reason,
    missing_fields,
    quarantined_events,
    top_level_keys,
    valid_events,
    validate,
)
from evpipe.plans.batch import TEXT_COLUMNS, checked_events
from evpipe.plans.oracle import (
    COOLDOWN_MS,
    LATENESS_MS,
    SUMMARY_REASONS_SQL,
    over,
)
from evpipe.plans.staging import new_path, stage
from evpipe.schema import (
    ALL_SIGNALS,
    EVENT_TYPES,
    EXPERIMENT_SCHEMA,
    LOCAL_VITAL_RANGES,
    PRODUCER_SCHEMA,
    RULE_SIGNALS,
    SUMMARY_REASONS,
    SUMMARY_SCHEMA,
)
from evpipe.session import tune
from evpipe.sinks import files, tables
from evpipe.sources.fixtures import patients, raw_events
from evpipe.sources.readers import read_patient_dim, read_raw_batch, spread
from evpipe.sources.readers import read_run_summaries as read_summaries

Query = Callable[[SparkSession, str], DataFrame]
LATENESS_SEC = LATENESS_MS // 1000

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a query under its function name, with its check where SQL can express it."""

    def add(fn: Query) -> Query:
        key = name or fn.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir)

        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return add


# --- shared inputs ---------------------------------------------------------------------------


def _parsed(spark, sf, profile="stream"):
    return parse_events(spread(raw_events(spark, sf)), profile)


def _checked(spark, sf, profile="stream", extra=()):
    return checked_events(raw_events(spark, sf), profile, extra)


def _routed(spark, sf, profile="stream", extra=()):
    return route(_checked(spark, sf, profile, extra), profile, LATENESS_SEC)


def _accepted(spark, sf, profile="stream", extra=()):
    return _routed(spark, sf, profile, extra).filter("accepted")


def _rejected(spark, sf, profile="stream", extra=()):
    return _routed(spark, sf, profile, extra).filter("not accepted")


def _alerts(spark, sf, profile="stream"):
    checked = _checked(spark, sf, profile)
    hot = find_hot_patients(checked)
    accepted = route(checked, profile, LATENESS_SEC).filter("accepted")
    return alerts_with_cooldown(accepted, COOLDOWN_MS, hot)


def _with_hot(spark, sf, profile="stream", min_rows=HOT_PATIENT_ROWS):
    """Accepted events, and the column that marks hot patients (None when there are none)."""
    checked = _checked(spark, sf, profile)
    hot = find_hot_patients(checked, min_rows)
    accepted = route(checked, profile, LATENESS_SEC).filter("accepted")
    return (accepted, None) if hot is None else (mark_hot(accepted, hot, "_hot"), "_hot")


def _with_latency(df):
    latency = tm.ingest_latency(F.col("processed_ms"), F.col("emit_ms"))
    return df.withColumn("ingestion_latency_ms", latency)


def _latencies(spark, sf):
    """Staged, because order statistics read the column more than once."""
    latencies = _with_latency(_accepted(spark, sf)).select("ingestion_latency_ms")
    return stage(latencies, "latencies")


def _doc(spark, sf):
    return raw_events(spark, sf).withColumn("doc", F.try_parse_json("raw"))


# --- sources ---------------------------------------------------------------------------------


@query(over("raw_events", "SELECT arrival_seq, raw, processed_ms FROM raw_events"))
def read_raw_batch_parquet(spark, sf):
    path = new_path(spark, "raw")
    raw_events(spark, sf).select("arrival_seq", "raw", "processed_ms").write.parquet(path)
    return read_raw_batch(spark, path, "parquet")


@query(over("raw_events", "SELECT raw FROM raw_events"))
def read_raw_batch_text(spark, sf):
    path = new_path(spark, "raw-lines")
    raw_events(spark, sf).select("raw").write.text(path)
    return read_raw_batch(spark, path).select("raw")


@query(
    over(
        "fields",
        """SELECT arrival_seq, event_id, patient_id, event_type, source, event_id AS record_key,
        coalesce(event_time_ms, -1) AS event_ms, emit_ms, label, number FROM fields""",
    ),
    name="parse_events",
)
def parse_events_query(spark, sf):
    return _parsed(spark, sf).select(
        "arrival_seq", "event_id", "patient_id", "event_type", "source", "record_key",
        "event_ms", "emit_ms", "label", "number",
    )


@query(
    over(
        "patients",
        "SELECT patient_id, age_band, home_department, risk_score, 3 AS n_fields FROM patients",
    ),
    name="read_patient_dim",
)
def read_patient_dim_query(spark, sf):
    path = new_path(spark, "patients")
    patients(spark, sf).write.parquet(path)
    meta = F.col("metadata")
    return read_patient_dim(spark, path).select(
        "patient_id",
        *[meta[n].alias(n) for n in ("age_band", "home_department", "risk_score")],
        F.size(meta).alias("n_fields"),
    )


def _stored_events(spark, sf):
    """events_by_id after two writes of the same rows, as after a replay."""
    accepted = enrich(
        _accepted(spark, sf, extra=TEXT_COLUMNS), patient_metadata(patients(spark, sf))
    )
    root = new_path(spark, "tables")
    tables.upsert_events_by_id(accepted, root, 0)
    first = tables.read_parts(spark, root, tables.EVENTS_BY_ID).drop("batch_id")
    tables.upsert(first, root, tables.EVENTS_BY_ID, 1)
    return tables.read_table(spark, root, tables.EVENTS_BY_ID)


# Parts of the tables that are written batch by batch: more than two levels hold.
WRITES = 11


def _write_in_parts(spark, sf, root):
    """events_by_id in many writes, so that levels are merged; each write repeats the one before."""
    accepted = stage(
        _accepted(spark, sf, extra=TEXT_COLUMNS).withColumn("patient_metadata", F.lit("{}")),
        "accepted",
    )
    turn = F.col("arrival_seq") % WRITES
    for i in range(WRITES):
        own = accepted.filter(turn.isin(i, i - 1))
        tables.upsert_events_by_id(own, root, i)


@query(over("stored", "SELECT event_id, patient_id, event_type, source FROM stored"))
def upsert_in_levels(spark, sf):
    root = new_path(spark, "tables")
    _write_in_parts(spark, sf, root)
    stored = tables.read_table(spark, root, tables.EVENTS_BY_ID)
    return stored.select("event_id", "patient_id", "event_type", "source")


def _stored_by_type(spark, sf):
    root = new_path(spark, "tables")
    tables.upsert_events_by_type(_accepted(spark, sf), root, 0)
    first = tables.read_parts(spark, root, tables.EVENTS_BY_TYPE).drop("batch_id")
    tables.upsert(first, root, tables.EVENTS_BY_TYPE, 1)
    return tables.read_table(spark, root, tables.EVENTS_BY_TYPE)


def _stored_quarantine(spark, sf):
    root = new_path(spark, "tables")
    tables.upsert_quarantine(_rejected(spark, sf, extra=("raw",)), root, 0)
    first = tables.read_parts(spark, root, tables.QUARANTINE_BY_REASON).drop("batch_id")
    tables.upsert(first, root, tables.QUARANTINE_BY_REASON, 1)
    return tables.read_table(spark, root, tables.QUARANTINE_BY_REASON)


def _stored_alerts(spark, sf, spec):
    root = new_path(spark, "tables")
    rows = tables.alert_rows(_alerts(spark, sf), alert_details())
    tables.upsert(rows, root, spec, 0)
    first = tables.read_parts(spark, root, spec).drop("batch_id")
    tables.upsert(first, root, spec, 1)
    return tables.read_table(spark, root, spec)


@query(over("latencies", "SELECT v AS ingestion_latency_ms FROM latencies"))
def scan_latencies(spark, sf):
    return reads.scan_latencies(_stored_events(spark, sf))


@query(over("stored", "SELECT count(*) AS n FROM stored WHERE event_type = 'lab'"))
def count_partition(spark, sf):
    return reads.count_partition(_stored_by_type(spark, sf), "event_type", "lab")


# --- keyed tables ----------------------------------------------------------------------------


@query(
    over(
        "stored",
        """SELECT event_id, patient_id, event_type, event_time_ms, source, payload,
        ingestion_latency_ms, processed_ms FROM stored""",
    )
)
def upsert_events_by_id(spark, sf):
    return _stored_events(spark, sf).select(
        "event_id", "patient_id", "event_type",
        F.unix_millis("event_time").alias("event_time_ms"),
        "source", "payload", "ingestion_latency_ms",
        F.unix_millis("processed_at").alias("processed_ms"),
    )


@query(over("stored", "SELECT event_type, event_id, patient_id, event_time_ms FROM stored"))
def upsert_events_by_type(spark, sf):
    return _stored_by_type(spark, sf).select(
        "event_type", "event_id", "patient_id", F.unix_millis("event_time").alias("event_time_ms")
    )


@query(
    over(
        "routed_stream",
        """SELECT errors[1] AS reason, processed_ms AS observed_ms, event_id,
        array_to_string(errors, ',') AS errors FROM routed_stream WHERE NOT accepted""",
    )
)
def upsert_quarantine(spark, sf):
    return _stored_quarantine(spark, sf).select(
        "reason",
        F.unix_millis("observed_at").alias("observed_ms"),
        "event_id",
        F.array_join("errors", ",").alias("errors"),
    )


_ALERT_ROWS = "SELECT patient_id, event_time_ms AS alert_ms, alert_type FROM alerts_stream"


@query(over("alerts_stream", _ALERT_ROWS))
def upsert_alerts_by_patient(spark, sf):
    return _stored_alerts(spark, sf, tables.ALERTS_BY_PATIENT).select(
        "patient_id", F.unix_millis("alert_time").alias("alert_ms"), "alert_type"
    )


@query(over("alerts_stream", _ALERT_ROWS))
def upsert_alerts_by_type(spark, sf):
    return _stored_alerts(spark, sf, tables.ALERTS_BY_TYPE).select(
        "patient_id", F.unix_millis("alert_time").alias("alert_ms"), "alert_type"
    )


@query(
    over(
        "event_view",
        """, stored_ids AS (SELECT DISTINCT event_id FROM event_view WHERE event_type = 'lab')
        SELECT v.arrival_seq, v.event_id, v.event_type <> 'lab' AND s.event_id IS NULL
          AND v.arrival_seq = min(CASE WHEN v.event_type <> 'lab' THEN v.arrival_seq END)
                              OVER (PARTITION BY v.event_id) AS inserted
        FROM event_view v LEFT JOIN stored_ids s USING (event_id) WHERE v.event_type <> 'lab'""",
    )
)
def insert_if_absent(spark, sf):
    """The lab events are stored already; all others arrive."""
    events = stage(
        _parsed(spark, sf, "local").select("arrival_seq", "event_id", "event_type"), "ids"
    )
    stored = events.filter("event_type = 'lab'")
    added, conflicts = tables.insert_if_absent(events.filter("event_type <> 'lab'"), stored)
    return added.select("arrival_seq", "event_id", F.lit(True).alias("inserted")).unionByName(
        conflicts.select("arrival_seq", "event_id", F.lit(False).alias("inserted"))
    )


# --- scalar functions ------------------------------------------------------------------------


@query(
    over(
        "event_view",
        """SELECT arrival_seq, patient_id, event_type,
        json_extract_string(payload, '$.name') AS name FROM event_view""",
    )
)
def json_text(spark, sf):
    doc = F.col("doc")
    return _doc(spark, sf).select(
        "arrival_seq",
        J.json_text(doc, "$.patient_id").alias("patient_id"),
        J.json_text(doc, "$.event_type").alias("event_type"),
        J.json_text(doc, "$.payload.name").alias("name"),
    )


@query(over("event_view", "SELECT arrival_seq, payload AS payload_json FROM event_view"))
def payload_json(spark, sf):
    return _parsed(spark, sf).select("arrival_seq", "payload_json")


@query(
    over(
        "event_view",
        """SELECT arrival_seq, coalesce(event_time_ms, -1) AS event_ms, emit_ms FROM event_view""",
    )
)
def strict_millis(spark, sf):
    doc = F.col("doc")
    return _doc(spark, sf).select(
        "arrival_seq",
        tm.strict_millis(J.json_text(doc, "$.event_time")).alias("event_ms"),
        tm.strict_millis(J.json_text(doc, "$.source_emit_time")).alias("emit_ms"),
    )


@query(over("event_view", "SELECT arrival_seq, event_time_ms AS event_ms FROM event_view"))
def lenient_timestamp(spark, sf):
    text = J.json_text(F.col("doc"), "$.event_time")
    return _doc(spark, sf).select("arrival_seq", tm.lenient_millis(text).alias("event_ms"))


@query(
    over("raw_events", "SELECT arrival_seq, substr(sha256(raw), 1, 24) AS raw_hash FROM raw_events")
)
def raw_hash(spark, sf):
    return raw_events(spark, sf).select("arrival_seq", txt.raw_hash(F.col("raw")).alias("raw_hash"))


@query(
    over(
        "raw_events",
        """SELECT arrival_seq, coalesce(patient_id, substr(sha256(raw), 1, 24)) AS record_key
        FROM raw_events JOIN event_view USING (arrival_seq)""",
    )
)
def record_key(spark, sf):
    """The key rule on a column that has gaps: the patient id."""
    key = txt.record_key(F.col("patient_id"), F.col("raw_hash"))
    return _parsed(spark, sf).select("arrival_seq", key.alias("record_key"))


@query(
    over(
        "event_view",
        """SELECT arrival_seq, TRY_CAST(json_extract_string(payload, '$.value') AS DOUBLE) AS value,
        TRY_CAST(json_extract_string(payload, '$.unit') AS DOUBLE) AS unit FROM event_view""",
    )
)
def json_double(spark, sf):
    doc = F.col("doc")
    return _doc(spark, sf).select(
        "arrival_seq",
        J.json_double(doc, "$.payload.value").alias("value"),
        J.json_double(doc, "$.payload.unit").alias("unit"),
    )


@query(
    over(
        "event_view",
        """SELECT arrival_seq,
        coalesce(CAST(trunc(TRY_CAST(json_extract_string(payload, '$.acuity') AS DOUBLE)) AS INT), -1)
          AS acuity,
        coalesce(CAST(trunc(TRY_CAST(json_extract_string(payload, '$.result') AS DOUBLE)) AS INT), -1)
          AS result FROM event_view""",
    )
)
def json_int(spark, sf):
    doc = F.col("doc")
    return _doc(spark, sf).select(
        "arrival_seq",
        J.json_int(doc, "$.payload.acuity").alias("acuity"),
        J.json_int(doc, "$.payload.result").alias("result"),
    )


@query(
    over(
        "event_view",
        """SELECT arrival_seq,
        coalesce(json_type(payload, '$.value') IN ('DOUBLE','BIGINT','UBIGINT'), false) AS value,
        coalesce(json_type(payload, '$.unit') IN ('DOUBLE','BIGINT','UBIGINT'), false) AS unit
        FROM event_view""",
    )
)
def is_json_number(spark, sf):
    doc = F.col("doc")
    return _doc(spark, sf).select(
        "arrival_seq",
        J.is_json_number(doc, "$.payload.value").alias("value"),
        J.is_json_number(doc, "$.payload.unit").alias("unit"),
    )


@query(
    over(
        "event_view",
        """SELECT arrival_seq, coalesce(trim(patient_id), '') = '' AS patient_blank,
        coalesce(trim(event_id), '') = '' AS id_blank FROM event_view""",
    )
)
def is_blank(spark, sf):
    return _parsed(spark, sf).select(
        "arrival_seq",
        txt.is_blank(F.col("patient_id")).alias("patient_blank"),
        txt.is_blank(F.col("event_id")).alias("id_blank"),
    )


@query(
    over(
        "raw_events",
        """SELECT arrival_seq, contains(raw, '"patient_name"') OR contains(raw, '"ssn"')
        OR contains(raw, '"address"') AS has_phi FROM raw_events""",
    ),
    name="has_phi_text",
)
def has_phi_text_query(spark, sf):
    return raw_events(spark, sf).select("arrival_seq", has_phi_text(F.col("raw")).alias("has_phi"))


@query(
    over(
        "raw_events",
        """SELECT arrival_seq, list_has_any(json_keys(raw),
        ['patient_name','ssn','address','phone','email']) AS has_phi FROM raw_events""",
    ),
    name="has_phi_keys",
)
def has_phi_keys_query(spark, sf):
    return raw_events(spark, sf).select(
        "arrival_seq", has_phi_keys(top_level_keys(F.col("raw"))).alias("has_phi")
    )


@query(
    over(
        "raw_events",
        """SELECT arrival_seq, CASE WHEN len(absent) > 0
          THEN 'missing_' || array_to_string(absent, '_') END AS missing
        FROM (SELECT arrival_seq, list_sort(list_filter(['event_id','patient_id','event_type',
          'event_time','source','schema_version','payload'],
          lambda k: NOT list_contains(json_keys(raw), k))) AS absent FROM raw_events)""",
    ),
    name="missing_fields",
)
def missing_fields_query(spark, sf):
    return raw_events(spark, sf).select(
        "arrival_seq", missing_fields(top_level_keys(F.col("raw"))).alias("missing")
    )


@query(
    over(
        "event_view",
        """SELECT arrival_seq, coalesce(starts_with(patient_id, 'P'), false) AS patient_ok,
        starts_with(event_type, 'P') AS type_ok FROM event_view""",
    )
)
def valid_patient_id(spark, sf):
    return _parsed(spark, sf, "local").select(
        "arrival_seq",
        txt.valid_patient_id(F.col("patient_id")).alias("patient_ok"),
        txt.valid_patient_id(F.col("event_type")).alias("type_ok"),
    )


@query(
    over(
        "event_view",
        """SELECT arrival_seq,
        regexp_full_match(event_id, '[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}') AS id_ok,
        regexp_full_match(coalesce(patient_id, ''), '[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}')
          AS patient_ok FROM event_view""",
    )
)
def is_uuid(spark, sf):
    return _parsed(spark, sf).select(
        "arrival_seq",
        txt.is_uuid(F.col("event_id")).alias("id_ok"),
        txt.is_uuid(F.col("patient_id")).alias("patient_ok"),
    )


@query(
    over(
        "fields",
        """SELECT arrival_seq, event_type IN ('vital','lab','medication','admission') AS known_type,
        coalesce(label IN ('heart_rate','temperature_c'), false) AS known_label FROM fields""",
    ),
    name="in_list",
)
def in_list_query(spark, sf):
    return _parsed(spark, sf).select(
        "arrival_seq",
        in_list(F.col("event_type"), EVENT_TYPES).alias("known_type"),
        in_list(F.col("label"), ("heart_rate", "temperature_c")).alias("known_label"),
    )


@query(
    over(
        "fields",
        """SELECT arrival_seq, coalesce(CASE label WHEN 'heart_rate' THEN number BETWEEN 20 AND 250
          WHEN 'systolic_bp' THEN number BETWEEN 40 AND 260
          WHEN 'diastolic_bp' THEN number BETWEEN 20 AND 160
          WHEN 'temperature_c' THEN number BETWEEN 25 AND 45
          WHEN 'spo2' THEN number BETWEEN 50 AND 100 ELSE true END, false) AS in_range
        FROM fields""",
    ),
    name="in_range",
)
def in_range_query(spark, sf):
    ok = in_range(F.col("label"), F.col("number"), LOCAL_VITAL_RANGES)
    return _parsed(spark, sf).select("arrival_seq", ok.alias("in_range"))


@query(
    over(
        "checked_stream",
        "SELECT arrival_seq, coalesce(errors[1], 'unknown') AS reason FROM checked_stream",
    ),
    name="first_reason",
)
def first_reason_query(spark, sf):
    return validate(_parsed(spark, sf)).select(
        "arrival_seq", first_reason(F.col("errors")).alias("reason")
    )


@query(
    over(
        "checked_local",
        "SELECT arrival_seq, array_to_string(errors, '|') AS reason FROM checked_local",
    ),
    name="joined_reason",
)
def joined_reason_query(spark, sf):
    return validate(_parsed(spark, sf, "local"), "local").select(
        "arrival_seq", joined_reason(F.col("errors")).alias("reason")
    )


@query(
    over(
        "event_view",
        """SELECT arrival_seq, CASE WHEN emit_ms > 0 THEN CAST(processed_ms - emit_ms AS DOUBLE)
        ELSE 0.0 END AS latency_ms FROM event_view""",
    )
)
def ingest_latency(spark, sf):
    latency = tm.ingest_latency(F.col("processed_ms"), F.col("emit_ms"))
    return _parsed(spark, sf).select("arrival_seq", latency.alias("latency_ms"))


@query(
    over(
        "event_view",
        """SELECT arrival_seq, CASE WHEN event_time_ms > 0 THEN event_time_ms ELSE processed_ms END
        AS ts_ms FROM event_view""",
    )
)
def ts_or_ingest(spark, sf):
    ts = tm.ts_or_ingest(F.col("event_ms"), F.col("processed_ms"))
    return _parsed(spark, sf).select("arrival_seq", ts.alias("ts_ms"))


@query(over("fields", "SELECT arrival_seq, coalesce(number, 0.0) AS value FROM fields"))
def value_or_zero(spark, sf):
    return _parsed(spark, sf).select("arrival_seq", num.value_or_zero(F.col("number")).alias("value"))


@query(
    over("raw_events", "SELECT arrival_seq, substr(raw, 1, 220) AS preview FROM raw_events")
)
def preview(spark, sf):
    return raw_events(spark, sf).select("arrival_seq", txt.preview(F.col("raw")).alias("preview"))


@query(
    over(
        "event_view",
        """SELECT arrival_seq, strftime(make_timestamp(emit_ms * 1000), '%Y-%m-%dT%H:%M:%S.%gZ')
        AS emitted FROM event_view""",
    )
)
def iso_z(spark, sf):
    return _parsed(spark, sf).select("arrival_seq", tm.iso_z(F.col("emit_ms")).alias("emitted"))


@query(
    over(
        "fields",
        """SELECT arrival_seq, coalesce(TRY_CAST(label AS DOUBLE), 0.0) AS label_number,
        coalesce(number, 0.0) AS number FROM fields""",
    )
)
def number_or_zero(spark, sf):
    return _parsed(spark, sf).select(
        "arrival_seq",
        num.number_or_zero(F.col("label")).alias("label_number"),
        num.number_or_zero(F.col("number")).alias("number"),
    )


@query(
    over(
        "checked_stream",
        """SELECT event_type, round(sum(CASE WHEN len(errors) = 0 THEN 1 ELSE 0 END)
        / CAST(count(*) AS DOUBLE) * 100, 1) AS valid_percent FROM checked_stream
        GROUP BY event_type""",
    )
)
def percent(spark, sf):
    checked = validate(_parsed(spark, sf))
    counts = checked.groupBy("event_type").agg(
        F.count_if(is_valid()).alias("ok"), F.count(F.lit(1)).alias("n")
    )
    return counts.select("event_type", num.percent(F.col("ok") / F.col("n")).alias("valid_percent"))


@query(
    over(
        "routed_stream",
        """SELECT reason AS name, n AS value, greatest(3.0, n / max(n) OVER () * 100)
        AS percent_of_max FROM (SELECT reason, count(*) AS n FROM routed_stream
        WHERE NOT accepted GROUP BY reason)""",
    )
)
def ranked_reasons(spark, sf):
    return met.ranked_reasons(_rejected(spark, sf))


@query(
    over(
        "event_view",
        """SELECT arrival_seq, event_id, coalesce(patient_id, '') AS patient_id, event_type, source,
        CASE WHEN event_time_ms IS NULL THEN 'not-a-timestamp' ELSE
          strftime(make_timestamp(event_time_ms * 1000), '%Y-%m-%dT%H:%M:%S.%gZ') END AS event_time,
        payload AS payload_json FROM event_view""",
    ),
    name="base_record",
)
def base_record_query(spark, sf):
    return base_record(_parsed(spark, sf)).select(
        "arrival_seq", "event_id", "patient_id", "event_type", "source", "event_time", "payload_json"
    )


@query()
def canonical_json(spark, sf):
    return raw_events(spark, sf).select(
        "arrival_seq", J.canonical_json(F.col("raw")).alias("canonical")
    )


@query()
def record_json(spark, sf):
    routed = enrich(
        _with_latency(_routed(spark, sf, extra=TEXT_COLUMNS)),
        patient_metadata(patients(spark, sf)),
        F.col("accepted"),
    )
    return routed.select("arrival_seq", files.record_json(routed).alias("record"))


# --- rules and routing -----------------------------------------------------------------------

_ERRORS = "SELECT arrival_seq, event_type, array_to_string(errors, '|') AS errors FROM {}"


@query(over("checked_stream", _ERRORS.format("checked_stream")))
def validate_stream(spark, sf):
    return validate(_parsed(spark, sf)).select(
        "arrival_seq", "event_type", F.array_join("errors", "|").alias("errors")
    )


@query(over("checked_local", _ERRORS.format("checked_local")))
def validate_local(spark, sf):
    return validate(_parsed(spark, sf, "local"), "local").select(
        "arrival_seq", "event_type", F.array_join("errors", "|").alias("errors")
    )


def _errors_by_code(event_type: str, profile: str):
    view = f"checked_{profile}"
    sql = f"""SELECT code, count(*) AS n FROM (SELECT unnest(errors) AS code FROM {view}
              WHERE event_type = '{event_type}') GROUP BY code"""

    def run(spark, sf):
        checked = validate(_parsed(spark, sf, profile), profile)
        of_type = checked.filter(F.col("event_type") == event_type)
        return of_type.select(F.explode("errors").alias("code")).groupBy("code").agg(
            F.count(F.lit(1)).alias("n")
        )

    query(over(view, sql), f"validate_{profile}_{event_type}")(run)


for _profile in ("stream", "local"):
    for _type in EVENT_TYPES:
        _errors_by_code(_type, _profile)


@query(
    over("checked_stream", "SELECT arrival_seq, event_id FROM checked_stream WHERE len(errors) = 0"),
    name="valid_events",
)
def valid_events_query(spark, sf):
    return valid_events(validate(_parsed(spark, sf))).select("arrival_seq", "event_id")


@query(
    over("checked_stream", "SELECT arrival_seq, event_id FROM checked_stream WHERE len(errors) > 0"),
    name="quarantined_events",
)
def quarantined_events_query(spark, sf):
    return quarantined_events(validate(_parsed(spark, sf))).select("arrival_seq", "event_id")


for _profile in ("stream", "local"):

    def _running_max(spark, sf, profile=_profile):
        checked = _checked(spark, sf, profile)
        return running_max_event_time(checked, profile).select("arrival_seq", "max_event_ms")

    query(
        over(f"timed_{_profile}", f"SELECT arrival_seq, max_event_ms FROM timed_{_profile}"),
        f"running_max_event_time_{_profile}",
    )(_running_max)

    def _late(spark, sf, profile=_profile):
        timed = running_max_event_time(_checked(spark, sf, profile), profile)
        return timed.select("arrival_seq", is_late(profile, LATENESS_SEC).alias("late"))

    query(
        over(f"flagged_{_profile}", f"SELECT arrival_seq, late FROM flagged_{_profile}"),
        f"is_late_{_profile}",
    )(_late)

    def _route(spark, sf, profile=_profile):
        return _routed(spark, sf, profile).select("arrival_seq", "event_id", "accepted", "reason")

    query(
        over(
            f"routed_{_profile}",
            f"SELECT arrival_seq, event_id, accepted, reason FROM routed_{_profile}",
        ),
        f"route_{_profile}",
    )(_route)

    def _state(spark, sf, profile=_profile):
        names = RULE_SIGNALS if profile == "stream" else ALL_SIGNALS
        accepted, hot = _with_hot(spark, sf, profile)
        return patient_signal_state(accepted, names, hot).select("arrival_seq", "patient_id", *names)

    _names = RULE_SIGNALS if _profile == "stream" else ALL_SIGNALS
    query(
        over(
            f"state_{_profile}",
            f"SELECT arrival_seq, patient_id, {', '.join(_names)} FROM state_{_profile}",
        ),
        f"patient_signal_state_{_profile}",
    )(_state)

    def _hits(spark, sf, profile=_profile):
        hits = rule_hits(*_with_hot(spark, sf, profile))
        return hits.select("arrival_seq", "patient_id", *RULE_SIGNALS)

    query(
        over(
            f"hits_{_profile}",
            f"SELECT arrival_seq, patient_id, {', '.join(RULE_SIGNALS)} FROM hits_{_profile}",
        ),
        f"rule_hits_{_profile}",
    )(_hits)

    def _raised(spark, sf, profile=_profile):
        return _alerts(spark, sf, profile).select(
            "patient_id", "alert_type", "alert_time_ms", "event_id", *RULE_SIGNALS
        )

    query(
        over(
            f"alerts_{_profile}",
            f"""SELECT patient_id, alert_type, event_time_ms AS alert_time_ms, event_id,
            {', '.join(RULE_SIGNALS)} FROM alerts_{_profile}""",
        ),
        f"alerts_with_cooldown_{_profile}",
    )(_raised)


@query(over("flagged_local", "SELECT arrival_seq, out_of_order FROM flagged_local"))
def flag_out_of_order_local(spark, sf):
    timed = running_max_event_time(_checked(spark, sf, "local"), "local")
    return timed.select("arrival_seq", flag_out_of_order().alias("out_of_order"))


@query(
    over(
        "checked_stream",
        """SELECT arrival_seq, coalesce(arrival_seq > min(CASE WHEN len(errors) = 0
        THEN arrival_seq END) OVER (PARTITION BY event_id), false) AS duplicate
        FROM checked_stream""",
    ),
    name="mark_duplicates",
)
def mark_duplicates_query(spark, sf):
    checked = _checked(spark, sf).withColumn("ok", is_valid())
    return mark_duplicates(checked).select("arrival_seq", "duplicate")


@query()
def alert_details_json(spark, sf):
    return _alerts(spark, sf).select("patient_id", "alert_time_ms", alert_details().alias("details"))


@query(
    over(
        "routed_stream",
        """SELECT r.arrival_seq, r.accepted, coalesce(p.age_band, '') AS age_band,
        coalesce(p.home_department, '') AS home_department, p.patient_id IS NOT NULL AS found
        FROM routed_stream r LEFT JOIN patients p ON r.accepted AND p.patient_id = r.patient_id""",
        "patients",
    ),
    name="enrich",
)
def enrich_query(spark, sf):
    found = enrich(
        _routed(spark, sf), patient_metadata(patients(spark, sf)), F.col("accepted")
    )
    meta = F.col("patient_metadata")
    return found.select(
        "arrival_seq",
        "accepted",
        F.coalesce(F.get_json_object(meta, "$.age_band"), F.lit("")).alias("age_band"),
        F.coalesce(F.get_json_object(meta, "$.home_department"), F.lit("")).alias(
            "home_department"
        ),
        (meta != "{}").alias("found"),
    )


@query(
    over(
        "routed_stream",
        """SELECT arrival_seq, CASE WHEN accepted THEN '{"redis_lookup":"failed"}' ELSE '{}' END
        AS patient_metadata FROM routed_stream""",
    )
)
def enrich_lookup_failed(spark, sf):
    return enrich(_routed(spark, sf), None, F.col("accepted")).select(
        "arrival_seq", "patient_metadata"
    )


# --- aggregates ------------------------------------------------------------------------------


@query(over("stored", "SELECT event_type, count(*) AS n FROM stored GROUP BY event_type"))
def count_by_type(spark, sf):
    return met.count_by_type(_accepted(spark, sf)).orderBy("event_type")


@query(
    over(
        "routed_stream",
        "SELECT reason, count(*) AS n FROM routed_stream WHERE NOT accepted GROUP BY reason",
    )
)
def count_by_reason(spark, sf):
    return met.count_by_reason(_rejected(spark, sf)).orderBy("reason")


@query(
    over(
        "routed_local",
        "SELECT reason, count(*) AS n FROM routed_local WHERE NOT accepted GROUP BY reason",
    )
)
def count_by_reason_local(spark, sf):
    return met.count_by_reason(_rejected(spark, sf, "local")).orderBy("reason")


@query(
    over(
        "routed_stream",
        f"""SELECT k.reason, count(r.arrival_seq) AS n
        FROM (SELECT unnest([{SUMMARY_REASONS_SQL}]) AS reason) k
        LEFT JOIN (SELECT * FROM routed_stream WHERE NOT accepted) r ON r.reason = k.reason
        GROUP BY k.reason""",
    )
)
def count_for_keys(spark, sf):
    return met.count_for_keys(_rejected(spark, sf), "reason", SUMMARY_REASONS)


@query(over("alerts_stream", "SELECT alert_type, count(*) AS n FROM alerts_stream GROUP BY 1"))
def alert_count(spark, sf):
    return met.alert_count(_alerts(spark, sf))


@query(over("stored", "SELECT count(*) AS n FROM stored"))
def event_count(spark, sf):
    return met.event_count(_accepted(spark, sf))


@query(
    over(
        "routed_stream",
        """SELECT valid, quarantine, alerts, valid + quarantine AS processed,
        round(valid / CAST(greatest(valid + quarantine, 1) AS DOUBLE) * 100, 2) AS accepted_percent
        FROM (SELECT count(*) FILTER (accepted) AS valid, count(*) FILTER (NOT accepted)
              AS quarantine FROM routed_stream),
             (SELECT count(*) AS alerts FROM alerts_stream)""",
        "alerts_stream",
    )
)
def run_totals(spark, sf):
    routed = stage(_routed(spark, sf), "routed")
    hot = find_hot_patients(routed)
    alerts = alerts_with_cooldown(routed.filter("accepted"), COOLDOWN_MS, hot)
    return met.run_totals(routed, alerts)


@query(
    over(
        "routed_local",
        """SELECT count(*) AS total, count(*) FILTER (accepted) AS accepted,
        count(*) FILTER (NOT accepted) AS quarantined,
        count(*) FILTER (reason = 'duplicate_event_id') AS duplicates,
        count(*) FILTER (reason = 'late_event') AS late,
        count(*) FILTER (accepted AND out_of_order) AS out_of_order FROM routed_local""",
    )
)
def outcome_counters(spark, sf):
    return met.outcome_counters(_routed(spark, sf, "local"))


@query(
    over(
        "routed_local",
        """SELECT reason, count(*) AS n FROM routed_local WHERE NOT accepted GROUP BY reason""",
    )
)
def reason_map(spark, sf):
    mapped = met.reason_map(_rejected(spark, sf, "local"))
    return mapped.select(F.explode("reasons").alias("reason", "n"))


@query(
    over(
        "latencies",
        """SELECT coalesce(avg(v), 0) AS avg_ms, coalesce(median(v), 0) AS p50_ms,
        coalesce((SELECT v FROM (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i,
          count(*) OVER () AS n FROM latencies) WHERE i = least(n - 1, floor(n * 0.95))), 0) AS p95_ms,
        coalesce(max(v), 0) AS max_ms FROM latencies""",
    )
)
def latency_summary(spark, sf):
    return pct.latency_summary(_latencies(spark, sf))


@query(
    over(
        "latencies",
        """SELECT v AS p95_ms FROM (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i,
        count(*) OVER () AS n FROM latencies) WHERE i = least(n - 1, floor(n * 0.95))""",
    )
)
def percentile_floor(spark, sf):
    return pct.percentile_floor(_latencies(spark, sf), "ingestion_latency_ms", 0.95, "p95_ms")


@query(
    over(
        "latencies",
        """SELECT max(CASE WHEN i = least(n - 1, round_even(0.5 * (n - 1), 0)) THEN v END) AS p50_ms,
        max(CASE WHEN i = least(n - 1, round_even(0.95 * (n - 1), 0)) THEN v END) AS p95_ms
        FROM (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i, count(*) OVER () AS n
              FROM latencies)""",
    )
)
def percentile_nearest(spark, sf):
    return pct.percentile_nearest(
        _latencies(spark, sf), "ingestion_latency_ms", {"p50_ms": 50, "p95_ms": 95}
    )


@query(
    over(
        "event_view",
        """SELECT total, greatest(s, 1e-9) AS duration_sec, total / greatest(s, 1e-9)
        AS throughput_eps FROM (SELECT count(*) AS total,
          (max(processed_ms) - min(processed_ms)) / 1000.0::DOUBLE AS s FROM event_view)""",
    )
)
def run_throughput(spark, sf):
    return met.run_throughput(raw_events(spark, sf))


@query(
    over(
        "event_view",
        """SELECT bucket, n, seconds, n / seconds AS events_per_sec FROM (
          SELECT bucket, n, greatest((greatest(e, b) - b) / 1000.0::DOUBLE, 1e-9) AS seconds FROM (
            SELECT *, coalesce(max(e) OVER (ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING
              AND 1 PRECEDING), (SELECT min(processed_ms) FROM event_view)) AS b FROM (
              SELECT arrival_seq // 1000 AS bucket, count(*) AS n, max(processed_ms) AS e
              FROM event_view GROUP BY 1)))""",
    )
)
def throughput_buckets(spark, sf):
    return met.throughput_buckets(raw_events(spark, sf))


@query(
    over(
        "event_view",
        "SELECT arrival_seq // 1000 AS bucket, count(*) AS n FROM event_view GROUP BY 1",
    )
)
def text_batch_buckets(spark, sf):
    """Buckets of the lines of several text files, whose numbers have gaps, read back as a table."""
    root = new_path(spark, "lines")
    raw_events(spark, sf).select("raw").repartition(3).write.text(f"{root}/in")
    events = route(checked_events(read_raw_batch(spark, f"{root}/in"), "local"), "local", LATENESS_SEC)
    metrics = met.run_metrics(_with_latency(events), events.filter("false"))
    files.save_run_metrics(metrics, root, met.throughput_buckets(events))
    stored = spark.read.schema("bucket bigint, n bigint, events_per_sec double")
    return stored.json(f"{root}/run_metrics_buckets").select("bucket", "n")


# --- runs and summaries ----------------------------------------------------------------------


def _day_summaries(spark, sf):
    """One run summary per day of the events, in the shape of the summary document."""
    day = F.concat(F.lit("day-"), F.expr("emit_ms div 86400000").cast("string"))
    events = stage(_with_latency(_routed(spark, sf)).withColumn("run", day), "days")
    counts = lambda rows, key: F.map_from_entries(
        F.array_sort(F.collect_list(F.struct(key, "n")))
    )
    accepted, rejected = events.filter("accepted"), events.filter("not accepted")
    types = accepted.groupBy("run", "event_type").agg(F.count(F.lit(1)).alias("n"))
    reasons = rejected.groupBy("run", "reason").agg(F.count(F.lit(1)).alias("n"))
    whole = events.groupBy("run").agg(
        F.count_if("accepted").alias("valid"),
        F.count_if(~F.col("accepted")).alias("quarantine"),
        F.count(F.lit(1)).alias("sent"),
        F.count_distinct("patient_id").alias("patients"),
        ((F.max("processed_ms") - F.min("processed_ms")) / 1000.0).alias("seconds"),
        F.avg(F.when(F.col("accepted"), F.col("ingestion_latency_ms"))).alias("avg_ms"),
        F.max(F.when(F.col("accepted"), F.col("ingestion_latency_ms"))).alias("max_ms"),
    )
    hot = find_hot_patients(events)
    raised = alerts_with_cooldown(accepted, COOLDOWN_MS, hot).select("arrival_seq")
    alerts = events.select("arrival_seq", "run").join(raised, "arrival_seq").groupBy("run").agg(
        F.count(F.lit(1)).alias("alerts")
    )
    latency = pct.grouped_latency(accepted, "run").select("run", "p50_ms", "p95_ms")
    whole = whole.join(alerts, "run", "left").join(latency, "run", "left")
    total = F.col("valid") + F.col("quarantine")
    null = F.lit(None)
    producer = F.struct(
        F.col("sent"),
        F.col("seconds").alias("elapsed_seconds"),
        (F.col("sent") / F.col("seconds")).alias("throughput_events_per_sec"),
        F.col("patients"),
        F.lit(0.0).alias("rate_limit_events_per_sec"),
        F.lit(LATENESS_SEC).cast("bigint").alias("allowed_lateness_sec"),
        *[null.cast(f.dataType).alias(f.name) for f in PRODUCER_SCHEMA[6:]],
    )
    return (
        whole.join(types.groupBy("run").agg(counts(types, "event_type").alias("event_counts")), "run")
        .join(
            reasons.groupBy("run").agg(counts(reasons, "reason").alias("quarantine_reasons")),
            "run",
            "left",
        )
        .select(
            "run",
            F.struct(
                "valid",
                "quarantine",
                F.coalesce("alerts", F.lit(0)).alias("alerts"),
                total.alias("processed"),
                num.accepted_percent(F.col("valid"), total).alias("accepted_percent"),
            ).alias("totals"),
            "event_counts",
            "quarantine_reasons",
            F.struct(
                *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("avg_ms", "p50_ms", "p95_ms", "max_ms")]
            ).alias("latency_ms"),
            producer.alias("producer"),
        )
    )


def _experiments(spark, sf):
    return exp.experiment_rows(_day_summaries(spark, sf))


_RUN_ROWS = """SELECT run, sent AS events_sent, patients, 0.0::DOUBLE AS rate_limit,
  round(sent / seconds::DOUBLE, 2) AS producer_events_per_sec, valid, quarantine, alerts,
  round(valid / CAST(valid + quarantine AS DOUBLE) * 100, 2) AS accepted_percent,
  round(100 - round(valid / CAST(valid + quarantine AS DOUBLE) * 100, 2), 2) AS quarantine_percent,
  round(avg_ms, 2) AS avg_latency_ms, round(p50, 2) AS p50_latency_ms,
  round(p95, 2) AS p95_latency_ms, round(max_ms, 2) AS max_latency_ms,
  coalesce(top_reason, 'none') AS top_quarantine_reason, coalesce(mix, 'none') AS event_mix
FROM days LEFT JOIN day_latency USING (run) LEFT JOIN day_alerts USING (run)
LEFT JOIN day_texts USING (run)"""


@query(over("days", _RUN_ROWS.replace("alerts,", "coalesce(alerts, 0) AS alerts,", 1),
            "day_latency", "day_alerts", "day_texts"))
def experiment_rows(spark, sf):
    return _experiments(spark, sf)


@query()
def experiments_markdown(spark, sf):
    return exp.experiments_markdown(_experiments(spark, sf))


@query(
    over(
        "days",
        """SELECT run, round(100 - round(valid / CAST(valid + quarantine AS DOUBLE) * 100, 2), 2)
        AS quarantine_percent FROM days""",
    )
)
def quarantine_percent(spark, sf):
    return _experiments(spark, sf).select("run", "quarantine_percent")


@query(
    over(
        "routed_stream",
        """SELECT run, reason || ' (' || n || ')' AS top_quarantine_reason FROM (
          SELECT *, row_number() OVER (PARTITION BY run ORDER BY n DESC, reason) AS rk FROM (
            SELECT 'day-' || CAST(emit_ms // 86400000 AS STRING) AS run, reason, count(*) AS n
            FROM routed_stream WHERE NOT accepted GROUP BY 1, 2)) WHERE rk = 1""",
    )
)
def top_reason(spark, sf):
    return _experiments(spark, sf).select("run", "top_quarantine_reason")


@query(
    over(
        "routed_stream",
        """SELECT run, string_agg(event_type || ':' || n, ', ' ORDER BY event_type) AS event_mix
        FROM (SELECT 'day-' || CAST(emit_ms // 86400000 AS STRING) AS run, event_type, count(*) AS n
              FROM routed_stream WHERE accepted GROUP BY 1, 2) GROUP BY run""",
    )
)
def event_mix(spark, sf):
    return _experiments(spark, sf).select("run", "event_mix")


@query(
    over(
        "days",
        """SELECT (SELECT run FROM e ORDER BY eps DESC, run LIMIT 1) AS fastest_run,
          (SELECT max(eps) FROM e) AS producer_events_per_sec,
          (SELECT run FROM e ORDER BY lat, run LIMIT 1) AS lowest_latency_run,
          (SELECT min(lat) FROM e) AS p95_latency_ms"""
        .replace("FROM e", """FROM (SELECT run, round(sent / seconds::DOUBLE, 2) AS eps,
          round(p95, 2) AS lat FROM days LEFT JOIN day_latency USING (run))"""),
        "day_latency",
    )
)
def best_runs(spark, sf):
    return exp.best_runs(_experiments(spark, sf))


@query(over("days", "SELECT count(*) AS runs, CAST(sum(sent) AS BIGINT) AS events_sent FROM days"))
def experiment_overview(spark, sf):
    return exp.experiment_overview(_experiments(spark, sf))


def _no_producer(spark):
    return spark.createDataFrame([], PRODUCER_SCHEMA)


def _summary(spark, sf):
    events = stage(_with_latency(_routed(spark, sf)), "routed")
    hot = find_hot_patients(events)
    alerts = alerts_with_cooldown(events.filter("accepted"), COOLDOWN_MS, hot)
    return met.build_summary(events, alerts, _no_producer(spark))


@query()
def build_summary(spark, sf):
    return _summary(spark, sf)


@query()
def local_summary(spark, sf):
    events = stage(_with_latency(_routed(spark, sf, "local", ("raw",))), "routed")
    hot = find_hot_patients(events)
    alerts = alerts_with_cooldown(events.filter("accepted"), COOLDOWN_MS, hot)
    return met.local_summary(events, alerts)


@query(
    over(
        "routed_stream",
        f"""SELECT series, name, CAST(value AS DOUBLE) AS value FROM (
        SELECT 'validity' AS series, 'valid' AS name, count(*) FILTER (accepted) AS value
          FROM routed_stream
        UNION ALL SELECT 'validity', 'quarantined',
          count(*) FILTER (NOT accepted AND reason IN ({SUMMARY_REASONS_SQL})) FROM routed_stream
        UNION ALL SELECT 'performance', 'events/sec', 0
        UNION ALL SELECT 'performance', 'avg ms', avg(v) FROM latencies
        UNION ALL SELECT 'performance', 'p50 ms', median(v) FROM latencies
        UNION ALL SELECT 'performance', 'p95 ms', v FROM (SELECT v,
          row_number() OVER (ORDER BY v) - 1 AS i, count(*) OVER () AS n FROM latencies)
          WHERE i = least(n - 1, floor(n * 0.95)))""",
        "latencies",
    )
)
def summary_series(spark, sf):
    return met.summary_series(_summary(spark, sf))


@query(
    over(
        "routed_stream",
        """SELECT event_type AS name, CAST(count(*) AS DOUBLE) AS value FROM routed_stream
        WHERE accepted GROUP BY event_type""",
    )
)
def summary_type_series(spark, sf):
    return met.count_series(_summary(spark, sf), "event_counts")


# --- keyed reads -----------------------------------------------------------------------------


@query(
    over(
        "routed_stream",
        """SELECT arrival_seq, reason, substr(raw, 1, 220) AS preview
        FROM routed_stream JOIN raw_events USING (arrival_seq) WHERE NOT accepted
        ORDER BY arrival_seq LIMIT 5""",
        "raw_events",
    )
)
def quarantine_samples(spark, sf):
    return met.quarantine_samples(_rejected(spark, sf, extra=("raw",)))


@query(
    over(
        "stored",
        """SELECT event_id, patient_id, event_type FROM stored
        WHERE event_id = (SELECT max(event_id) FROM stored)""",
    )
)
def get_event(spark, sf):
    root = new_path(spark, "tables")
    _write_in_parts(spark, sf, root)
    stored = tables.read_table(spark, root, tables.EVENTS_BY_ID)
    wanted = stored.agg(F.max("event_id")).first()[0]
    found = tables.read_key(spark, root, tables.EVENTS_BY_ID, wanted)
    return reads.get_event(found, wanted).select("event_id", "patient_id", "event_type")


@query(
    over(
        "alerts_stream",
        """SELECT patient_id, alert_ms, alert_type FROM (SELECT patient_id, event_time_ms AS alert_ms,
        alert_type, row_number() OVER (PARTITION BY patient_id ORDER BY event_time_ms DESC) AS rk
        FROM alerts_stream) WHERE rk <= 3""",
    )
)
def latest_alerts_by_patient(spark, sf):
    found = reads.latest_alerts_by_patient(_stored_alerts(spark, sf, tables.ALERTS_BY_PATIENT), 3)
    return found.select("patient_id", F.unix_millis("alert_time").alias("alert_ms"), "alert_type")


@query(
    over(
        "alerts_stream",
        """SELECT alert_type, alert_ms, patient_id FROM (SELECT patient_id, event_time_ms AS alert_ms,
        alert_type, row_number() OVER (PARTITION BY alert_type ORDER BY event_time_ms DESC, patient_id)
        AS rk FROM alerts_stream) WHERE rk <= 10""",
    )
)
def latest_alerts_by_type(spark, sf):
    found = reads.latest_alerts_by_type(_stored_alerts(spark, sf, tables.ALERTS_BY_TYPE), 10)
    return found.select("alert_type", F.unix_millis("alert_time").alias("alert_ms"), "patient_id")


@query(
    over(
        "routed_stream",
        """SELECT reason, observed_ms, event_id FROM (SELECT reason, processed_ms AS observed_ms,
        event_id, row_number() OVER (PARTITION BY reason ORDER BY processed_ms DESC, event_id) AS rk
        FROM routed_stream WHERE NOT accepted) WHERE rk <= 5""",
    )
)
def latest_quarantine_by_reason(spark, sf):
    found = reads.latest_quarantine_by_reason(_stored_quarantine(spark, sf), 5)
    return found.select("reason", F.unix_millis("observed_at").alias("observed_ms"), "event_id")


@query(
    over(
        "stored",
        """SELECT event_id, patient_id, event_time_ms FROM stored WHERE event_type = 'admission'
        ORDER BY event_id""",
    )
)
def events_of_type(spark, sf):
    found = reads.events_of_type(_stored_by_type(spark, sf), "admission")
    return found.select("event_id", "patient_id", F.unix_millis("event_time").alias("event_time_ms"))


# --- file and topic outputs ------------------------------------------------------------------


def _full(spark, sf):
    """Routed, enriched records with all columns that the outputs write."""
    routed = _with_latency(_routed(spark, sf, extra=TEXT_COLUMNS))
    return enrich(routed, patient_metadata(patients(spark, sf)), F.col("accepted"))


def _topic(spark, label):
    return {"format": "text", "path": new_path(spark, label)}


@query(
    over(
        "routed_stream",
        "SELECT raw AS value FROM routed_stream JOIN raw_events USING (arrival_seq) WHERE accepted",
        "raw_events",
    )
)
def write_valid(spark, sf):
    target = _topic(spark, "valid")
    files.write_valid(_full(spark, sf).filter("accepted"), target)
    return spark.read.text(target["path"])


@query(
    over(
        "routed_stream",
        """SELECT event_id, array_to_string(errors, ',') AS errors, event_type,
        coalesce(event_time_ms, -1) AS event_ms, processed_ms FROM routed_stream
        WHERE NOT accepted""",
    )
)
def write_quarantine(spark, sf):
    target = _topic(spark, "quarantine")
    files.write_quarantine(_full(spark, sf).filter("not accepted"), target)
    fields = "struct<eventId:string,errors:array<string>,eventType:string," \
        "eventEpochMillis:bigint,processedAtMillis:bigint>"
    record = spark.read.text(target["path"]).select(F.from_json("value", fields).alias("r"))
    return record.select(
        F.col("r.eventId").alias("event_id"),
        F.array_join("r.errors", ",").alias("errors"),
        F.col("r.eventType").alias("event_type"),
        F.col("r.eventEpochMillis").alias("event_ms"),
        F.col("r.processedAtMillis").alias("processed_ms"),
    )


@query(
    over(
        "alerts_stream",
        "SELECT patient_id, alert_type, event_time_ms AS alert_ms, event_id, wbc FROM alerts_stream",
    )
)
def write_alerts(spark, sf):
    target = _topic(spark, "alerts")
    files.write_alerts(_alerts(spark, sf), alert_details(), target)
    fields = "struct<patientId:string,alertType:string,alertTimeMillis:bigint,eventId:string," \
        "detailsJson:string>"
    alert = spark.read.text(target["path"]).select(F.from_json("value", fields).alias("a"))
    return alert.select(
        F.col("a.patientId").alias("patient_id"),
        F.col("a.alertType").alias("alert_type"),
        F.col("a.alertTimeMillis").alias("alert_ms"),
        F.col("a.eventId").alias("event_id"),
        F.get_json_object("a.detailsJson", "$.wbc").cast("double").alias("wbc"),
    )


@query(
    over(
        "routed_local",
        """SELECT reason, count(*) AS table_rows, count(*) AS json_lines FROM routed_local
        WHERE NOT accepted GROUP BY reason""",
    )
)
def append_quarantine(spark, sf):
    root = new_path(spark, "local")
    files.append_quarantine(_rejected(spark, sf, "local", ("raw",)), root, reset=True)
    line = F.from_json("value", "struct<event:string,reason:string>")
    lines = spark.read.text(f"{root}/quarantine_jsonl").select(line["reason"].alias("reason"))
    stored = spark.read.parquet(f"{root}/quarantine").select("reason", F.lit(1).alias("t"))
    both = stored.unionByName(lines.select("reason", F.lit(0).alias("t")))
    return both.groupBy("reason").agg(
        F.count_if(F.col("t") == 1).alias("table_rows"),
        F.count_if(F.col("t") == 0).alias("json_lines"),
    )


@query(over("alerts_local", "SELECT patient_id, event_time_ms AS alert_time_ms FROM alerts_local"))
def append_alerts(spark, sf):
    root = new_path(spark, "local")
    files.append_alerts(_alerts(spark, sf, "local"), root, reset=True)
    return spark.read.parquet(f"{root}/alerts").select("patient_id", "alert_time_ms")


@query(
    over(
        "routed_local",
        """SELECT count(*) AS total, count(*) FILTER (accepted) AS accepted,
        (SELECT count(*) FROM alerts_local) AS alerts FROM routed_local""",
        "alerts_local",
    )
)
def save_run_metrics(spark, sf):
    events = stage(_with_latency(_routed(spark, sf, "local")), "routed")
    hot = find_hot_patients(events)
    alerts = alerts_with_cooldown(events.filter("accepted"), COOLDOWN_MS, hot)
    root = new_path(spark, "local")
    files.save_run_metrics(met.run_metrics(events, alerts), root, met.throughput_buckets(events))
    stored = spark.read.schema("total bigint, accepted bigint, alerts bigint")
    return stored.json(f"{root}/run_metrics")


@query(
    over(
        "routed_stream",
        f"""SELECT count(*) FILTER (accepted) AS valid,
        count(*) FILTER (reason IN ({SUMMARY_REASONS_SQL})) AS quarantine,
        (SELECT count(*) FROM alerts_stream) AS alerts FROM routed_stream""",
        "alerts_stream",
    )
)
def write_summary(spark, sf):
    path = new_path(spark, "summary")
    files.write_summary(_summary(spark, sf), path)
    return spark.read.schema(SUMMARY_SCHEMA).json(path).select(
        "totals.valid", "totals.quarantine", "totals.alerts"
    )


_RUNS = "SELECT run, sent AS events_sent, valid, quarantine FROM days"


@query(over("days", _RUNS.replace("valid, quarantine", "CAST(valid AS BIGINT) AS valid, "
                                  "CAST(quarantine AS BIGINT) AS quarantine")))
def write_experiments(spark, sf):
    root = new_path(spark, "experiments")
    files.write_experiments(_experiments(spark, sf), root)
    stored = spark.read.schema(EXPERIMENT_SCHEMA).option("header", True)
    return stored.csv(f"{root}/experiments_csv").select("run", "events_sent", "valid", "quarantine")


@query(over("days", "SELECT 'run=' || run AS run, sent AS events_sent FROM days"))
def read_run_summaries(spark, sf):
    path = new_path(spark, "summaries")
    _day_summaries(spark, sf).write.partitionBy("run").json(path)
    found = read_summaries(spark, path, "*/*.json")
    return found.select("run", F.col("producer.sent").alias("events_sent"))
