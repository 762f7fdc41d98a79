"""Plain SQL for the same questions, written for another engine as an independent check."""

from __future__ import annotations

from evpipe.schema import ALERT_TYPE, SUMMARY_EVENT_TYPES, SUMMARY_REASONS
from evpipe.sources.fixtures import event_view_sql, patients_sql, raw_text_sql

LATENESS_MS = 1_800_000
COOLDOWN_MS = 86_400_000

_STR = "json_extract_string(payload, '$.{}')"
_NUM = "TRY_CAST(json_extract_string(payload, '$.{}') AS DOUBLE)"

_ALERT_PROFILES = ("stream", "local", "nolate", "batches")
# File drops of the streams of several micro-batches, in order of arrival.
DROPS = 4
# A record comes with the drop of its place in the order of arrival; every 17th comes a drop later.
STRAGGLER = "arrival_seq % 17 = 3"
_DROP = "least(%d, CAST(%s AS INT) + %s)" % (
    DROPS - 1,
    STRAGGLER,
    " + ".join(
        f"CAST(arrival_seq >= (SELECT count(*) FROM event_view) * {i} // {DROPS} AS INT)"
        for i in range(1, DROPS)
    ),
)
# Numbers of the records of a drop follow those of the drops before.
DROP_NUMBERS = 1_000_000_000_000

_VIEWS: dict[str, str] = {
    "event_view": event_view_sql("duckdb"),
    "raw_events": raw_text_sql("duckdb"),
    "patients": patients_sql(),
    "fields": f"""
        SELECT *,
          CASE event_type WHEN 'vital' THEN {_STR.format('name')} WHEN 'lab' THEN {_STR.format('test')}
            WHEN 'medication' THEN {_STR.format('medication')}
            WHEN 'admission' THEN {_STR.format('department')} END AS label,
          CASE event_type WHEN 'vital' THEN {_NUM.format('value')} WHEN 'lab' THEN {_NUM.format('result')}
            WHEN 'medication' THEN {_NUM.format('dose')}
            WHEN 'admission' THEN {_NUM.format('acuity')} END AS number
        FROM event_view""",
    "checked_stream": """
        SELECT *, list_filter([
          CASE WHEN coalesce(trim(patient_id), '') = '' THEN 'missing_patient_id' END,
          CASE WHEN coalesce(event_time_ms, -1) <= 0 THEN 'bad_event_time' END,
          CASE WHEN event_type NOT IN ('vital','lab','medication','admission')
               THEN 'unknown_event_type' END,
          CASE WHEN has_phi THEN 'contains_direct_phi' END,
          CASE WHEN event_type = 'vital' AND coalesce(label, '') NOT IN
               ('heart_rate','systolic_bp','diastolic_bp','temperature_c','spo2')
               THEN 'bad_vital_name' END,
          CASE WHEN event_type = 'vital' AND number IS NULL THEN 'bad_vital_value' END,
          CASE WHEN event_type = 'vital' AND (
                 (label = 'heart_rate' AND (number < 20 OR number > 250))
              OR (label = 'temperature_c' AND (number < 25 OR number > 45))
              OR (label = 'spo2' AND (number < 50 OR number > 100))) THEN 'vital_out_of_range' END,
          CASE WHEN event_type = 'lab' AND coalesce(label, '') NOT IN ('wbc','lactate','creatinine')
               THEN 'bad_lab_test' END,
          CASE WHEN event_type = 'lab' AND (number IS NULL OR number < 0 OR number > 80)
               THEN 'lab_out_of_range' END,
          CASE WHEN event_type = 'medication' AND coalesce(trim(label), '') = ''
               THEN 'missing_medication' END,
          CASE WHEN event_type = 'medication' AND (number IS NULL OR number <= 0)
               THEN 'bad_medication_dose' END,
          CASE WHEN event_type = 'admission' AND coalesce(trim(label), '') = ''
               THEN 'missing_department' END,
          CASE WHEN event_type = 'admission' AND
                 (number IS NULL OR trunc(number) < 1 OR trunc(number) > 5) THEN 'bad_acuity' END
        ], lambda x: x IS NOT NULL) AS errors FROM fields""",
    "checked_local": """
        SELECT *, CASE WHEN patient_id IS NULL THEN ['missing_patient_id'] ELSE list_filter([
          CASE WHEN has_phi THEN 'contains_direct_phi' END,
          CASE WHEN event_type NOT IN ('vital','lab','medication','admission')
               THEN 'unknown_event_type' END,
          CASE WHEN left(patient_id, 1) <> 'P' THEN 'bad_patient_id' END,
          CASE WHEN event_time_ms IS NULL THEN 'bad_event_time' END,
          CASE event_type
            WHEN 'vital' THEN CASE
              WHEN coalesce(label, '') NOT IN
                ('heart_rate','systolic_bp','diastolic_bp','temperature_c','spo2') THEN 'bad_vital_name'
              WHEN number IS NULL THEN 'bad_vital_value'
              WHEN (label = 'heart_rate' AND number NOT BETWEEN 20 AND 250)
                OR (label = 'systolic_bp' AND number NOT BETWEEN 40 AND 260)
                OR (label = 'diastolic_bp' AND number NOT BETWEEN 20 AND 160)
                OR (label = 'temperature_c' AND number NOT BETWEEN 25 AND 45)
                OR (label = 'spo2' AND number NOT BETWEEN 50 AND 100) THEN 'vital_out_of_range' END
            WHEN 'lab' THEN CASE
              WHEN coalesce(label, '') NOT IN ('wbc','lactate','creatinine') THEN 'bad_lab_test'
              WHEN number IS NULL THEN 'bad_lab_result'
              WHEN (label = 'wbc' AND number NOT BETWEEN 0 AND 80)
                OR (label IN ('lactate','creatinine') AND number NOT BETWEEN 0 AND 20)
                THEN 'lab_out_of_range' END
            WHEN 'medication' THEN CASE WHEN label IS NULL THEN 'missing_medication'
              WHEN number IS NULL OR number <= 0 THEN 'bad_medication_dose' END
            WHEN 'admission' THEN CASE WHEN label IS NULL THEN 'missing_department'
              WHEN number IS NULL OR number <> trunc(number) OR number NOT BETWEEN 1 AND 5
              THEN 'bad_acuity' END
          END], lambda x: x IS NOT NULL) END AS errors FROM fields""",
    "timed_stream": """
        SELECT *, max(CASE WHEN event_time_ms > 0 THEN event_time_ms ELSE processed_ms END) OVER
          (ORDER BY arrival_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS max_event_ms,
          len(errors) = 0 AS valid FROM checked_stream""",
    "timed_local": """
        SELECT *, max(CASE WHEN len(errors) = 0 THEN event_time_ms END) OVER
          (ORDER BY arrival_seq ROWS UNBOUNDED PRECEDING) AS max_event_ms,
          len(errors) = 0 AS valid FROM checked_local""",
    "flagged_stream": f"""
        SELECT *, coalesce(event_time_ms + {LATENESS_MS} < max_event_ms - {LATENESS_MS} - 1, false)
          AS late FROM timed_stream""",
    "flagged_local": f"""
        SELECT *, coalesce(event_time_ms < max_event_ms - {LATENESS_MS}, false) AS late,
          coalesce(event_time_ms < max_event_ms, false) AS out_of_order FROM timed_local""",
    "keyed_stream": """
        SELECT *, coalesce(arrival_seq > min(CASE WHEN valid AND NOT late THEN arrival_seq END)
          OVER (PARTITION BY event_id), false) AS duplicate FROM flagged_stream""",
    "keyed_local": """
        SELECT *, coalesce(arrival_seq > min(CASE WHEN valid AND NOT late THEN arrival_seq END)
          OVER (PARTITION BY event_id), false) AS duplicate FROM flagged_local""",
    "routed_stream": """
        SELECT * REPLACE (errs AS errors), len(errs) = 0 AS accepted,
          CASE WHEN len(errs) = 0 THEN 'accepted' ELSE errs[1] END AS reason
        FROM (SELECT *, CASE WHEN duplicate THEN list_append(errors, 'duplicate_event_id')
          WHEN valid AND late THEN ['late_event'] ELSE errors END AS errs FROM keyed_stream)""",
    # One micro-batch of a stream: the watermark has not moved, so nothing is late.
    "routed_nolate": """
        SELECT * REPLACE (errs AS errors), len(errs) = 0 AS accepted,
          CASE WHEN len(errs) = 0 THEN 'accepted' ELSE errs[1] END AS reason
        FROM (SELECT *, CASE WHEN coalesce(arrival_seq > min(CASE WHEN len(errors) = 0
            THEN arrival_seq END) OVER (PARTITION BY event_id), false)
          THEN list_append(errors, 'duplicate_event_id') ELSE errors END AS errs
        FROM checked_stream)""",
    # Several micro-batches: the watermark follows from those before, and stands still in each.
    "timed_batches": f"""
        SELECT *, max(CASE WHEN event_time_ms > 0 THEN event_time_ms ELSE processed_ms END) OVER
          (ORDER BY b RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS max_event_ms,
          len(errors) = 0 AS valid
        FROM (SELECT * REPLACE (b * {DROP_NUMBERS} + arrival_seq AS arrival_seq)
          FROM (SELECT *, {_DROP} AS b FROM checked_stream))""",
    # A topic of three partitions with offsets of their own, merged by broker time.
    "event_view_topic": """
        SELECT * REPLACE (row_number() OVER (ORDER BY broker_ms, part, place) AS arrival_seq)
        FROM (SELECT *, max(processed_ms) OVER
            (PARTITION BY part ORDER BY place ROWS UNBOUNDED PRECEDING) AS broker_ms
          FROM (SELECT *, arrival_seq % 3 AS part,
            (arrival_seq // 3 + arrival_seq % 3 * 1000000) * 65536 + arrival_seq % 3 AS place
            FROM event_view))""",
    "routed_local": """
        SELECT *, reason = 'accepted' AS accepted FROM (SELECT *, CASE
          WHEN NOT valid THEN array_to_string(errors, '|') WHEN duplicate THEN 'duplicate_event_id'
          WHEN late THEN 'late_event' ELSE 'accepted' END AS reason FROM keyed_local)""",
    **{
        f"state_{p}": f"""
        SELECT *, """
        + ", ".join(
            f"""last_value(CASE WHEN event_type IN ('vital','lab') AND label = '{s}' THEN number END
          IGNORE NULLS) OVER (PARTITION BY patient_id ORDER BY arrival_seq ROWS UNBOUNDED PRECEDING)
          AS {s}"""
            for s in (
                "heart_rate", "temperature_c", "wbc", "lactate",
                "systolic_bp", "diastolic_bp", "spo2", "creatinine",
            )
        )
        + f" FROM routed_{p} WHERE accepted"
        for p in _ALERT_PROFILES
    },
    **{
        f"hits_{p}": f"""
        SELECT arrival_seq, patient_id, event_id, event_time_ms, processed_ms,
          coalesce(heart_rate, 0) AS heart_rate, coalesce(temperature_c, 0) AS temperature_c,
          coalesce(wbc, 0) AS wbc, coalesce(lactate, 0) AS lactate,
          row_number() OVER (PARTITION BY patient_id ORDER BY arrival_seq) AS i
        FROM state_{p} WHERE coalesce(heart_rate, 0) >= 110 AND coalesce(temperature_c, 0) >= 38
          AND (coalesce(wbc, 0) >= 12 OR coalesce(lactate, 0) >= 2.2)"""
        for p in _ALERT_PROFILES
    },
    **{
        f"folded_{p}": f"""
        SELECT patient_id, i, event_time_ms AS last, true AS fired FROM hits_{p} WHERE i = 1
        UNION ALL
        SELECT h.patient_id, h.i,
          CASE WHEN h.event_time_ms - f.last < {COOLDOWN_MS} THEN f.last ELSE h.event_time_ms END,
          h.event_time_ms - f.last >= {COOLDOWN_MS}
        FROM folded_{p} f JOIN hits_{p} h ON h.patient_id = f.patient_id AND h.i = f.i + 1"""
        for p in _ALERT_PROFILES
    },
    **{
        f"alerts_{p}": f"""
        SELECT h.*, '{ALERT_TYPE}' AS alert_type FROM hits_{p} h JOIN folded_{p} f
          ON h.patient_id = f.patient_id AND h.i = f.i AND f.fired"""
        for p in _ALERT_PROFILES
    },
    "stored": """
        SELECT event_id, patient_id, event_type, event_time_ms, source, payload,
          CAST(processed_ms - emit_ms AS DOUBLE) AS ingestion_latency_ms, processed_ms, arrival_seq
        FROM routed_stream WHERE accepted""",
    "latencies": "SELECT ingestion_latency_ms AS v FROM stored",
    "days": """
        SELECT ts_day AS run, count(*) AS sent, count(DISTINCT patient_id) AS patients,
          sum(CASE WHEN accepted THEN 1 ELSE 0 END) AS valid,
          sum(CASE WHEN accepted THEN 0 ELSE 1 END) AS quarantine,
          (max(processed_ms) - min(processed_ms)) / 1000.0 AS seconds
        FROM (SELECT *, 'day-' || CAST(emit_ms // 86400000 AS STRING) AS ts_day FROM routed_stream)
        GROUP BY ts_day""",
    "day_latency": """
        SELECT run, avg(v) AS avg_ms, max(v) AS max_ms, median(v) AS p50,
          max(CASE WHEN i = least(n - 1, floor(n * 0.95)) THEN v END) AS p95
        FROM (SELECT run, v, row_number() OVER (PARTITION BY run ORDER BY v) - 1 AS i,
            count(*) OVER (PARTITION BY run) AS n
          FROM (SELECT 'day-' || CAST(emit_ms // 86400000 AS STRING) AS run,
            CAST(processed_ms - emit_ms AS DOUBLE) AS v FROM routed_stream WHERE accepted))
        GROUP BY run""",
    "day_alerts": """
        SELECT 'day-' || CAST(emit_ms // 86400000 AS STRING) AS run, count(*) AS alerts
        FROM alerts_stream JOIN (SELECT arrival_seq AS s, emit_ms FROM routed_stream) ON s = arrival_seq
        GROUP BY 1""",
    "day_texts": """
        SELECT run, max(CASE WHEN NOT accepted AND rk = 1 THEN reason || ' (' || n || ')' END)
            AS top_reason,
          string_agg(CASE WHEN accepted THEN event_type || ':' || n END, ', ' ORDER BY event_type)
            AS mix
        FROM (SELECT *, row_number() OVER (PARTITION BY run, accepted ORDER BY n DESC, reason) AS rk
          FROM (SELECT 'day-' || CAST(emit_ms // 86400000 AS STRING) AS run, accepted, count(*) AS n,
              CASE WHEN accepted THEN event_type END AS event_type,
              CASE WHEN NOT accepted THEN reason END AS reason
            FROM routed_stream GROUP BY 1, 2, 4, 5))
        GROUP BY run""",
}

for _step in ("flagged", "keyed", "routed"):
    _VIEWS[f"{_step}_batches"] = _VIEWS[f"{_step}_stream"].replace("_stream", "_batches")
_TOPIC = ("fields", "checked_stream", "checked_local", "timed_local", "flagged_local", "keyed_local",
          "routed_local", "routed_nolate")
for _name in _TOPIC:
    _text = _VIEWS[_name]
    for _other in ("event_view", *_TOPIC):
        _text = _text.replace(f"FROM {_other}", f"FROM {_other}_topic")
    _VIEWS[f"{_name}_topic"] = _text

_NEEDS = {
    "raw_events": ["event_view"],
    "fields": ["event_view"],
    "checked_stream": ["fields"],
    "checked_local": ["fields"],
    "stored": ["routed_stream"],
    "latencies": ["stored"],
    "days": ["routed_stream"],
    "day_latency": ["routed_stream"],
    "day_alerts": ["alerts_stream", "routed_stream"],
    "day_texts": ["routed_stream"],
}
for _p in _ALERT_PROFILES:
    _NEEDS.update(
        {
            f"timed_{_p}": [f"checked_{_p}"],
            f"flagged_{_p}": [f"timed_{_p}"],
            f"keyed_{_p}": [f"flagged_{_p}"],
            f"routed_{_p}": [f"keyed_{_p}"],
            f"state_{_p}": [f"routed_{_p}"],
            f"hits_{_p}": [f"state_{_p}"],
            f"folded_{_p}": [f"hits_{_p}"],
            f"alerts_{_p}": [f"hits_{_p}", f"folded_{_p}"],
        }
    )

_NEEDS["routed_nolate"] = ["checked_stream"]
_NEEDS["timed_batches"] = ["checked_stream"]
_NEEDS["event_view_topic"] = ["event_view"]
for _name in _TOPIC:
    _NEEDS[f"{_name}_topic"] = [f"{needed}_topic" for needed in _NEEDS[_name]]

SUMMARY_TYPES_SQL = ", ".join(f"'{t}'" for t in SUMMARY_EVENT_TYPES)
SUMMARY_REASONS_SQL = ", ".join(f"'{r}'" for r in SUMMARY_REASONS)


def over(view: str, select: str, *more: str) -> str:
    """`select` with the named views (and what they build on) spelled out before it."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in order:
            order.append(name)

    for name in (view, *more):
        add(name)
    recursive = "RECURSIVE " if any(n.startswith("folded_") for n in order) else ""
    # Materialized: the recursive step and the self-joins read their input many times.
    parts = [
        f"{n} AS {'' if n.startswith('folded_') else 'MATERIALIZED '}({_VIEWS[n]})" for n in order
    ]
    return f"WITH {recursive}" + ",\n".join(parts) + "\n" + select
