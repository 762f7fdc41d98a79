import json

import pytest
from pyspark.sql import functions as F

from evpipe.operators.parse import parse_events, payload_from_text
from evpipe.operators.route import route
from evpipe.operators.validate import validate

UUID = "7c90aa51-13d2-4e6b-9a07-5d10c2f4be38"
BASE = {
    "event_id": UUID,
    "patient_id": "P000417",
    "event_type": "vital",
    "event_time": "2025-06-03T07:45:30Z",
    "source_emit_time": "2025-06-03T07:45:31Z",
    "source": "ward-4-gateway",
    "schema_version": "ehr.v1",
    "payload": {"name": "spo2", "value": 97, "unit": "%"},
}
ALL_MISSING = "missing_event_id_event_time_event_type_patient_id_payload_schema_version_source"


def event(drop=(), **changes):
    record = {k: v for k, v in {**BASE, **changes}.items() if k not in drop}
    return json.dumps(record)


def vital(name, value):
    return event(payload={"name": name, "value": value})


def lab(test, result):
    return event(event_type="lab", payload={"test": test, "result": result})


def med(**payload):
    return event(event_type="medication", payload=payload)


def adm(**payload):
    return event(event_type="admission", payload=payload)


UNPARSED = (
    "bad_event_id missing_patient_id bad_event_time unsupported_schema_version unknown_event_type"
)
NO_RECORD = UNPARSED.replace("bad_event_id", "missing_event_id")

# raw text, stream errors, local errors
CASES = {
    "no_uuid": (event(event_id="evt-1"), "bad_event_id", ""),
    "fine": (event(), "", ""),
    "empty": ("", "empty_record", "empty_record"),
    "spaces": (" \t\n", "empty_record", "empty_record"),
    "broken": ("{bad", UNPARSED, "bad_payload_json"),
    "array": ("[1]", NO_RECORD, ALL_MISSING),
    "null_doc": ("null", NO_RECORD, ALL_MISSING),
    "patient_null": (event(patient_id=None), "missing_patient_id", "bad_patient_id"),
    "patient_x": (event(patient_id="X1"), "", "bad_patient_id"),
    "patient_object": (event(patient_id={"a": 1}), "missing_patient_id", "bad_patient_id"),
    "patient_text_brace": (event(patient_id="{x"), "", "bad_patient_id"),
    "phone": (event(phone="1"), "", "contains_direct_phi"),
    "patient_name": (event(patient_name="J"), "contains_direct_phi", "contains_direct_phi"),
    "nested_ssn": (
        event(payload={"name": "heart_rate", "value": 88, "ssn": "1"}), "contains_direct_phi", "",
    ),
    "text_number": (vital("heart_rate", "88"), "", "bad_vital_value"),
    "bool_number": (vital("heart_rate", True), "vital_out_of_range", "vital_out_of_range"),
    "null_number": (vital("heart_rate", None), "bad_vital_value", "bad_vital_value"),
    "high_vital": (vital("heart_rate", 999), "vital_out_of_range", "vital_out_of_range"),
    "range_edge": (vital("heart_rate", 250), "", ""),
    "systolic": (vital("systolic_bp", 300), "", "vital_out_of_range"),
    "vital_name": (vital("mood", 5), "bad_vital_name", "bad_vital_name"),
    "vital_both": (vital("mood", "x"), "bad_vital_name bad_vital_value", "bad_vital_name"),
    "lactate": (lab("lactate", 50), "", "lab_out_of_range"),
    "lab_text": (lab("wbc", "abc"), "lab_out_of_range", "bad_lab_result"),
    "lab_test": (lab("x", 3), "bad_lab_test", "bad_lab_test"),
    "med_dose": (
        med(dose=-10), "missing_medication bad_medication_dose", "missing_medication",
    ),
    "med_blank": (med(medication=" ", dose=1), "missing_medication", ""),
    "med_zero": (med(medication="a", dose=0), "bad_medication_dose", "bad_medication_dose"),
    "med_object": (med(medication={"a": 1}, dose=1), "missing_medication", ""),
    "acuity_fraction": (adm(department="ICU", acuity=3.7), "", "bad_acuity"),
    "acuity_high": (adm(department="ICU", acuity=6), "bad_acuity", "bad_acuity"),
    "acuity_text": (adm(department="ICU", acuity="3"), "", "bad_acuity"),
    "department": (adm(acuity=3), "missing_department", "missing_department"),
    "date_only": (event(event_time="2026-01-24"), "bad_event_time", ""),
    "offset": (event(event_time="2026-01-24T12:00:00+02:00"), "bad_event_time", ""),
    "before_1970": (event(event_time="1969-01-24T12:00:00Z"), "bad_event_time", ""),
    "no_time": (event(event_time="not-a-timestamp"), "bad_event_time", "bad_event_time"),
    "version": (event(schema_version="ehr.v2"), "unsupported_schema_version", ""),
    "absent_two": (
        event(drop=("source", "payload")), "bad_vital_name bad_vital_value", "missing_payload_source",
    ),
    "payload_array": (
        event(payload=[1]), "bad_vital_name bad_vital_value", "payload_not_object",
    ),
    "payload_text": (
        event(payload='{"name":"heart_rate","value":88}'),
        "bad_vital_name bad_vital_value",
        "payload_not_object",
    ),
    "payload_null": (
        event(payload=None), "bad_vital_name bad_vital_value", "payload_not_object",
    ),
    "unknown_type": (event(event_type="fax"), "unknown_event_type", "unknown_event_type"),
    "two_errors": (
        event(event_type="fax", patient_id="X"),
        "unknown_event_type",
        "unknown_event_type bad_patient_id",
    ),
}


def raw_frame(spark, texts):
    rows = [(i, text, 1_800_000_000_000 + i) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, "arrival_seq bigint, raw string, processed_ms bigint")


@pytest.mark.parametrize("profile", ["stream", "local"])
def test_edge_rows(spark, profile):
    raw = raw_frame(spark, [c[0] for c in CASES.values()])
    rows = validate(parse_events(raw, profile), profile).orderBy("arrival_seq").collect()
    column = 1 if profile == "stream" else 2
    got = {name: row["errors"] for name, row in zip(CASES, rows, strict=True)}
    want = {name: case[column].split() for name, case in CASES.items()}
    assert got == want


def test_payload_text_is_kept(spark):
    texts = [
        event(payload={"b": 1.50, "a": "x"}),
        event(payload="say \"hi\""),
        event(payload=None),
        event(drop=("payload",)),
        event(payload=[1, 2]),
        event(payload=5),
        event(payload={}),
    ]
    rows = parse_events(raw_frame(spark, texts)).orderBy("arrival_seq").collect()
    got = [r["payload_json"] for r in rows]
    assert got == ['{"b":1.5,"a":"x"}', '"say \\"hi\\""', "null", "{}", "[1,2]", "5", "{}"]


def test_unparseable_record(spark):
    row = parse_events(raw_frame(spark, ["{bad"])).first()
    assert row["event_type"] == "unparseable"
    assert row["event_id"] == row["record_key"] == row["raw_hash"]
    assert len(row["raw_hash"]) == 24 and row["payload_json"] == "{}" and row["event_ms"] == -1


def test_stored_payload_that_is_no_json(spark):
    events = parse_events(raw_frame(spark, [event(), event()]))
    broken = events.withColumn(
        "payload_json", F.when(F.col("arrival_seq") == 1, "{oops").otherwise(F.col("payload_json"))
    )
    rows = validate(payload_from_text(broken)).orderBy("arrival_seq").collect()
    assert [r["errors"] for r in rows] == [[], ["bad_payload_json"]]


def test_accepted_then_broken_with_same_id(spark):
    texts = [event(), event(event_type="fax")]
    for profile, want in (
        ("stream", ["unknown_event_type", "duplicate_event_id"]),
        ("local", ["unknown_event_type"]),
    ):
        checked = validate(parse_events(raw_frame(spark, texts), profile), profile)
        rows = route(checked, profile, 30).orderBy("arrival_seq").collect()
        assert [r["errors"] for r in rows] == [[], want]


def test_late_repeat_is_late_again(spark):
    texts = [
        event(),
        event(event_id=UUID.replace("a", "b"), event_time="2025-06-03T05:00:00Z"),
        event(event_id=UUID.replace("a", "b"), event_time="2025-06-03T05:00:00Z"),
    ]
    for profile in ("stream", "local"):
        checked = validate(parse_events(raw_frame(spark, texts), profile), profile)
        rows = route(checked, profile, 300).orderBy("arrival_seq").collect()
        assert [r["reason"] for r in rows] == ["accepted", "late_event", "late_event"]


def test_filter_on_errors_does_not_repeat_the_parse(spark):
    checked = validate(parse_events(raw_frame(spark, [event()])))
    plan = checked.filter(F.size("errors") == 0)._jdf.queryExecution().optimizedPlan().toString()
    # Once as text fields and once as typed values.
    assert plan.count("from_json") == 2


TRICKY = (
    '{"event_id":"%s","patient_id":"P1","event_type":"vital","event_time":"2025-06-03T07:45:30Z",'
    '"source_emit_time":"2025-06-03T07:45:31Z","source":"a\\"payload\\":\\"b","schema_version":"ehr.v1",'
    '"note":{"payload":"x","patient_id":{"a":1}},"payload":{"name":"spo2","value":97}}' % UUID
)


@pytest.mark.parametrize("profile", ["stream", "local"])
def test_types_come_from_the_parsed_record(spark, profile):
    text = json.loads(TRICKY)
    assert text["payload"]["value"] == 97
    quoted = json.dumps({**text, "payload": json.dumps({"name": "spo2", "value": 97})})
    rows = validate(parse_events(raw_frame(spark, [TRICKY, quoted]), profile), profile)
    first, second = rows.orderBy("arrival_seq").collect()
    assert first["errors"] == []
    assert second["errors"]


ISO_FORMS = {
    "2025-06-03": "2025-06-03T00:00:00", "2025-06-03T07": "2025-06-03T07:00:00",
    "20250603T074530": "2025-06-03T07:45:30", "20250603": "2025-06-03T00:00:00",
    "2025-W23-2T07:45:30Z": "2025-06-03T07:45:30", "2025W232": "2025-06-03T00:00:00",
    "2025-W01": "2024-12-30T00:00:00", "2020-W53-7": "2021-01-03T00:00:00",
    "2025-06-03T07:45:30+05:30:15": "2025-06-03T02:15:15", "2025-06-03x07:45": "2025-06-03T07:45:00",
    "2025-06-03T0745-0130": "2025-06-03T09:15:00", "2025-06-03T07:45:30.5": "2025-06-03T07:45:30.500",
    "2025-W53-1": None, "2025-W00-1": None, "2025-13-01": None, "2025-06-03T25:00": None,
    "2025-06-03T07:61": None, "2025-02-30": None, "junk": None, "2025-06": None,
}


def test_iso_forms(spark):
    from datetime import datetime, timezone

    from evpipe.functions.time import lenient_millis

    frame = spark.createDataFrame([(t,) for t in ISO_FORMS], "t string")
    for row in frame.select("t", lenient_millis(F.col("t")).alias("ms")).collect():
        want = ISO_FORMS[row["t"]]
        if want is None:
            assert row["ms"] is None, row
        else:
            at = datetime.fromisoformat(want).replace(tzinfo=timezone.utc)
            assert row["ms"] == round(at.timestamp() * 1000), row
