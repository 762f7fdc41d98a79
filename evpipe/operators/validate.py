"""Rule profiles: ordered error codes per event, and the valid / quarantine split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evpipe.functions.json import (
    is_integer_type,
    is_number_type,
    truncated_int,
)
from evpipe.functions.text import contains_any_quoted, is_blank, is_uuid, valid_patient_id
from evpipe.operators.parse import number_type, settle
from evpipe.schema import (
    ACUITY_RANGE,
    EVENT_TYPES,
    LAB_TESTS,
    LOCAL_LAB_RANGES,
    LOCAL_VITAL_RANGES,
    PHI_TEXT_NAMES,
    PHI_TOP_LEVEL_KEYS,
    REQUIRED_FIELDS,
    SCHEMA_VERSION,
    STREAM_LAB_RANGE,
    STREAM_VITAL_RANGES,
    VITAL_NAMES,
    check_profile,
)


def in_list(value: Column, allowed) -> Column:
    return F.coalesce(value.isin(*allowed), F.lit(False))


def in_range(name: Column, value: Column, ranges: dict[str, tuple[float, float]]) -> Column:
    """Inclusive limits looked up by name; names without limits pass."""
    checks = F.lit(True)
    for key, (low, high) in ranges.items():
        checks = F.when(name == key, value.between(low, high)).otherwise(checks)
    return F.coalesce(checks, F.lit(False))


def collect_errors(rules: list[tuple[str, Column]]) -> Column:
    """Codes of all rules that fire, in rule order, joined by a bar (empty text when none)."""
    return F.concat_ws("|", *[F.when(hit, F.lit(code)) for code, hit in rules])


def first_error(rules: list[tuple[str, Column]]) -> Column:
    """Code of the first rule that fires, NULL when none does."""
    chain = F.lit(None).cast("string")
    for code, hit in reversed(rules):
        chain = F.when(hit, F.lit(code)).otherwise(chain)
    return chain


def missing_fields(present: Column) -> Column:
    """`missing_a_b` for the absent required keys in sorted order, NULL when all are there."""
    required = F.array(*[F.lit(name) for name in sorted(REQUIRED_FIELDS)])
    absent = F.array_except(required, present)
    return F.when(F.size(absent) > 0, F.concat(F.lit("missing_"), F.array_join(absent, "_")))


def has_phi_text(raw: Column) -> Column:
    return contains_any_quoted(raw, PHI_TEXT_NAMES)


def has_phi_keys(present: Column) -> Column:
    return F.arrays_overlap(present, F.array(*[F.lit(name) for name in PHI_TOP_LEVEL_KEYS]))


def top_level_keys(raw: Column) -> Column:
    """Keys of a JSON object (a key holding null counts), empty for anything else."""
    return F.coalesce(F.json_object_keys(raw), F.array().cast("array<string>"))


def _stream_codes(payload_broken: Column | None = None) -> dict[str, Column]:
    kind, label = F.col("event_type"), F.col("label")
    number = F.nanvl("number", F.lit(None))
    id_blank = is_blank(F.col("event_id"))
    payload_rules = {
        "vital": [
            ("bad_vital_name", ~in_list(label, VITAL_NAMES)),
            ("bad_vital_value", number.isNull()),
            (
                "vital_out_of_range",
                number.isNotNull() & ~in_range(label, number, STREAM_VITAL_RANGES),
            ),
        ],
        "lab": [
            ("bad_lab_test", ~in_list(label, LAB_TESTS)),
            (
                "lab_out_of_range",
                ~F.coalesce(number.between(*STREAM_LAB_RANGE), F.lit(False)),
            ),
        ],
        "medication": [
            ("missing_medication", is_blank(label)),
            ("bad_medication_dose", ~F.coalesce(number > 0, F.lit(False))),
        ],
        "admission": [
            ("missing_department", is_blank(label)),
            ("bad_acuity", ~truncated_int(number).between(*ACUITY_RANGE)),
        ],
    }
    envelope = [
        ("missing_event_id", id_blank),
        ("bad_event_id", ~id_blank & ~is_uuid(F.col("event_id"))),
        ("missing_patient_id", is_blank(F.col("patient_id"))),
        ("bad_event_time", F.col("event_ms") <= 0),
        (
            "unsupported_schema_version",
            F.coalesce(F.col("schema_version") != SCHEMA_VERSION, F.lit(True)),
        ),
        ("unknown_event_type", ~in_list(kind, EVENT_TYPES)),
        ("contains_direct_phi", has_phi_text(F.col("raw"))),
    ]
    of_payload = F.lit("")
    for event_type, rules in payload_rules.items():
        of_payload = F.when(kind == event_type, collect_errors(rules)).otherwise(of_payload)
    if payload_broken is not None:
        of_payload = F.when(payload_broken, F.lit("bad_payload_json")).otherwise(of_payload)
    return {
        "_stop": F.when(is_blank(F.col("raw")), F.lit("empty_record")),
        "_envelope": collect_errors(envelope),
        "_payload": of_payload,
    }


def _local_payload_error() -> Column:
    kind, label, number = F.col("event_type"), F.col("label"), F.col("number")
    number_kind = F.col("_number_type")
    not_number = ~is_number_type(number_kind)
    rules = {
        "vital": [
            ("bad_vital_name", ~in_list(label, VITAL_NAMES)),
            ("bad_vital_value", not_number),
            ("vital_out_of_range", ~in_range(label, number, LOCAL_VITAL_RANGES)),
        ],
        "lab": [
            ("bad_lab_test", ~in_list(label, LAB_TESTS)),
            ("bad_lab_result", not_number),
            ("lab_out_of_range", ~in_range(label, number, LOCAL_LAB_RANGES)),
        ],
        "medication": [
            ("missing_medication", label.isNull()),
            ("bad_medication_dose", not_number | ~F.coalesce(number > 0, F.lit(False))),
        ],
        "admission": [
            ("missing_department", label.isNull()),
            (
                "bad_acuity",
                ~is_integer_type(number_kind) | ~truncated_int(number).between(*ACUITY_RANGE),
            ),
        ],
    }
    code = F.lit(None).cast("string")
    for event_type, type_rules in rules.items():
        code = F.when(kind == event_type, first_error(type_rules)).otherwise(code)
    return code


def _local_codes() -> dict[str, Column]:
    present = F.col("_keys")
    is_object = F.coalesce(F.col("payload_kind") == "object", F.lit(False))
    missing = missing_fields(present)
    rules = [
        ("contains_direct_phi", has_phi_keys(present)),
        ("unknown_event_type", ~in_list(F.col("event_type"), EVENT_TYPES)),
        ("payload_not_object", ~is_object),
        ("bad_patient_id", ~valid_patient_id(F.col("patient_id"))),
        ("bad_event_time", F.col("event_ms").isNull()),
    ]
    stop = (
        F.when(is_blank(F.col("raw")), F.lit("empty_record"))
        .when(F.col("malformed"), F.lit("bad_payload_json"))
        .otherwise(missing)
    )
    of_payload = F.when(is_object, _local_payload_error())
    return {
        "_stop": stop,
        "_envelope": collect_errors(rules),
        "_payload": F.coalesce(of_payload, F.lit("")),
    }


def validate(events: DataFrame, profile: str = "stream") -> DataFrame:
    """Add `errors` (ordered codes, empty when valid) to parsed events."""
    check_profile(profile)
    if profile == "stream":
        # Payload text cut out of a parsed record is always JSON; only events rebuilt from
        # stored text (`payload_from_text`) can carry a broken one.
        broken = F.col("payload_broken") if "payload_broken" in events.columns else None
        coded = events.withColumns(_stream_codes(broken))
    else:
        coded = events.withColumns(
            {"_keys": top_level_keys(F.col("raw")), "_number_type": number_type()}
        ).withColumns(_local_codes())
    # A code in `_stop` stands alone: the record was not looked at any further.
    parts = [F.when(F.col(c) != "", F.col(c)) for c in ("_envelope", "_payload")]
    codes = F.coalesce("_stop", F.concat_ws("|", *parts))
    clean = F.col("_stop").isNull() & (F.col("_envelope") == "") & (F.col("_payload") == "")
    errors = F.when(clean, F.array().cast("array<string>")).otherwise(F.split(codes, "[|]"))
    return settle(
        coded.withColumn("errors", errors)
        .drop("payload", "payload_kind", "payload_broken", "label", "number", "malformed")
        .drop("_keys", "_number_type", "_stop", "_envelope", "_payload"),
        ["errors"],
    )


def is_valid() -> Column:
    return F.size("errors") == 0


def first_reason(errors: Column) -> Column:
    return F.coalesce(F.get(errors, F.lit(0)), F.lit("unknown"))


def joined_reason(errors: Column) -> Column:
    return F.array_join(errors, "|")


def valid_events(events: DataFrame) -> DataFrame:
    return events.filter(is_valid())


def quarantined_events(events: DataFrame) -> DataFrame:
    return events.filter(~is_valid())
