"""Raw JSON text to typed event columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evpipe.functions.json import (
    blank_container,
    json_part,
    json_type,
    payload_json,
    payload_kind,
)
from evpipe.functions.text import raw_hash, record_key
from evpipe.functions.time import lenient_millis, strict_millis
from evpipe.schema import check_profile

_ENVELOPE = (
    "struct<event_id:string,patient_id:string,event_type:string,event_time:string,"
    "source_emit_time:string,source:string,schema_version:string,payload:string,"
    "_malformed:string>"
)
# The same record with the values whose JSON type decides something.
_TYPED = "struct<event_id:variant,patient_id:variant,payload:variant>"
_STRICT_JSON = {
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}
# Payload keys that the rules read, per event type.
_LABEL_KEY = {"vital": "name", "lab": "test", "medication": "medication", "admission": "department"}
_NUMBER_KEY = {"vital": "value", "lab": "result", "medication": "dose", "admission": "acuity"}


def _by_type(keys: dict[str, str], read) -> Column:
    kind, out = F.col("event_type"), F.lit(None)
    for event_type, key in keys.items():
        out = F.when(kind == event_type, read(f"$.{key}")).otherwise(out)
    return out


def parse_events(raw: DataFrame, profile: str = "stream") -> DataFrame:
    """Add typed columns to `raw` (column `raw` plus whatever orders and times the arrivals).

    The text is read as text fields and as typed values. Text that is no JSON gets the record hash as its id, the type
    `unparseable` and the payload `{}`. `label` and `number` are the two payload values the rules
    look at (name and value of a vital, name and dose of a medication, ...); `malformed` marks
    text that is no JSON at all.
    """
    check_profile(profile)
    keep = raw.columns
    text = F.col("raw")
    envelope = raw.withColumn(
        "_j", F.from_json("raw", _ENVELOPE, {**_STRICT_JSON, "columnNameOfCorruptRecord": "_malformed"})
    ).withColumn("_t", F.from_json("raw", _TYPED, _STRICT_JSON))
    # Arrays and scalars are JSON but no records: only the full parser can tell, and it runs
    # for those few texts alone.
    malformed = F.when(
        F.col("_j._malformed").isNotNull(), F.try_parse_json("raw").isNull()
    ).otherwise(F.lit(False))
    fields = envelope.select(
        *keep,
        malformed.alias("malformed"),
        *[
            F.col(f"_j.{name}").alias(name)
            for name in ("event_id", "patient_id", "event_type", "event_time", "source")
        ],
        F.col("_j.schema_version").alias("schema_version"),
        F.col("_j.source_emit_time").alias("_emit_text"),
        payload_kind(F.col("_t.payload")).alias("payload_kind"),
        F.col("_j.payload").alias("_payload_text"),
        "_t",
    )
    is_nested = F.col("payload_kind").isin("object", "array")
    marked = fields.withColumns(
        {
            "raw_hash": raw_hash(F.coalesce(text, F.lit(""))),
            **{
                name: blank_container(F.col(name), F.col(f"_t.{name}"))
                for name in ("patient_id", "event_id")
            },
            "event_type": F.when(F.col("malformed"), F.lit("unparseable")).otherwise(
                F.col("event_type")
            ),
            "payload": F.when(is_nested, F.col("_t.payload")),
        }
    )
    to_ms = strict_millis if profile == "stream" else lenient_millis
    emit_ms = strict_millis(F.col("_emit_text"))
    event_id = F.when(F.col("malformed"), F.col("raw_hash")).otherwise(F.col("event_id"))
    is_signal = F.col("event_type").isin("vital", "lab")
    valued = marked.withColumns({"event_id": event_id, **payload_values()}).select(
        *keep,
        "malformed",
        "raw_hash",
        "event_id",
        "patient_id",
        "event_type",
        "event_time",
        "source",
        "schema_version",
        "payload",
        "payload_kind",
        "_payload_text",
        to_ms(F.col("event_time")).alias("event_ms"),
        F.when(emit_ms > 0, emit_ms).alias("emit_ms"),
        record_key(F.col("event_id"), F.col("raw_hash")).alias("record_key"),
        "label",
        "number",
        F.when(is_signal, F.col("label")).alias("signal"),
        F.when(is_signal, F.nanvl("number", F.lit(None))).alias("signal_value"),
    )
    settled = settle(valued, [c for c in valued.columns if c not in keep])
    text_of_payload = payload_json(F.col("payload_kind"), F.col("_payload_text"))
    return settled.withColumn("payload_json", text_of_payload).drop("_payload_text")


def settle(df: DataFrame, columns: list[str]) -> DataFrame:
    """The same rows with `columns` passed through a generator.

    The optimizer does not look through a generator. Without it, every later filter or join key
    on a parsed column is spelled out in terms of the record text, which repeats the parsing in
    the plan over and over until it no longer fits in memory.
    """
    others = [c for c in df.columns if c not in columns]
    return df.select(*others, F.inline(F.array(F.struct(*columns)))).select(*df.columns)


def payload_values() -> dict[str, Column]:
    """`label` and `number`: the two payload values the rules look at, by event type."""
    payload = F.col("payload")
    label = blank_container(
        _by_type(_LABEL_KEY, lambda p: F.try_variant_get(payload, p, "string")),
        _by_type(_LABEL_KEY, lambda p: json_part(payload, p)),
    )
    number = _by_type(_NUMBER_KEY, lambda p: F.try_variant_get(payload, p, "double"))
    return {"label": label, "number": number}


def payload_from_text(events: DataFrame) -> DataFrame:
    """Read the payload of stored events back from their `payload_json` text.

    `payload_broken` marks text that is no JSON.
    """
    return events.withColumn("payload", F.try_parse_json("payload_json")).withColumns(
        {
            "payload_broken": F.col("payload_json").isNotNull() & F.col("payload").isNull(),
            **payload_values(),
        }
    )


def number_type() -> Column:
    """JSON type of the payload value that the rules read."""
    payload = F.col("payload")
    return _by_type(_NUMBER_KEY, lambda p: json_type(json_part(payload, p)))


def base_record(events: DataFrame) -> DataFrame:
    """Null-safe projection of parsed events to the stored record fields."""
    return events.withColumns(
        {
            "event_id": F.col("record_key"),
            "payload_json": F.coalesce("payload_json", F.lit("{}")),
            **{
                name: F.coalesce(F.col(name), F.lit(""))
                for name in ("patient_id", "event_type", "event_time", "source")
            },
        }
    )
