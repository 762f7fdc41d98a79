"""Keyed serving tables on Parquet.

A table is a folder of parts, `level=<l>/batch_id=<n>`. A batch is written as a part of level 0 and
moved into place in one step; writing it again replaces it, so a replayed micro-batch changes
nothing. Reading keeps the latest row per key: together an upsert that never rewrites old data in
place. When `FANOUT` parts of a level are there, their latest rows become one part of the next level,
named by the last of them, which covers all earlier parts below. So a table of n batches has
logarithmically many parts to read, and each row is rewritten once a level.

Each part is dealt in ranges of its sort columns and sorted: a partitioned table gets files by size
and not by the number of tasks, and a hot partition key is split. For tables read by key the part's
files are listed with their first and last key, so a point read opens the files that can hold the
key, and in them the row groups that can.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evpipe.functions.time import ingest_latency, ts_or_ingest
from evpipe.operators.validate import first_reason
from evpipe.plans.staging import folder_names, publish, remove_path
from evpipe.schema import RULE_SIGNALS

# A batch_id is at least 0, so the column also orders the parts.
_PART = "batch_id"
# Parts of one level that are put together.
FANOUT = 8
_INDEX_SCHEMA = "file string, low string, high string"


@dataclass(frozen=True)
class TableSpec:
    """Key columns, the columns that decide which row of a key is the latest, and the layout.

    `index` is the text column by which single keys are read; it leads `sort`.
    """

    name: str
    keys: tuple[str, ...]
    order: tuple[str, ...]
    partition: str | None = None
    sort: tuple[str, ...] = ()
    schema: str = ""
    index: str | None = None


EVENTS_BY_ID = TableSpec(
    "events_by_id",
    ("event_id",),
    ("processed_at",),
    None,
    ("event_id",),
    "event_id string, patient_id string, event_type string, event_time timestamp, source string, "
    "payload string, patient_metadata string, ingestion_latency_ms double, raw_event string, "
    "processed_at timestamp",
    "event_id",
)
EVENTS_BY_TYPE = TableSpec(
    "events_by_type",
    ("event_type", "event_id"),
    ("arrival_seq",),
    "event_type",
    ("event_type", "event_id"),
    "event_id string, patient_id string, event_time timestamp, arrival_seq bigint, "
    "event_type string",
)
QUARANTINE_BY_REASON = TableSpec(
    "quarantine_by_reason",
    ("reason", "observed_at", "event_id"),
    ("arrival_seq",),
    "reason",
    ("reason", "observed_at", "event_id"),
    "observed_at timestamp, event_id string, errors array<string>, raw_event string, "
    "arrival_seq bigint, reason string",
)
ALERTS_BY_PATIENT = TableSpec(
    "alerts_by_patient",
    ("patient_id", "alert_time"),
    ("arrival_seq",),
    None,
    ("patient_id", "alert_time"),
    "patient_id string, alert_time timestamp, alert_type string, details string, "
    "arrival_seq bigint",
    "patient_id",
)
ALERTS_BY_TYPE = TableSpec(
    "alerts_by_type",
    ("alert_type", "alert_time", "patient_id"),
    ("arrival_seq",),
    "alert_type",
    ("alert_type", "alert_time", "patient_id"),
    "patient_id string, alert_time timestamp, details string, arrival_seq bigint, "
    "alert_type string",
)


# Ids that a run has accepted, for the runs and micro-batches after it.
ACCEPTED_IDS = TableSpec(
    "accepted_ids", ("event_id",), (), None, ("event_id",), "event_id string", "event_id"
)

# What a patient's later alerts depend on.
PATIENT_STATE = TableSpec(
    "patient_state", ("patient_id",), (), None, ("patient_id",),
    "patient_id string, " + ", ".join(f"{n} double" for n in RULE_SIGNALS) + ", last_alert_ms bigint",
)

ALL_TABLES = (
    EVENTS_BY_ID, EVENTS_BY_TYPE, QUARANTINE_BY_REASON, ALERTS_BY_PATIENT, ALERTS_BY_TYPE
)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key, as an aggregate: repeated keys shrink before the exchange."""
    values = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*values), F.struct(*order))
    grouped = df.groupBy(*keys).agg(last.alias("_row"))
    return grouped.select(*keys, "_row.*").select(*df.columns)


def _place(root: str, spec: TableSpec, level: int, batch_id: int, index: bool = False) -> str:
    return f"{root}/{spec.name}{'_index' if index else ''}/level={level}/{_PART}={batch_id}"


def upsert(df: DataFrame, root: str, spec: TableSpec, batch_id: int = 0) -> None:
    """Merge the levels that are full, and write `df` as one part of the table under `root`.

    In this order the newest part is never merged yet: its micro-batch may still be run again.
    """
    _merge_levels(df.sparkSession, root, spec, batch_id)
    _write_part(df, root, spec, 0, batch_id)


def _write_part(df: DataFrame, root: str, spec: TableSpec, level: int, batch_id: int) -> None:
    spark = df.sparkSession
    columns = [c.split()[0] for c in spec.schema.split(", ")]
    # Ranges are found by a sample first; what leads here is worked out only once.
    rows = df.select(*columns).persist(StorageLevel.DISK_ONLY)
    written = f"{root}/{spec.name}/_writing-{uuid.uuid4().hex}"
    try:
        ordered = rows.repartitionByRange(*spec.sort).sortWithinPartitions(*spec.sort)
        writer = ordered.write.mode("overwrite")
        if spec.partition:
            writer = writer.partitionBy(spec.partition)
        writer.parquet(written)
    finally:
        rows.unpersist()
    if spec.index:
        stored = spark.read.schema(spec.schema).parquet(written)
        files = stored.groupBy(F.col("_metadata.file_name").alias("file")).agg(
            F.min(spec.index).alias("low"), F.max(spec.index).alias("high")
        )
        # One short row for each file of the part.
        place = _place(root, spec, level, batch_id, index=True)
        files.coalesce(1).write.mode("overwrite").parquet(place)
    publish(spark, written, _place(root, spec, level, batch_id))


def _numbers(spark: SparkSession, folder: str, name: str) -> list[int]:
    prefix = f"{name}="
    return sorted(int(n[len(prefix) :]) for n in folder_names(spark, folder) if n.startswith(prefix))


def _all_parts(spark: SparkSession, root: str, spec: TableSpec) -> list[tuple[int, int]]:
    """All stored parts as (level, batch_id)."""
    folder = f"{root}/{spec.name}"
    return [
        (level, batch)
        for level in _numbers(spark, folder, "level")
        for batch in _numbers(spark, f"{folder}/level={level}", _PART)
    ]


def _current(parts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The parts that no part of a higher level covers."""
    return [
        (level, batch) for level, batch in parts
        if not any(above > level and last >= batch for above, last in parts)
    ]


def _remove_part(spark: SparkSession, root: str, spec: TableSpec, part: tuple[int, int]) -> None:
    for index in (False, True):
        remove_path(spark, _place(root, spec, *part, index=index))


def _merge_levels(spark: SparkSession, root: str, spec: TableSpec, batch_id: int) -> None:
    """Put the parts before a micro-batch together, the lowest full level first.

    Covered parts stay until the next merge, for readers that have begun with them.
    """
    level = 0
    while True:
        parts = _all_parts(spark, root, spec)
        current = _current(parts)
        full = [part for part in current if part[0] == level and part[1] < batch_id]
        if len(full) < FANOUT:
            return
        for part in set(parts) - set(current):
            _remove_part(spark, root, spec, part)
        rows = latest_per_key(_read(spark, root, spec, full), spec.keys, (_PART, *spec.order))
        _write_part(rows, root, spec, level + 1, full[-1][1])
        level += 1


def _read(
    spark: SparkSession, root: str, spec: TableSpec, parts: list[tuple[int, int]],
    files: list[str] | None = None,
) -> DataFrame:
    """The rows of parts, or of files in them. The schema is declared, so a table without rows
    reads as one."""
    schema = f"{spec.schema}, level int, {_PART} bigint"
    paths = files or [_place(root, spec, *part) for part in parts]
    if not paths:
        return spark.createDataFrame([], schema).drop("level")
    reader = spark.read.schema(schema).option("basePath", f"{root}/{spec.name}")
    return reader.parquet(*paths).drop("level")


def read_table(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    """The current rows: the latest per key over all parts."""
    parts = read_parts(spark, root, spec)
    return latest_per_key(parts, spec.keys, (_PART, *spec.order)).drop(_PART)


def read_parts(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    """The rows of all current parts, with the part's number."""
    return _read(spark, root, spec, _current(_all_parts(spark, root, spec)))


def read_key(spark: SparkSession, root: str, spec: TableSpec, value: str) -> DataFrame:
    """The current rows whose index column is `value`, from the files that can hold it."""
    parts = _current(_all_parts(spark, root, spec))
    places = [_place(root, spec, *part, index=True) for part in parts]
    if not places:
        return _read(spark, root, spec, []).drop(_PART)
    schema = f"{_INDEX_SCHEMA}, level int, {_PART} bigint"
    index = spark.read.schema(schema).option("basePath", f"{root}/{spec.name}_index").parquet(*places)
    # Ranges of one part meet at their ends only, so this is a file or two of each part.
    held = index.filter((F.col("low") <= value) & (F.col("high") >= value)).collect()
    files = [f"{_place(root, spec, r['level'], r[_PART])}/{r['file']}" for r in held]
    rows = _read(spark, root, spec, [], files).filter(F.col(spec.index) == value)
    return latest_per_key(rows, spec.keys, (_PART, *spec.order)).drop(_PART)


def next_batch_id(spark: SparkSession, root: str, spec: TableSpec) -> int:
    """One more than the highest part that is stored, 0 for a table that isn't there."""
    return max((batch for _, batch in _all_parts(spark, root, spec)), default=-1) + 1


def begin_run(spark: SparkSession, root: str, spec: TableSpec, keep: bool) -> int:
    """The part a run writes: the next one, or the first of a table that starts afresh."""
    if keep:
        return next_batch_id(spark, root, spec)
    for name in (spec.name, f"{spec.name}_index"):
        remove_path(spark, f"{root}/{name}")
    return 0


def compact(spark: SparkSession, root: str, spec: TableSpec) -> None:
    """Put the current rows into one new part of a level of its own and remove the others.

    Until the old parts are gone a reader sees rows twice and keeps the latest, as always.
    """
    parts = _all_parts(spark, root, spec)
    if not parts:
        return
    last = max(batch for _, batch in parts) + 1
    _write_part(read_table(spark, root, spec), root, spec, max(level for level, _ in parts) + 1, last)
    for part in parts:
        _remove_part(spark, root, spec, part)


def parts_before(
    spark: SparkSession, root: str, spec: TableSpec, batch_id: int
) -> DataFrame | None:
    """The rows of the parts that were there before a micro-batch, None when there are none.

    Parts of this number or above are left from a run that ended before its micro-batch did.
    """
    parts = [part for part in _current(_all_parts(spark, root, spec)) if part[1] < batch_id]
    return _read(spark, root, spec, parts) if parts else None


def read_before(
    spark: SparkSession, root: str, spec: TableSpec, batch_id: int
) -> DataFrame | None:
    """The current rows as they were before a micro-batch, None when there are none."""
    rows = parts_before(spark, root, spec, batch_id)
    if rows is None:
        return None
    return latest_per_key(rows, spec.keys, (_PART, *spec.order)).drop(_PART)


def _millis(column: str):
    return F.timestamp_millis(column)


def events_by_id_rows(accepted: DataFrame) -> DataFrame:
    when = ts_or_ingest(F.col("event_ms"), F.col("processed_ms"))
    return accepted.select(
        F.col("record_key").alias("event_id"),
        F.coalesce("patient_id", F.lit("")).alias("patient_id"),
        F.coalesce("event_type", F.lit("")).alias("event_type"),
        F.timestamp_millis(when).alias("event_time"),
        F.coalesce("source", F.lit("")).alias("source"),
        F.col("payload_json").alias("payload"),
        "patient_metadata",
        ingest_latency(F.col("processed_ms"), F.col("emit_ms")).alias("ingestion_latency_ms"),
        F.col("raw").alias("raw_event"),
        _millis("processed_ms").alias("processed_at"),
    )


def events_by_type_rows(accepted: DataFrame) -> DataFrame:
    when = ts_or_ingest(F.col("event_ms"), F.col("processed_ms"))
    return accepted.select(
        F.coalesce("event_type", F.lit("")).alias("event_type"),
        F.col("record_key").alias("event_id"),
        F.coalesce("patient_id", F.lit("")).alias("patient_id"),
        F.timestamp_millis(when).alias("event_time"),
        "arrival_seq",
    )


def quarantine_rows(quarantined: DataFrame) -> DataFrame:
    return quarantined.select(
        first_reason(F.col("errors")).alias("reason"),
        _millis("processed_ms").alias("observed_at"),
        F.col("record_key").alias("event_id"),
        "errors",
        F.col("raw").alias("raw_event"),
        "arrival_seq",
    )


def alert_rows(alerts: DataFrame, details) -> DataFrame:
    return alerts.select(
        "patient_id",
        _millis("alert_time_ms").alias("alert_time"),
        "alert_type",
        details.alias("details"),
        "arrival_seq",
    )


def upsert_events_by_id(accepted: DataFrame, root: str, batch_id: int = 0) -> None:
    upsert(events_by_id_rows(accepted), root, EVENTS_BY_ID, batch_id)


def upsert_events_by_type(accepted: DataFrame, root: str, batch_id: int = 0) -> None:
    upsert(events_by_type_rows(accepted), root, EVENTS_BY_TYPE, batch_id)


def upsert_quarantine(quarantined: DataFrame, root: str, batch_id: int = 0) -> None:
    upsert(quarantine_rows(quarantined), root, QUARANTINE_BY_REASON, batch_id)


def upsert_alerts_by_patient(alerts: DataFrame, root: str, batch_id: int = 0) -> None:
    upsert(alerts, root, ALERTS_BY_PATIENT, batch_id)


def upsert_alerts_by_type(alerts: DataFrame, root: str, batch_id: int = 0) -> None:
    upsert(alerts, root, ALERTS_BY_TYPE, batch_id)


def insert_if_absent(
    new: DataFrame, stored: DataFrame | None, key: str = "event_id", order: str = "arrival_seq"
) -> tuple[DataFrame, DataFrame]:
    """(rows to append, conflicts): the first new row per key goes in unless the key is stored."""
    first = new.groupBy(key).agg(F.min(order).alias("_first"))
    if stored is not None:
        first = first.join(stored.select(key), key, "left_anti")
    # One row per key and arrival: no key is repeated on the right.
    chosen = first.select(F.col("_first").alias(order))
    return new.join(chosen, order, "left_semi"), new.join(chosen, order, "left_anti")
