"""Keyed streaming operators with durable state."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from evpipe.operators.eventtime import with_event_time
from evpipe.operators.parse import parse_events
from evpipe.operators.route import DUPLICATE, LATE
from evpipe.operators.validate import first_reason, validate
from evpipe.schema import (
    ALERT_COOLDOWN_MS,
    ALERT_LIMITS,
    ALERT_TYPE,
    DEFAULT_LATENESS_SEC,
    RULE_SIGNALS,
)

ROUTED_COLUMNS = (
    "arrival_seq",
    "processed_ms",
    "raw",
    "record_key",
    "patient_id",
    "event_type",
    "event_time",
    "source",
    "payload_json",
    "event_ms",
    "emit_ms",
    "signal",
    "signal_value",
    "errors",
)

ALERT_SCHEMA = T.StructType(
    [
        T.StructField("patient_id", T.StringType()),
        T.StructField("alert_type", T.StringType()),
        T.StructField("alert_time_ms", T.LongType()),
        T.StructField("event_id", T.StringType()),
        T.StructField("arrival_seq", T.LongType()),
        *[T.StructField(name, T.DoubleType()) for name in RULE_SIGNALS],
    ]
)
# Buckets of record keys in the routing state: one call of Python decides a bucket per batch.
STATE_BUCKETS = 1024
_ALERT_STATE = T.StructType(
    [
        *[T.StructField(name, T.DoubleType()) for name in RULE_SIGNALS],
        T.StructField("last_alert_ms", T.LongType()),
    ]
)


def _arrivals(batches: Iterator[pd.DataFrame], columns: list[str]) -> list[tuple]:
    """The rows of a group in order of arrival (the first column).

    Most groups are a row or two, so plain tuples are much cheaper than frame operations.
    """
    rows = []
    for pdf in batches:
        rows.extend(zip(*[pdf[c].tolist() for c in columns], strict=True))
    rows.sort(key=lambda row: row[0])
    return rows


def stream_route(raw: DataFrame, lateness_sec: int = DEFAULT_LATENESS_SEC) -> DataFrame:
    """Route a raw stream by the stream profile; nothing is dropped, late records included.

    The state says which record keys were accepted. It is kept forever, as the contract has it;
    the state store (RocksDB on a cluster) holds one entry per accepted id, under a fixed bucket of
    its key: a call of Python per key costs milliseconds, so each call decides a whole bucket of a
    micro-batch at once. Lateness compares with Spark's watermark, which moves between
    micro-batches. The Python side sees only what decides; the record itself travels in one packed
    column.
    """
    events = with_event_time(validate(parse_events(raw, "stream"), "stream"), lateness_sec)
    record = events.select(*ROUTED_COLUMNS, "event_ts")
    packed_schema = T.StructType([record.schema[c] for c in ROUTED_COLUMNS])
    narrow = record.select(
        F.pmod(F.xxhash64("record_key"), F.lit(STATE_BUCKETS)).alias("bucket"),
        "record_key",
        "arrival_seq",
        "event_ms",
        (F.size("errors") == 0).alias("valid"),
        F.to_json(F.struct(*ROUTED_COLUMNS)).alias("packed"),
        "event_ts",
    )
    allowed = lateness_sec * 1000

    def step(
        key: tuple, batches: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        # The order of arrival decides, so a key's records of one micro-batch come together in its
        # bucket; the trigger limits how many that can be.
        rows = pd.concat(list(batches), ignore_index=True)
        rows = rows.sort_values("arrival_seq", kind="stable", ignore_index=True)
        seen = set(state.get[0]) if state.exists else set()
        watermark = state.getCurrentWatermarkMs()
        keys = rows["record_key"]
        valid = rows["valid"].eq(True).to_numpy()
        # The contract's watermark is a millisecond behind Spark's.
        late = valid & (watermark > 0) & (rows["event_ms"].to_numpy() + allowed < watermark - 1)
        good = (valid & ~late).astype(np.int64)
        # Accepted in an earlier batch, or earlier in this one: a duplicate, in whatever order.
        before = np.array([k in seen for k in keys.tolist()], dtype=bool)
        taken = pd.Series(good).groupby(keys, dropna=False, sort=False).cumsum().to_numpy() - good
        duplicate = before | (taken > 0)
        extra = np.where(duplicate, DUPLICATE, np.where(late, LATE, None))
        new = set(keys[(good > 0) & ~before].tolist())
        if new:
            state.update((list(seen | new),))
        yield pd.DataFrame({"packed": rows["packed"], "extra": pd.Series(extra, dtype=object)})

    decided = narrow.groupBy("bucket").applyInPandasWithState(
        step,
        "packed string, extra string",
        "accepted array<string>",
        "append",
        GroupStateTimeout.NoTimeout,
    )
    unpacked = decided.select(F.from_json("packed", packed_schema).alias("r"), "extra")
    errors = F.concat("r.errors", F.array_compact(F.array("extra")))
    routed = unpacked.withColumn("_errors", errors).select(
        *[f"r.{c}" for c in ROUTED_COLUMNS if c != "errors"], F.col("_errors").alias("errors")
    )
    accepted = F.size("errors") == 0
    reason = F.when(accepted, F.lit("accepted")).otherwise(first_reason(F.col("errors")))
    return routed.withColumns({"accepted": accepted, "reason": reason})


def stream_alerts(accepted: DataFrame, cooldown_ms: int = ALERT_COOLDOWN_MS) -> DataFrame:
    """Alerts of a stream of accepted records: last signal values and last alert per patient."""
    names = list(RULE_SIGNALS)
    narrow = accepted.select(
        F.coalesce("patient_id", F.lit("")).alias("patient_id"),
        "arrival_seq",
        "event_ms",
        F.col("record_key").alias("event_id"),
        # Position of the signal in the state, -1 when it is none of the rule's.
        (F.coalesce(F.array_position(F.array(*map(F.lit, names)), F.col("signal")), F.lit(0)) - 1)
        .cast("int")
        .alias("signal"),
        F.coalesce("signal_value", F.lit(0.0)).alias("signal_value"),
    )
    columns = ["arrival_seq", "event_ms", "event_id", "signal", "signal_value"]
    heart, temp, wbc, lactate = (ALERT_LIMITS[n] for n in names)

    def step(
        key: tuple, batches: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        *values, last = state.get if state.exists else (0.0, 0.0, 0.0, 0.0, None)
        kept = []
        for seq, event_ms, event_id, signal, value in _arrivals(batches, columns):
            if signal >= 0:
                values[signal] = value
            hit = (
                values[0] >= heart
                and values[1] >= temp
                and (values[2] >= wbc or values[3] >= lactate)
            )
            if hit and (last is None or event_ms - last >= cooldown_ms):
                last = event_ms
                kept.append((key[0], ALERT_TYPE, event_ms, event_id, seq, *values))
        state.update((*values, last))
        if kept:
            yield pd.DataFrame(kept, columns=ALERT_SCHEMA.names)

    return narrow.groupBy("patient_id").applyInPandasWithState(
        step, ALERT_SCHEMA, _ALERT_STATE, "append", GroupStateTimeout.NoTimeout
    )
