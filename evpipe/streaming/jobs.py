"""The streaming run: three queries linked by an exactly-once log of routed records.

1. raw source -> routing -> routed log, one folder for each micro-batch
2. routed log -> topics and serving tables
3. routed log -> alerts -> alert topic and tables

All work on whole micro-batches with the batch operators, and what they carry over (largest event
time, accepted ids, last values of patients) are tables of their own, written under the number of the
micro-batch: a replay replaces them. Each query has its own checkpoint and resumes after a failure. A
micro-batch of the log is published by one rename and never again, so queries 2 and 3 never see a
record twice; the topics are at least once when they go to Kafka.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from evpipe.functions.time import ingest_latency
from evpipe.operators.alerts import alert_details, alerts_with_cooldown, patient_state
from evpipe.operators.enrich import enrich
from evpipe.operators.eventtime import event_ts_ms
from evpipe.operators.parse import parse_events
from evpipe.operators.prefix import dense_positions
from evpipe.operators.route import route_local, route_micro_batch
from evpipe.operators.skew import find_hot_patients
from evpipe.operators.validate import validate
from evpipe.plans.staging import (
    folder_names, make_folder, new_path, path_exists, publish, remove_path, shared_dir, stage,
)
from evpipe.schema import ALERT_COOLDOWN_MS, DEFAULT_LATENESS_SEC
from evpipe.sinks import files, tables
from evpipe.sources.readers import by_broker_time, number_arrivals, spread
from evpipe.streaming.stateful import stream_route

_ROUTED_SCHEMA = (
    "arrival_seq bigint, processed_ms bigint, raw string, record_key string, patient_id string, "
    "event_type string, event_time string, source string, payload_json string, event_ms bigint, "
    "emit_ms bigint, signal string, signal_value double, errors array<string>, accepted boolean, "
    "reason string, order_seq bigint"
)


_LOCAL_SCHEMA = (
    "arrival_seq bigint, order_seq bigint, processed_ms bigint, raw string, event_id string, "
    "patient_id string, event_type string, event_ms bigint, emit_ms bigint, signal string, "
    "signal_value double, errors array<string>, accepted boolean, reason string"
)
_ROUTED_COLUMNS = [c.split()[0] for c in _ROUTED_SCHEMA.split(", ")]
# Micro-batches whose largest time is kept.
TIMES_KEPT = 100


@dataclass
class StreamJob:
    """Where a streaming run reads its dimension and writes its outputs."""

    root: str
    checkpoints: str
    lateness_sec: int = DEFAULT_LATENESS_SEC
    cooldown_ms: int = ALERT_COOLDOWN_MS
    trigger: dict = field(default_factory=lambda: {"processingTime": "10 seconds"})
    topics: dict[str, dict[str, str]] = field(default_factory=dict)

    def topic(self, name: str) -> dict[str, str]:
        """Target of a topic: as configured, else text files under the root."""
        return self.topics.get(name) or {"format": "text", "path": f"{self.root}/topics/{name}"}

    @property
    def routed_path(self) -> str:
        return f"{self.root}/routed"

    @property
    def local_path(self) -> str:
        return f"{self.root}/local_routed"

    @property
    def times_path(self) -> str:
        return f"{self.root}/times"


def checkpoint_root(spark: SparkSession, name: str) -> str:
    """Checkpoint folder of a named run in the cluster's shared folder."""
    return f"{shared_dir(spark)}/evpipe/streams/{name}"


def _last_before(spark: SparkSession, folder: str, batch_id: int) -> int | None:
    """The last micro-batch before this one that stored its part in `folder`."""
    parts = [int(n.split("=")[1]) for n in folder_names(spark, folder) if n.startswith("batch_id=")]
    return max((p for p in parts if p < batch_id), default=None)


def carried_time(spark: SparkSession, folder: str, batch_id: int) -> int | None:
    """The largest time of all micro-batches before this one: each stores it, so one row is read."""
    last = _last_before(spark, folder, batch_id)
    if last is None:
        return None
    stored = spark.read.schema("max_event_ms bigint").parquet(f"{folder}/batch_id={last}")
    return stored.first()[0]


def store_time(
    spark: SparkSession, folder: str, batch_id: int, now: DataFrame, carried: int | None
) -> None:
    """Store the largest time up to and with this micro-batch; `now` has one row with its own."""
    largest = F.greatest(F.col("max_event_ms"), F.lit(carried).cast("bigint"))
    row = now.select(largest.alias("max_event_ms"))
    row.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")
    # A restart goes back by one micro-batch; older rows are of no use.
    for name in folder_names(spark, folder):
        if name.startswith("batch_id=") and int(name.split("=")[1]) < batch_id - TIMES_KEPT:
            remove_path(spark, f"{folder}/{name}")


def in_arrival_order(batch: DataFrame) -> DataFrame:
    """One micro-batch with unique numbers in the order of arrival, as a staged table.

    Messages of a topic are merged over its partitions by broker time. The source's own number stays
    as `_source_seq`. Staged, since the numbers must not change when the batch is read again.
    """
    order = ("arrival_seq", "processed_ms")
    if {"partition", "offset"} <= set(batch.columns):
        batch, order = by_broker_time(batch), ("broker_ms", "partition", "offset")
    sourced = batch.withColumn("_source_seq", F.col("arrival_seq"))
    return stage(number_arrivals(sourced, *order).drop("broker_ms"), "numbered")


def _order_seq(rows: DataFrame, batch_id: int, numbered: bool) -> DataFrame:
    """Add `order_seq`, which rises over all micro-batches: the source's number, or for numbered rows
    the micro-batch and the place in it (2^27 micro-batches of 2^36 records)."""
    if not numbered:
        return rows.withColumn("order_seq", F.col("_source_seq"))
    placed = dense_positions(rows, "arrival_seq", "_place")
    return placed.withColumn("order_seq", F.col("_place") + F.lit(batch_id << 36))


def _accepted_before(spark: SparkSession, job: StreamJob, batch_id: int) -> DataFrame | None:
    """The ids that earlier micro-batches accepted, each once: a key is accepted only once."""
    parts = tables.parts_before(spark, job.root, tables.ACCEPTED_IDS, batch_id)
    return None if parts is None else parts.select("event_id")


def route_batch(batch: DataFrame, batch_id: int, job: StreamJob) -> None:
    """Stream profile: route one micro-batch where the one before left off, with no Python per record.

    The largest event time and the ids accepted so far are tables under the job's root. They are
    written under the number of the micro-batch before its routed records are published in one step;
    a replay of a published one has nothing to do, and any other replaces what it had stored.
    """
    spark = batch.sparkSession
    published = f"{job.routed_path}/batch_id={batch_id}"
    if path_exists(spark, published):
        return
    # Numbers of a topic's partitions don't compare, those of lines are not unique.
    ordered = bool({"partition", "unnumbered"} & set(batch.columns))
    raw = in_arrival_order(batch) if ordered else batch.withColumn("_source_seq", F.col("arrival_seq"))
    checked = validate(parse_events(spread(raw), "stream"), "stream")
    checked = checked.withColumn("_ts", event_ts_ms("stream")).persist(StorageLevel.DISK_ONLY)
    try:
        carried = carried_time(spark, job.times_path, batch_id)
        seen = _accepted_before(spark, job, batch_id)
        if seen is not None:
            seen = seen.withColumnRenamed("event_id", "record_key")
        routed = route_micro_batch(checked, job.lateness_sec, carried, seen)
        columns = [F.col("_source_seq").alias("arrival_seq"), *_ROUTED_COLUMNS[1:]]
        written = new_path(spark, "routed")
        _order_seq(routed, batch_id, ordered).select(*columns).write.parquet(written)
        done = spark.read.schema(_ROUTED_SCHEMA).parquet(written)
        ids = done.filter("accepted").select(F.col("record_key").alias("event_id"))
        tables.upsert(ids, job.root, tables.ACCEPTED_IDS, batch_id)
        now = checked.agg(F.max("_ts").alias("max_event_ms"))
        store_time(spark, job.times_path, batch_id, now, carried)
        publish(spark, written, published)
    finally:
        checked.unpersist()


def start_routing(raw: DataFrame, job: StreamJob) -> StreamingQuery:
    return (
        raw.writeStream.foreachBatch(lambda batch, i: route_batch(batch, i, job))
        .option("checkpointLocation", f"{job.checkpoints}/routing")
        .trigger(**job.trigger)
        .start()
    )


def start_stateful_routing(raw: DataFrame, job: StreamJob) -> StreamingQuery:
    """The same as one stateful operator with Spark's own watermark and state store, for streams of
    few records that need no tables beside the checkpoint."""
    routed = stream_route(raw, job.lateness_sec).withColumn("order_seq", F.col("arrival_seq"))
    return (
        routed.writeStream.format("parquet")
        .option("path", job.routed_path)
        .option("checkpointLocation", f"{job.checkpoints}/routing")
        .outputMode("append")
        .trigger(**job.trigger)
        .start()
    )


def _routed_stream(spark: SparkSession, job: StreamJob) -> DataFrame:
    """The published records of each micro-batch; the folder is there before the first of them."""
    make_folder(spark, job.routed_path)
    reader = spark.readStream.schema(_ROUTED_SCHEMA).option("recursiveFileLookup", "true")
    return reader.parquet(job.routed_path)


def run_fanout(batch: DataFrame, batch_id: int, dim: DataFrame | None, job: StreamJob) -> None:
    """Write one batch of routed records to the topics and tables."""
    latency = ingest_latency(F.col("processed_ms"), F.col("emit_ms"))
    timed = batch.withColumn("ingestion_latency_ms", latency)
    # Without a dimension there is no join that a hot patient could fill.
    hot = None if dim is None else find_hot_patients(batch.filter("accepted"))
    records = enrich(timed, dim, F.col("accepted"), hot).persist(StorageLevel.DISK_ONLY)
    try:
        accepted = records.filter("accepted")
        rejected = records.filter("not accepted")
        files.write_valid(accepted, job.topic("valid"), batch_id)
        files.write_quarantine(rejected, job.topic("quarantine"), batch_id)
        tables.upsert_events_by_id(accepted, job.root, batch_id)
        tables.upsert_events_by_type(accepted, job.root, batch_id)
        tables.upsert_quarantine(rejected, job.root, batch_id)
    finally:
        records.unpersist()


def start_fanout(spark: SparkSession, dim: DataFrame | None, job: StreamJob) -> StreamingQuery:
    return (
        _routed_stream(spark, job)
        .writeStream.foreachBatch(lambda batch, i: run_fanout(batch, i, dim, job))
        .option("checkpointLocation", f"{job.checkpoints}/fanout")
        .trigger(**job.trigger)
        .start()
    )


def alert_batch(batch: DataFrame, batch_id: int, job: StreamJob) -> None:
    """Alerts of one micro-batch of accepted records, with the batch operators.

    What earlier micro-batches left behind comes from a keyed table: of each patient the last signal
    values and the last alert. Only patients of this micro-batch are read and written, and a patient
    with very many records in it is cut into bounded pieces like anywhere else.
    """
    spark = batch.sparkSession
    # Alerts, state and the count of hot patients all read it.
    events = batch.select(
        F.coalesce("patient_id", F.lit("")).alias("patient_id"),
        F.col("order_seq").alias("arrival_seq"), "event_ms", "record_key", "signal", "signal_value",
    ).persist(StorageLevel.DISK_ONLY)
    alerts = None
    try:
        carried = tables.read_before(spark, job.root, tables.PATIENT_STATE, batch_id)
        if carried is not None:
            own = events.select("patient_id").distinct()
            carried = stage(carried.join(own, "patient_id", "left_semi"), "carried")
        alerts = alerts_with_cooldown(events, job.cooldown_ms, "find", carried)
        alerts = alerts.persist(StorageLevel.DISK_ONLY)
        rows = tables.alert_rows(alerts, alert_details())
        files.write_alerts(alerts, alert_details(), job.topic("alerts"), batch_id)
        tables.upsert_alerts_by_patient(rows, job.root, batch_id)
        tables.upsert_alerts_by_type(rows, job.root, batch_id)
        state = patient_state(events, alerts, carried)
        tables.upsert(state, job.root, tables.PATIENT_STATE, batch_id)
    finally:
        events.unpersist()
        if alerts is not None:
            alerts.unpersist()


def start_alerts(spark: SparkSession, job: StreamJob) -> StreamingQuery:
    accepted = _routed_stream(spark, job).filter("accepted")
    return (
        accepted.writeStream.foreachBatch(lambda batch, i: alert_batch(batch, i, job))
        .option("checkpointLocation", f"{job.checkpoints}/alerts")
        .trigger(**job.trigger)
        .start()
    )


def start_run(
    spark: SparkSession, raw: DataFrame, dim: DataFrame | None, job: StreamJob
) -> list[StreamingQuery]:
    """Start all three queries. With an `availableNow` trigger they run one after the other."""
    starts = [
        lambda: start_routing(raw, job),
        lambda: start_fanout(spark, dim, job),
        lambda: start_alerts(spark, job),
    ]
    return _started(job, starts)


def _started(job: StreamJob, starts: list) -> list[StreamingQuery]:
    queries = []
    for start in starts:
        query = start()
        queries.append(query)
        if job.trigger.get("availableNow"):
            query.awaitTermination()
    return queries


def route_local_batch(batch: DataFrame, batch_id: int, job: StreamJob) -> None:
    """Local profile, exact per record: route one micro-batch where the one before left off.

    As `route_batch`, with the running maximum of event time within the micro-batch as well.
    """
    spark = batch.sparkSession
    published = f"{job.local_path}/batch_id={batch_id}"
    if path_exists(spark, published):
        return
    numbered = in_arrival_order(batch)
    checked = validate(parse_events(spread(numbered), "local"), "local")
    checked = checked.persist(StorageLevel.DISK_ONLY)
    try:
        carried = carried_time(spark, job.times_path, batch_id)
        seen = _accepted_before(spark, job, batch_id)
        routed = route_local(checked, job.lateness_sec, max_event_ms=carried, seen=seen)
        routed = _order_seq(routed, batch_id, True)
        # The numbers decide within the micro-batch; what is stored has the source's own.
        routed = routed.withColumn("arrival_seq", F.col("_source_seq")).drop("_source_seq", "_place")
        written = new_path(spark, "routed")
        routed.write.parquet(written)
        done = spark.read.schema(routed.schema).parquet(written)
        ids = done.filter("accepted").select(F.coalesce("event_id", F.lit("None")).alias("event_id"))
        tables.upsert(ids, job.root, tables.ACCEPTED_IDS, batch_id)
        now = done.agg(F.max("max_event_ms").alias("max_event_ms"))
        store_time(spark, job.times_path, batch_id, now, carried)
        publish(spark, written, published)
    finally:
        checked.unpersist()


def local_output_batch(batch: DataFrame, batch_id: int, job: StreamJob) -> None:
    """Accepted events, quarantine and counters of one micro-batch, as parts that a replay replaces."""
    part = f"batch_id={batch_id}"
    records = batch.persist(StorageLevel.DISK_ONLY)
    try:
        rejected = records.filter("not accepted")
        files.replace_events(records.filter("accepted"), f"{job.root}/events/{part}")
        files.replace_quarantine(rejected, f"{job.root}/quarantine/{part}", f"{job.root}/quarantine_jsonl/{part}")
        latency = ingest_latency(F.col("processed_ms"), F.col("emit_ms"))
        counted = records.withColumn("ingestion_latency_ms", latency)
        counted.groupBy("reason").agg(
            F.count(F.lit(1)).alias("n"), F.max("ingestion_latency_ms").alias("max_latency_ms")
        ).write.mode("overwrite").parquet(f"{job.root}/counts/{part}")
    finally:
        records.unpersist()


def start_local_routing(raw: DataFrame, job: StreamJob) -> StreamingQuery:
    return (
        raw.writeStream.foreachBatch(lambda batch, i: route_local_batch(batch, i, job))
        .option("checkpointLocation", f"{job.checkpoints}/local")
        .trigger(**job.trigger)
        .start()
    )


def _local_stream(spark: SparkSession, job: StreamJob) -> DataFrame:
    make_folder(spark, job.local_path)
    reader = spark.readStream.schema(_LOCAL_SCHEMA).option("recursiveFileLookup", "true")
    return reader.parquet(job.local_path)


def start_local_outputs(spark: SparkSession, job: StreamJob) -> StreamingQuery:
    return (
        _local_stream(spark, job)
        .writeStream.foreachBatch(lambda batch, i: local_output_batch(batch, i, job))
        .option("checkpointLocation", f"{job.checkpoints}/local_outputs")
        .trigger(**job.trigger)
        .start()
    )


def start_local_alerts(spark: SparkSession, job: StreamJob) -> StreamingQuery:
    named = F.coalesce("event_id", F.lit("None")).alias("record_key")
    accepted = _local_stream(spark, job).filter("accepted").select(
        "patient_id", "order_seq", "event_ms", named, "signal", "signal_value"
    )
    return (
        accepted.writeStream.foreachBatch(lambda batch, i: alert_batch(batch, i, job))
        .option("checkpointLocation", f"{job.checkpoints}/alerts")
        .trigger(**job.trigger)
        .start()
    )


def start_local_run(spark: SparkSession, raw: DataFrame, job: StreamJob) -> list[StreamingQuery]:
    """The local profile's three queries, linked like those of the stream profile."""
    return _started(
        job,
        [
            lambda: start_local_routing(raw, job),
            lambda: start_local_outputs(spark, job),
            lambda: start_local_alerts(spark, job),
        ],
    )
