"""Registered queries over streams: several micro-batches, late records, restarts, topics."""

from __future__ import annotations

from pyspark.sql import functions as F

from evpipe.operators.enrich import patient_metadata
from evpipe.plans.catalog import COOLDOWN_MS, LATENESS_SEC, query
from evpipe.plans.oracle import DROP_NUMBERS, DROPS, STRAGGLER, over
from evpipe.plans.staging import new_path
from evpipe.sinks import tables
from evpipe.sources.fixtures import patients, raw_events
from evpipe.sources.readers import read_raw_stream
from evpipe.streaming import jobs

# Files of a drop: a micro-batch takes as many, so it takes one drop.
DROP_FILES = 4
RAW = ("arrival_seq", "raw", "processed_ms")


def _job(spark, name="stream"):
    root = new_path(spark, name)
    once = {"availableNow": True}
    return jobs.StreamJob(f"{root}/out", f"{root}/checkpoints", LATENESS_SEC, COOLDOWN_MS, once), root


def _drop(spark, sf, folder, numbers, stragglers=True):
    """All events in order of arrival, cut into drops of files; writes some of the drops. Stragglers
    come one drop later, behind what has moved the watermark."""
    raw = raw_events(spark, sf).select(*RAW)
    n = raw.count()
    drop = F.lit(0)
    for i in range(1, DROPS):
        drop = drop + (F.col("arrival_seq") >= n * i // DROPS).cast("int")
    if stragglers:
        drop = F.least(F.lit(DROPS - 1), drop + F.expr(STRAGGLER).cast("int"))
    placed = raw.withColumn("drop", drop)
    if stragglers:
        number = F.col("drop") * F.lit(DROP_NUMBERS) + F.col("arrival_seq")
        placed = placed.withColumn("arrival_seq", number)
    for i in numbers:
        own = placed.filter(F.col("drop") == i).drop("drop")
        own.repartition(DROP_FILES).write.mode("append").parquet(folder)


def _source(spark, folder):
    options = {"path": folder, "maxFilesPerTrigger": str(DROP_FILES)}
    return read_raw_stream(spark, "parquet", options)


def _one_batch(spark, sf):
    """All events as one file drop, and a job that reads what is there and ends."""
    job, root = _job(spark)
    raw_events(spark, sf).select(*RAW).write.parquet(f"{root}/in")
    return job, read_raw_stream(spark, "parquet", {"path": f"{root}/in"})


def _batches(spark, sf, stragglers=True):
    job, root = _job(spark)
    _drop(spark, sf, f"{root}/in", range(DROPS), stragglers)
    return job, _source(spark, f"{root}/in")


def _outcome(spark, job):
    return spark.read.parquet(job.routed_path).select("arrival_seq", "accepted", "reason")


@query(over("routed_nolate", "SELECT arrival_seq, accepted, reason FROM routed_nolate"))
def stream_route(spark, sf):
    job, raw = _one_batch(spark, sf)
    jobs.start_routing(raw, job).awaitTermination()
    return _outcome(spark, job)


@query(over("routed_batches", "SELECT arrival_seq, accepted, reason FROM routed_batches"))
def stream_route_batches(spark, sf):
    """Late records against the watermark of each micro-batch, ids carried from batch to batch."""
    job, raw = _batches(spark, sf)
    jobs.start_routing(raw, job).awaitTermination()
    return _outcome(spark, job)


@query(over("routed_batches", "SELECT arrival_seq, accepted, reason FROM routed_batches"))
def stream_watermark(spark, sf):
    """The same by Spark's watermark and state store, in one stateful operator."""
    job, raw = _batches(spark, sf)
    jobs.start_stateful_routing(raw, job).awaitTermination()
    return _outcome(spark, job)


@query(over("routed_batches", "SELECT arrival_seq, accepted, reason FROM routed_batches"))
def stream_resume(spark, sf):
    """Stopped after two micro-batches and started again on the same checkpoints."""
    job, root = _job(spark)
    for part in (range(2), range(2, DROPS)):
        _drop(spark, sf, f"{root}/in", part)
        jobs.start_routing(_source(spark, f"{root}/in"), job).awaitTermination()
    return _outcome(spark, job)


def _raised(spark, job):
    stored = tables.read_table(spark, job.root, tables.ALERTS_BY_PATIENT)
    return stored.select(
        "patient_id", F.unix_millis("alert_time").alias("alert_ms"), "alert_type"
    )


_ALERTS = "SELECT patient_id, event_time_ms AS alert_ms, alert_type FROM {}"


@query(over("alerts_nolate", _ALERTS.format("alerts_nolate")))
def stream_alerts(spark, sf):
    job, raw = _one_batch(spark, sf)
    jobs.start_routing(raw, job).awaitTermination()
    jobs.start_alerts(spark, job).awaitTermination()
    return _raised(spark, job)


@query(over("alerts_batches", _ALERTS.format("alerts_batches")))
def stream_alerts_batches(spark, sf):
    """Signal values and cool-downs carried over micro-batches and a restart of all queries."""
    job, root = _job(spark)
    dim = patient_metadata(patients(spark, sf))
    for part in (range(3), range(3, DROPS)):
        _drop(spark, sf, f"{root}/in", part)
        jobs.start_run(spark, _source(spark, f"{root}/in"), dim, job)
    return _raised(spark, job)


_FANOUT = "SELECT event_id, event_type FROM {} WHERE accepted"


@query(over("routed_nolate", _FANOUT.format("routed_nolate")))
def run_fanout(spark, sf):
    job, raw = _one_batch(spark, sf)
    dim = patient_metadata(patients(spark, sf))
    jobs.start_routing(raw, job).awaitTermination()
    jobs.start_fanout(spark, dim, job).awaitTermination()
    return tables.read_table(spark, job.root, tables.EVENTS_BY_ID).select("event_id", "event_type")


@query(over("routed_batches", _FANOUT.format("routed_batches")))
def run_fanout_batches(spark, sf):
    """Routing and fan-out in turns, so that the fan-out sees several micro-batches too."""
    job, root = _job(spark)
    dim = patient_metadata(patients(spark, sf))
    for i in range(DROPS):
        _drop(spark, sf, f"{root}/in", [i])
        jobs.start_routing(_source(spark, f"{root}/in"), job).awaitTermination()
        jobs.start_fanout(spark, dim, job).awaitTermination()
    return tables.read_table(spark, job.root, tables.EVENTS_BY_ID).select("event_id", "event_type")


_LOCAL = "SELECT arrival_seq, accepted, reason FROM routed_local"


def _local_outcome(spark, job):
    return spark.read.parquet(job.local_path).select("arrival_seq", "accepted", "reason")


@query(over("routed_local", _LOCAL))
def stream_route_local(spark, sf):
    job, raw = _one_batch(spark, sf)
    jobs.start_local_routing(raw, job).awaitTermination()
    return _local_outcome(spark, job)


@query(over("routed_local", _LOCAL))
def stream_route_local_batches(spark, sf):
    job, raw = _batches(spark, sf, stragglers=False)
    jobs.start_local_routing(raw, job).awaitTermination()
    return _local_outcome(spark, job)


@query(
    over(
        "routed_local",
        """SELECT reason, count(*) AS n, count(*) FILTER (NOT accepted) AS quarantined
        FROM routed_local GROUP BY 1
        UNION ALL SELECT 'alerts', count(*), 0 FROM alerts_local""",
        "alerts_local",
    )
)
def stream_local_outputs(spark, sf):
    """Counters, quarantine and alerts of the local profile over several micro-batches."""
    job, raw = _batches(spark, sf, stragglers=False)
    jobs.start_local_run(spark, raw, job)
    counts = spark.read.parquet(f"{job.root}/counts").groupBy("reason").agg(F.sum("n").alias("n"))
    stored = spark.read.parquet(f"{job.root}/quarantine").groupBy("reason").agg(
        F.count(F.lit(1)).alias("quarantined")
    )
    both = counts.join(stored, "reason", "left").na.fill(0, ["quarantined"])
    alerts = _raised(spark, job).agg(
        F.lit("alerts").alias("reason"), F.count(F.lit(1)).alias("n"),
        F.lit(0).cast("bigint").alias("quarantined"),
    )
    return both.unionByName(alerts)


def _topic(spark, sf):
    """The events as stored messages of a topic of three partitions with offsets of their own."""
    job, root = _job(spark, "topic")
    raw = raw_events(spark, sf)
    part = F.col("arrival_seq") % 3
    raw.select(
        F.col("raw").cast("binary").alias("value"),
        part.cast("int").alias("partition"),
        (F.expr("arrival_seq div 3") + part * 1_000_000).alias("offset"),
        F.timestamp_millis("processed_ms").alias("timestamp"),
    ).write.parquet(f"{root}/in")
    return job, read_raw_stream(spark, "topic_files", {"path": f"{root}/in"})


@query(
    over(
        "routed_local_topic",
        "SELECT place AS arrival_seq, accepted, reason FROM routed_local_topic",
    )
)
def topic_order_local(spark, sf):
    job, raw = _topic(spark, sf)
    jobs.start_local_routing(raw, job).awaitTermination()
    return _local_outcome(spark, job)


@query(
    over(
        "routed_nolate_topic",
        "SELECT place AS arrival_seq, accepted, reason FROM routed_nolate_topic",
    )
)
def topic_order_stream(spark, sf):
    job, raw = _topic(spark, sf)
    jobs.start_routing(raw, job).awaitTermination()
    return _outcome(spark, job)
