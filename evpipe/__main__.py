"""Command line: route batches, run the stream, write summaries and run comparisons."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from evpipe.functions.time import ingest_latency
from evpipe.operators import metrics
from evpipe.operators.alerts import alert_details
from evpipe.operators.enrich import patient_metadata
from evpipe.plans.batch import run_batch
from evpipe.plans.staging import remove_staged
from evpipe.schema import ALERT_COOLDOWN_MS, DEFAULT_LATENESS_SEC
from evpipe.session import tune
from evpipe.sinks import files, tables
from evpipe.sources import readers
from evpipe.streaming.jobs import (
    StreamJob,
    checkpoint_root,
    start_local_run,
    start_run,
)


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="evpipe", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, help_text: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=help_text)
        sub.add_argument("--output", required=True, help="folder for the results")
        return sub

    def routing(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--profile", choices=("stream", "local"), default="stream")
        sub.add_argument("--allowed-lateness-sec", type=int, default=DEFAULT_LATENESS_SEC)
        sub.add_argument("--cooldown-ms", type=int, default=ALERT_COOLDOWN_MS)
        sub.add_argument("--patients", help="Parquet folder of patient attributes")

    batch = command("batch", "route files of raw records")
    batch.add_argument("--input", required=True)
    batch.add_argument("--format", default="text", choices=("text", "parquet"))
    batch.add_argument("--metrics-input", help="JSON document of the producer's metrics")
    batch.add_argument("--keep", action="store_true", help="append instead of starting afresh")
    routing(batch)

    stream = command("stream", "route a stream until stopped")
    stream.add_argument("--format", default="kafka", choices=("kafka", "topic_files", "text", "parquet"))
    stream.add_argument(
        "--option", action="append", default=[], metavar="NAME=VALUE", help="source option"
    )
    stream.add_argument("--name", default="main", help="names the checkpoints")
    stream.add_argument("--topic-servers", help="Kafka servers for the output topics")
    stream.add_argument("--topic-prefix", default="events.")
    stream.add_argument("--trigger-sec", type=int, default=10)
    stream.add_argument("--once", action="store_true", help="process what is there and end")
    routing(stream)

    command("compact", "put the parts of the serving tables together")

    experiments = command("experiments", "compare the runs whose summaries lie in a folder")
    experiments.add_argument("--experiment-dir", required=True)
    return parser.parse_args(argv)


def batch_command(spark: SparkSession, args: argparse.Namespace) -> None:
    raw = readers.read_raw_batch(spark, args.input, args.format)
    # Without a dimension, or when it can't be read, records pass with the failure marker.
    dim = readers.patients_or_none(spark, args.patients)
    out = args.output
    seen = None
    if args.profile == "local" and args.keep:
        seen = files.stored_ids(spark, out)
    run = run_batch(raw, dim, args.profile, args.allowed_lateness_sec, args.cooldown_ms, seen)
    latency = ingest_latency(F.col("processed_ms"), F.col("emit_ms"))
    events = run.events.withColumn("ingestion_latency_ms", latency)
    if args.profile == "local":
        files.append_events(run.accepted, out, reset=not args.keep)
        files.append_quarantine(run.quarantined, out, reset=not args.keep)
        files.append_alerts(run.alerts, out, reset=not args.keep)
        buckets = metrics.throughput_buckets(events)
        files.save_run_metrics(metrics.run_metrics(events, run.alerts), out, buckets)
        files.write_summary(metrics.local_summary(events, run.alerts), f"{out}/summary")
        return
    alerts = tables.alert_rows(run.alerts, alert_details())
    for write, rows, spec in (
        (tables.upsert_events_by_id, run.accepted, tables.EVENTS_BY_ID),
        (tables.upsert_events_by_type, run.accepted, tables.EVENTS_BY_TYPE),
        (tables.upsert_quarantine, run.quarantined, tables.QUARANTINE_BY_REASON),
        (tables.upsert_alerts_by_patient, alerts, tables.ALERTS_BY_PATIENT),
        (tables.upsert_alerts_by_type, alerts, tables.ALERTS_BY_TYPE),
    ):
        write(rows, out, tables.begin_run(spark, out, spec, args.keep))
    producer = readers.read_run_metrics(spark, args.metrics_input or f"{out}/run_metrics.json")
    files.write_summary(metrics.build_summary(events, run.alerts, producer), f"{out}/summary")


def stream_command(spark: SparkSession, args: argparse.Namespace) -> None:
    options = dict(pair.split("=", 1) for pair in args.option)
    raw = readers.read_raw_stream(spark, args.format, options)
    topics = {}
    if args.topic_servers:
        topics = {
            name: {
                "format": "kafka",
                "kafka.bootstrap.servers": args.topic_servers,
                "topic": f"{args.topic_prefix}{name}",
            }
            for name in ("valid", "quarantine", "alerts")
        }
    trigger = {"availableNow": True} if args.once else {
        "processingTime": f"{args.trigger_sec} seconds"
    }
    job = StreamJob(
        args.output,
        checkpoint_root(spark, args.name),
        args.allowed_lateness_sec,
        args.cooldown_ms,
        trigger,
        topics,
    )
    if args.profile == "local":
        start_local_run(spark, raw, job)
        if not args.once:
            spark.streams.awaitAnyTermination()
        return
    found = readers.patients_or_none(spark, args.patients)
    dim = None if found is None else patient_metadata(found)
    start_run(spark, raw, dim, job)
    if not args.once:
        spark.streams.awaitAnyTermination()


def experiments_command(spark: SparkSession, args: argparse.Namespace) -> None:
    rows = readers.load_experiments(spark, args.experiment_dir)
    files.write_experiments(rows, args.output)
    files.write_experiments_markdown(rows, args.output)


def compact_command(spark: SparkSession, args: argparse.Namespace) -> None:
    for spec in tables.ALL_TABLES:
        tables.compact(spark, args.output, spec)


def main(argv: list[str] | None = None) -> None:
    args = parse_args(argv)
    spark = tune(SparkSession.builder.appName("evpipe").getOrCreate())
    run = {
        "batch": batch_command, "stream": stream_command, "compact": compact_command,
        "experiments": experiments_command,
    }[args.command]
    try:
        run(spark, args)
    finally:
        remove_staged(spark)


if __name__ == "__main__":
    main()
