import json

from test_rules import event, raw_frame

from evpipe.operators.alerts import alerts_with_cooldown
from evpipe.operators.enrich import patient_metadata
from evpipe.operators.parse import parse_events
from evpipe.operators.route import route
from evpipe.operators.validate import validate
from evpipe.sinks import tables
from evpipe.sources.fixtures import patients, raw_events
from evpipe.sources.readers import read_raw_stream
from evpipe.streaming.jobs import StreamJob, start_local_routing, start_routing, start_run

L, COOL = 1800, 86_400_000


def write_files(spark, sf_dir, folder, first, last, files=4):
    """Consecutive arrivals in numbered files, one file per micro-batch."""
    raw = raw_events(spark, sf_dir).select("arrival_seq", "raw", "processed_ms")
    n = raw.count()
    for i in range(first, last):
        part = raw.filter(f"arrival_seq >= {n * i // files} and arrival_seq < {n * (i + 1) // files}")
        part.coalesce(1).write.mode("append").parquet(folder)


def source(spark, folder):
    return read_raw_stream(spark, "parquet", {"path": folder, "maxFilesPerTrigger": "1"})


def by_seq(rows):
    return {r["arrival_seq"]: r["reason"] for r in rows.collect()}


def test_stream_profile_run_and_restart(spark, sf_dir, tmp_path):
    folder = str(tmp_path / "in")
    job = StreamJob(str(tmp_path / "out"), str(tmp_path / "ck"), L, COOL, {"availableNow": True})
    dim = patient_metadata(patients(spark, sf_dir))
    write_files(spark, sf_dir, folder, 0, 2)
    start_run(spark, source(spark, folder), dim, job)
    first = by_seq(spark.read.parquet(job.routed_path))
    # More arrivals, resumed from the same checkpoints.
    write_files(spark, sf_dir, folder, 2, 4)
    start_run(spark, source(spark, folder), dim, job)
    routed = spark.read.parquet(job.routed_path)
    streamed = by_seq(routed)
    assert {s: streamed[s] for s in first} == first

    checked = validate(parse_events(raw_events(spark, sf_dir)))
    batch = by_seq(route(checked, "stream", L))
    assert len(streamed) == len(batch) == routed.count()
    # The stream's watermark moves per micro-batch, so it can only find fewer late records; a
    # record accepted for that reason can in turn make a later one a duplicate.
    differing = {s for s in batch if batch[s] != streamed[s]}
    assert all(batch[s] == "late_event" or streamed[s] == "duplicate_event_id" for s in differing)
    assert "duplicate_event_id" in streamed.values()

    accepted = routed.filter("accepted")
    stored = tables.read_table(spark, job.root, tables.EVENTS_BY_ID)
    assert stored.count() == accepted.count()
    rejected = tables.read_table(spark, job.root, tables.QUARANTINE_BY_REASON)
    assert rejected.count() == routed.filter("not accepted").count()
    want = {
        (r["patient_id"], r["alert_time_ms"])
        for r in alerts_with_cooldown(accepted, COOL, None).collect()
    }
    raised = tables.read_table(spark, job.root, tables.ALERTS_BY_PATIENT)
    got = {(r["patient_id"], int(r["alert_time"].timestamp() * 1000)) for r in raised.collect()}
    assert {p for p, _ in got} == {p for p, _ in want} and len(got) == len(want) > 0
    lines = spark.read.text(f"{job.root}/topics/quarantine").select("value").collect()
    record = json.loads(lines[0]["value"])
    assert len(lines) == rejected.count() and record["valid"] is False and record["errors"]
    assert spark.read.text(f"{job.root}/topics/valid").count() == accepted.count()


def test_late_records_reach_quarantine(spark, tmp_path):
    def record(number, hour, **changes):
        event_id = f"00000000-0000-4000-8000-{number:012d}"
        return event(event_id=event_id, event_time=f"2026-01-24T{hour}:00:00Z", **changes)

    texts = [
        record(1, 10),
        record(2, 20),
        record(3, 11),  # far behind the watermark
        record(3, 11),  # late again, not a duplicate
        record(1, 20),
        record(2, 20, event_type="fax"),
        "{bad",
    ]
    folder = str(tmp_path / "in")
    for i, text in enumerate(texts):
        raw_frame(spark, [text]).selectExpr(
            f"arrival_seq + {i} as arrival_seq", "raw", "processed_ms"
        ).coalesce(1).write.mode("append").parquet(folder)
    job = StreamJob(str(tmp_path / "out"), str(tmp_path / "ck"), 300, COOL, {"availableNow": True})
    start_routing(source(spark, folder), job).awaitTermination()
    rows = spark.read.parquet(job.routed_path).orderBy("arrival_seq").collect()
    assert [r["errors"] for r in rows][:6] == [
        [], [], ["late_event"], ["late_event"], ["duplicate_event_id"],
        ["unknown_event_type", "duplicate_event_id"],
    ]
    assert rows[6]["errors"][0] == "bad_event_id"


def test_local_profile_on_a_stream_is_exact(spark, sf_dir, tmp_path):
    folder = str(tmp_path / "in")
    job = StreamJob(str(tmp_path / "out"), str(tmp_path / "ck"), L, COOL, {"availableNow": True})
    write_files(spark, sf_dir, folder, 0, 3, files=3)
    start_local_routing(source(spark, folder), job).awaitTermination()
    streamed = by_seq(spark.read.parquet(f"{job.root}/local_routed"))
    checked = validate(parse_events(raw_events(spark, sf_dir), "local"), "local")
    assert streamed == by_seq(route(checked, "local", L))


def test_stateful_routing_keeps_state_by_bucket(spark, tmp_path):
    from evpipe.streaming.jobs import start_stateful_routing
    from evpipe.streaming.stateful import STATE_BUCKETS

    def record(number, hour, **changes):
        event_id = f"00000000-0000-4000-8000-{number:012d}"
        return event(event_id=event_id, event_time=f"2026-01-24T{hour}:00:00Z", **changes)

    drops = [
        [record(n, 10) for n in range(1, STATE_BUCKETS + 200)] + [record(1, 10)],
        [record(2, 20)],
        [record(5000, 11), record(5000, 20), record(5000, 20)],
    ]
    folder = str(tmp_path / "in")
    start = 0
    for texts in drops:
        raw_frame(spark, texts).selectExpr(
            f"arrival_seq + {start} as arrival_seq", "raw", "processed_ms"
        ).coalesce(1).write.mode("append").parquet(folder)
        start += len(texts)
    job = StreamJob(str(tmp_path / "out"), str(tmp_path / "ck"), 300, COOL, {"availableNow": True})
    query = start_stateful_routing(source(spark, folder), job)
    query.awaitTermination()
    reasons = [r["reason"] for r in spark.read.parquet(job.routed_path).orderBy("arrival_seq").collect()]
    first = len(drops[0])
    assert reasons[: first - 1] == ["accepted"] * (first - 1)
    assert reasons[first - 1 :] == [
        "duplicate_event_id", "duplicate_event_id", "late_event", "accepted", "duplicate_event_id",
    ]
    # A call of Python per key is far too slow: the state holds a row per bucket, not per key.
    assert all(s["numRowsTotal"] <= STATE_BUCKETS for s in query.lastProgress["stateOperators"])
