import json

from pyspark.sql import functions as F

from evpipe.operators import experiments as exp
from evpipe.operators import metrics as met
from evpipe.operators.alerts import alert_details
from evpipe.operators.enrich import enrich, patient_metadata
from evpipe.plans.batch import run_batch
from evpipe.schema import EXPERIMENT_REPORT_COLUMNS, PRODUCER_SCHEMA
from evpipe.sinks import files, tables
from evpipe.sources import readers
from evpipe.sources.fixtures import patients, raw_events


def test_batch_run_invariants(spark, sf_dir, tmp_path):
    root = str(tmp_path)
    raw = raw_events(spark, sf_dir)
    for profile in ("stream", "local"):
        run = run_batch(raw, patients(spark, sf_dir), profile, 1800, 86_400_000)
        n, ok, bad = run.events.count(), run.accepted.count(), run.quarantined.count()
        assert ok + bad == n == raw.count()
        reasons = met.count_by_reason(run.quarantined).agg(F.sum("n")).first()[0]
        types = met.count_by_type(run.accepted).agg(F.sum("n")).first()[0]
        assert (reasons, types) == (bad, ok)
        assert run.quarantined.filter("patient_metadata != '{}'").count() == 0
        assert 0 < run.accepted.filter("patient_metadata = '{}'").count() < ok
    files.append_quarantine(run.quarantined, root, reset=True)
    files.append_quarantine(run.quarantined.limit(3), root)
    lines = spark.read.text(f"{root}/quarantine_jsonl").collect()
    assert len(lines) == bad + 3
    first = json.loads(lines[0]["value"])
    assert set(first) == {"event", "reason"} and "event_id" in first["event"]
    files.append_alerts(run.alerts, root, reset=True)
    assert spark.read.parquet(f"{root}/alerts").count() == run.alerts.count()
    latency = (F.col("processed_ms") - F.col("emit_ms")).cast("double")
    timed = run.events.withColumn("ingestion_latency_ms", latency)
    metrics = met.run_metrics(timed, run.alerts)
    files.save_run_metrics(metrics, root)
    files.save_run_metrics(metrics, root)
    assert spark.read.json(f"{root}/run_metrics").first()["accepted"] == ok


def test_upsert_replaces_and_replays(spark, tmp_path):
    root = str(tmp_path)
    spec = tables.QUARANTINE_BY_REASON

    def rows(*items):
        schema = "reason string, observed_at timestamp, event_id string, errors array<string>, " \
            "raw_event string, arrival_seq bigint"
        data = [(r, None, e, [r], raw, s) for r, e, raw, s in items]
        return spark.createDataFrame(data, schema).withColumn(
            "observed_at", F.timestamp_millis(F.lit(1_700_000_000_000))
        )

    tables.upsert(rows(("late", "1", "a", 1), ("late", "2", "b", 2)), root, spec, 0)
    tables.upsert(rows(("late", "1", "c", 3)), root, spec, 1)
    tables.upsert(rows(("late", "1", "c", 3), ("dup", "1", "d", 4)), root, spec, 1)
    want = {("late", "1", "c"), ("late", "2", "b"), ("dup", "1", "d")}
    read = lambda where: {
        (r["reason"], r["event_id"], r["raw_event"])
        for r in tables.read_table(spark, where, spec).collect()
    }
    assert read(root) == want
    tables.compact(spark, root, spec)
    assert read(root) == want and tables.next_batch_id(spark, root, spec) == 3
    parts = tables.read_parts(spark, root, spec).filter("reason = 'dup'")
    assert "PartitionFilters: [isnotnull(reason" in parts._jdf.queryExecution().toString()


def test_insert_if_absent(spark):
    new = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3), ("c", 4)], "event_id string, arrival_seq bigint")
    stored = spark.createDataFrame([("c",)], "event_id string")
    added, conflicts = tables.insert_if_absent(new, stored)
    assert sorted(r["arrival_seq"] for r in added.collect()) == [1, 2]
    assert sorted(r["arrival_seq"] for r in conflicts.collect()) == [3, 4]


def test_enrich_with_hot_patient(spark):
    events = spark.range(100).select(
        F.col("id").alias("arrival_seq"),
        F.when(F.col("id") < 50, "P1").otherwise(F.concat(F.lit("P"), "id")).alias("patient_id"),
    )
    dim = patient_metadata(
        spark.createDataFrame([("P1", "x"), ("P60", "y")], "patient_id string, age_band string")
    )
    for hot in (None, spark.createDataFrame([("P1",)], "patient_id string")):
        rows = enrich(events, dim, None, hot).groupBy("patient_metadata").count().collect()
        assert {r[0]: r[1] for r in rows} == {
            '{"age_band":"x"}': 50, '{"age_band":"y"}': 1, "{}": 49,
        }
    failed = enrich(events, None).first()["patient_metadata"]
    assert failed == '{"redis_lookup":"failed"}'


def _write_summary(path, sent, eps, p95, reasons):
    path.mkdir(parents=True)
    doc = {
        "pipeline": "x",
        "generated_at_epoch_ms": 1,
        "totals": {"valid": 9, "quarantine": 1, "alerts": 0, "processed": 10, "accepted_percent": 90.0},
        "event_counts": {"vital": 5, "lab": 4},
        "quarantine_reasons": reasons,
        "latency_ms": {"avg_ms": 1.234, "p50_ms": 1.0, "p95_ms": p95, "max_ms": 9.0},
        "producer": {"sent": sent, "throughput_events_per_sec": eps},
    }
    (path / "summary.json").write_text(json.dumps(doc, indent=2))


def test_experiments_from_files(spark, tmp_path):
    _write_summary(tmp_path / "in" / "run_b", 10, 99.999, 5.0, {"late_event": 1})
    _write_summary(tmp_path / "in" / "run_a", 20, 50.0, 4.0, {})
    runs = readers.load_experiments(spark, str(tmp_path / "in"))
    rows = {r["run"]: r for r in runs.collect()}
    assert set(rows) == {"run_a", "run_b"}
    assert rows["run_b"]["producer_events_per_sec"] == 100.0
    assert rows["run_b"]["top_quarantine_reason"] == "late_event (1)"
    assert rows["run_a"]["top_quarantine_reason"] == "none"
    assert rows["run_a"]["event_mix"] == "lab:4, vital:5"
    assert tuple(exp.best_runs(runs).first()) == ("run_b", 100.0, "run_a", 4.0)
    assert tuple(exp.experiment_overview(runs).first()) == (2, 30)
    files.write_experiments(runs, str(tmp_path / "out"))
    csv = spark.read.option("header", True).csv(str(tmp_path / "out" / "experiments_csv"))
    assert csv.count() == 2 and len(csv.columns) == 16
    files.write_experiments_markdown(runs, str(tmp_path / "out"), EXPERIMENT_REPORT_COLUMNS)
    lines = [r[0] for r in spark.read.text(str(tmp_path / "out" / "experiments_md")).collect()]
    assert lines[0].startswith("| run | events_sent |") and lines[1].startswith("| --- |")
    assert lines[2].startswith("| run_a | 20 |") and len(lines) == 4
    stored = tmp_path / "in" / "experiment_summary.json"
    stored.write_text(json.dumps([rows["run_a"].asDict()], indent=2))
    assert readers.load_experiments(spark, str(tmp_path / "in")).count() == 1


def test_run_metrics_document(spark, tmp_path):
    path = tmp_path / "metrics.json"
    assert readers.read_run_metrics(spark, str(path)).count() == 0
    path.write_text(json.dumps({"sent": 5, "throughput_events_per_sec": 2.5}, indent=2))
    row = readers.read_run_metrics(spark, str(path)).first()
    assert row["sent"] == 5 and row["throughput_events_per_sec"] == 2.5


def test_summary_document(spark, sf_dir, tmp_path):
    run = run_batch(raw_events(spark, sf_dir), None, "stream", 1800, 86_400_000)
    latency = (F.col("processed_ms") - F.col("emit_ms")).cast("double")
    producer = spark.createDataFrame([(1000, *[None] * 10)], PRODUCER_SCHEMA)
    summary = met.build_summary(run.events.withColumn("ingestion_latency_ms", latency), run.alerts, producer)
    files.write_summary(summary, str(tmp_path / "s"))
    row = spark.read.json(str(tmp_path / "s")).first()
    assert row["totals"]["valid"] == run.accepted.count()
    assert row["totals"]["valid"] + row["totals"]["quarantine"] == row["totals"]["processed"]
    assert row["producer"]["sent"] == 1000
    details = json.loads(run.alerts.select(alert_details()).first()[0])
    assert set(details) == {"heart_rate", "temperature_c", "wbc", "lactate", "rule"}


def test_kafka_order_within_a_millisecond(spark):
    rows = [("a", 5, 1, 10), ("b", 5, 0, 99), ("c", 4, 3, 7)]
    df = spark.createDataFrame(rows, "raw string, processed_ms bigint, partition int, offset bigint")
    numbered = readers.number_arrivals(df, "processed_ms", "partition", "offset")
    assert [r["raw"] for r in numbered.orderBy("arrival_seq").collect()] == ["c", "b", "a"]


def test_table_without_rows(spark, tmp_path):
    root = str(tmp_path)
    for spec in tables.ALL_TABLES:
        nothing = spark.createDataFrame([], spec.schema)
        tables.upsert(nothing, root, spec, tables.begin_run(spark, root, spec, False))
        assert tables.read_table(spark, root, spec).count() == 0
        assert tables.next_batch_id(spark, root, spec) == 1


def _ids(spark, pairs):
    schema = "event_id string, patient_id string, event_type string, event_time timestamp, source string, " \
        "payload string, patient_metadata string, ingestion_latency_ms double, raw_event string, " \
        "processed_at timestamp"
    rows = [(k, v, "lab", None, "s", "{}", "{}", 1.0, "r", None) for k, v in pairs]
    return spark.createDataFrame(rows, schema).repartition(3)


def test_levels_keep_the_latest_and_few_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "FANOUT", 3)
    root, spec, want = str(tmp_path), tables.EVENTS_BY_ID, {}
    for batch in range(14):
        pairs = [(f"k{(batch * 7 + i) % 40:03d}", f"b{batch}") for i in range(12)]
        want.update(pairs)
        for _ in range(2):  # a replay changes nothing
            tables.upsert(_ids(spark, pairs), root, spec, batch)
    got = {r["event_id"]: r["patient_id"] for r in tables.read_table(spark, root, spec).collect()}
    assert got == want
    current = tables._current(tables._all_parts(spark, root, spec))
    assert max(level for level, _ in current) == 2 and len(current) <= 2 * 3 + 1
    for key in ("k000", "k039", "none"):
        rows = tables.read_key(spark, root, spec, key).collect()
        assert [r["patient_id"] for r in rows] == ([want[key]] if key in want else [])
    # What a micro-batch sees is what was there before it, also when it is run again.
    before = tables.read_before(spark, root, spec, 13)
    assert {r["event_id"]: r["patient_id"] for r in before.collect()}["k011"] != "b13"
    assert tables.read_before(spark, root, spec, 0) is None


def test_point_read_opens_few_files_and_pushes_the_key(spark, tmp_path):
    root, spec = str(tmp_path), tables.EVENTS_BY_ID
    pairs = [(f"k{i:05d}", "p") for i in range(4000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.upsert(_ids(spark, pairs), root, spec, 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    everything = tables.read_parts(spark, root, spec)
    assert len(everything.inputFiles()) >= 4
    found = tables.read_key(spark, root, spec, "k01234")
    assert len(found.inputFiles()) == 1 and found.count() == 1
    assert "EqualTo(event_id,k01234)" in found._jdf.queryExecution().toString()


def test_partitioned_parts_have_files_by_size(spark, tmp_path):
    rows = spark.range(3000).selectExpr(
        "concat('t', id % 6) as event_type", "cast(id as string) as event_id", "'p' as patient_id",
        "timestamp_millis(id) as event_time", "id as arrival_seq",
    ).repartition(16)
    tables.upsert(rows, str(tmp_path), tables.EVENTS_BY_TYPE, 0)
    stored = tables.read_parts(spark, str(tmp_path), tables.EVENTS_BY_TYPE)
    # At most one file more for each task than there are keys, not tasks times keys.
    assert stored.count() == 3000 and len(stored.inputFiles()) <= 6 + 8
