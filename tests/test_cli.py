import json
import uuid

from test_rules import event

from evpipe.__main__ import main
from evpipe.schema import LOOKUP_FAILED_JSON
from evpipe.sinks import tables


def _write(folder):
    folder.mkdir()
    ids = [f"00000000-0000-4000-8000-{i:012d}" for i in (1, 2, 2)]
    lines = [event(event_id=i) for i in ids] + ["{bad"]
    (folder / "events.jsonl").write_text("\n".join(lines) + "\n")


def test_batch_command(spark, tmp_path):
    _write(tmp_path / "in")
    for profile in ("stream", "local"):
        out = str(tmp_path / profile)
        main(["batch", "--input", str(tmp_path / "in"), "--output", out, "--profile", profile])
    stored = tables.read_table(spark, str(tmp_path / "stream"), tables.EVENTS_BY_ID)
    assert stored.count() == 2
    summary = spark.read.json(str(tmp_path / "stream" / "summary")).first()
    assert summary["totals"]["valid"] == 2 and summary["event_counts"]["vital"] == 2
    local = spark.read.json(str(tmp_path / "local" / "summary")).first()
    assert local["metrics"]["total"] == 4 and local["metrics"]["accepted"] == 2
    assert local["reasons"].asDict() == {"bad_payload_json": 1, "duplicate_event_id": 1}


def test_stream_command(spark, tmp_path):
    _write(tmp_path / "in")
    out = str(tmp_path / "out")
    main([
        "stream", "--format", "text", "--option", f"path={tmp_path / 'in'}", "--output", out,
        "--name", f"cli-{uuid.uuid4().hex}", "--once",
    ])
    valid = spark.read.text(f"{out}/topics/valid")
    assert valid.count() == 2 and json.loads(valid.first()["value"])["patient_id"] == "P000417"
    stored = tables.read_table(spark, out, tables.QUARANTINE_BY_REASON)
    assert {r["reason"] for r in stored.collect()} == {"bad_event_id", "duplicate_event_id"}


def _lines(folder, *numbers):
    folder.mkdir()
    ids = [f"00000000-0000-4000-8000-{i:012d}" for i in numbers]
    (folder / "events.jsonl").write_text("\n".join(event(event_id=i) for i in ids) + "\n")


def test_kept_runs_add_up(spark, tmp_path):
    _lines(tmp_path / "a", 1, 2)
    _lines(tmp_path / "b", 2, 3, 4)
    for profile in ("stream", "local"):
        out = str(tmp_path / profile)
        for folder in ("a", "b"):
            main(["batch", "--input", str(tmp_path / folder), "--output", out, "--profile",
                  profile, "--keep"])
    root = str(tmp_path / "stream")
    ids = {r["event_id"][-1] for r in tables.read_table(spark, root, tables.EVENTS_BY_ID).collect()}
    assert ids == {"1", "2", "3", "4"}
    main(["compact", "--output", root])
    assert tables.read_table(spark, root, tables.EVENTS_BY_ID).count() == 4
    stored = spark.read.parquet(str(tmp_path / "local" / "events")).collect()
    assert sorted(r["event_id"][-1] for r in stored) == ["1", "2", "3", "4"]
    refused = spark.read.parquet(str(tmp_path / "local" / "quarantine")).collect()
    assert [r["reason"] for r in refused] == ["duplicate_event_id"]
    # Without --keep a run starts afresh.
    main(["batch", "--input", str(tmp_path / "a"), "--output", root])
    assert tables.read_table(spark, root, tables.EVENTS_BY_ID).count() == 2


def test_repeated_lines_of_a_text_stream_are_duplicates(spark, tmp_path):
    _lines(tmp_path / "in", 7, 7, 7)
    out = str(tmp_path / "out")
    args = ["stream", "--format", "text", "--option", f"path={tmp_path / 'in'}", "--output", out,
            "--name", f"cli-{uuid.uuid4().hex}", "--once", "--profile", "local"]
    main(args)
    (tmp_path / "in" / "more.jsonl").write_text((tmp_path / "in" / "events.jsonl").read_text())
    main(args)
    reasons = [r["reason"] for r in spark.read.parquet(f"{out}/local_routed").collect()]
    assert sorted(reasons) == ["accepted"] + ["duplicate_event_id"] * 5


def test_unreadable_patients_leave_the_marker(spark, tmp_path):
    _lines(tmp_path / "in", 1)
    for extra in ([], ["--patients", str(tmp_path / "none")]):
        out = str(tmp_path / f"out{len(extra)}")
        main(["batch", "--input", str(tmp_path / "in"), "--output", out, *extra])
        row = tables.read_table(spark, out, tables.EVENTS_BY_ID).first()
        assert row["patient_metadata"] == LOOKUP_FAILED_JSON
