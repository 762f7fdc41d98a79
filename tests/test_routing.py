import random

import pytest
from model import alert_model, cooldown_model, route_model
from pyspark.sql import functions as F

from evpipe.operators import cooldown as cooldown_module
from evpipe.operators import skew
from evpipe.operators.alerts import alerts_with_cooldown, patient_state
from evpipe.operators.cooldown import keep_by_blocks, keep_by_fold
from evpipe.operators.prefix import last_values, running_max
from evpipe.operators.route import route
from evpipe.operators.skew import find_hot_patients, left_join_hot

T0 = 1_700_000_000_000
SCHEMA = (
    "arrival_seq bigint, processed_ms bigint, raw_hash string, record_key string, "
    "event_id string, patient_id string, event_ms bigint, errors array<string>, "
    "signal string, signal_value double"
)


def random_events(seed, n=400):
    rnd = random.Random(seed)
    events, clock = [], T0
    for i in range(n):
        clock += rnd.randint(0, 4000)
        # One id and one patient take about a third of all rows.
        key = "hot" if rnd.random() < 0.33 else f"id{rnd.randint(0, n)}"
        patient = "P0" if rnd.random() < 0.33 else f"P{rnd.randint(1, 20)}"
        back = rnd.choice([0, 0, 0, 500, 20_000, 45_000, 90_000])
        errors = ["unknown_event_type"] if rnd.random() < 0.1 else []
        signal = rnd.choice(["heart_rate", "temperature_c", "wbc", "lactate", None])
        value = {"heart_rate": 105.0, "temperature_c": 37.5, "wbc": 10.0, "lactate": 2.0}.get(
            signal, 0.0
        ) * rnd.choice([1.0, 1.1, 1.1, 1.2])
        events.append(
            {
                "arrival_seq": i * rnd.choice([1, 1, 3]) + 1000 * i,
                "key": key,
                "patient": patient,
                "event_ms": clock - back,
                "processed_ms": clock + rnd.randint(0, 3000),
                "errors": errors,
                "signal": signal,
                "value": value,
            }
        )
    return events


def frame(spark, events):
    rows = [
        (
            e["arrival_seq"], e["processed_ms"], f"h{e['arrival_seq']}", e["key"], e["key"],
            e["patient"], e["event_ms"], e["errors"], e["signal"], e["value"],
        )
        for e in events
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.mark.parametrize("hot_rows", [20, 1_000_000])
@pytest.mark.parametrize("profile", ["stream", "local"])
def test_route_equals_record_by_record(spark, profile, hot_rows):
    for seed in (1, 2):
        events = random_events(seed)
        want = route_model(events, profile, 30_000)
        rows = route(frame(spark, events), profile, 30, hot_rows).collect()
        assert {r["arrival_seq"]: r["errors"] for r in rows} == want
        reasons = {e for errors in want.values() for e in errors}
        assert {"duplicate_event_id", "late_event"} <= reasons


@pytest.mark.parametrize("hot_rows", [50, 1_000_000])
def test_alerts_equal_record_by_record(spark, hot_rows):
    events = random_events(7, 600)
    want = alert_model(events, 60_000)
    accepted = frame(spark, events)
    hot = find_hot_patients(accepted, hot_rows)
    assert (hot is None) == (hot_rows > 600)
    got = alerts_with_cooldown(accepted, 60_000, hot).collect()
    assert {(r["patient_id"], r["arrival_seq"]) for r in got} == want
    assert len(got) == len(want) > 20


def hits_frame(spark, hits):
    return spark.createDataFrame(hits, "patient_id string, arrival_seq bigint, event_ms bigint")


@pytest.mark.parametrize("start", [T0, -300_000])
def test_cooldown_blocks_equal_fold(spark, start):
    rnd = random.Random(5)
    hits, clock = [], start
    for i in range(3000):
        clock += rnd.choice([0, 1, 40, 300, 300, 700, 5000])
        hits.append((rnd.choice("aaab"), i * 7, clock - rnd.choice([0, 0, 0, 900, 4000])))
    want = cooldown_model(hits, 1000)
    span = max(h[2] for h in hits) - min(h[2] for h in hits)
    df = hits_frame(spark, hits)
    fold = keep_by_fold(df, "patient_id", 1000).collect()
    assert {(r["patient_id"], r["arrival_seq"]) for r in fold} == want
    blocks = keep_by_blocks(df, "patient_id", 1000, span, block_cooldowns=4, chunk=100).collect()
    assert {(r["patient_id"], r["arrival_seq"]) for r in blocks} == want
    assert len(blocks) == len(want) > 300


@pytest.mark.parametrize("cooldown", [1, 300, 1000, 10**9])
def test_cooldown_pointers_equal_record_by_record(spark, monkeypatch, cooldown):
    """No block may be wider than a millisecond, so that pointers serve all cool-downs."""
    monkeypatch.setattr(cooldown_module, "GROUP_MS", 1)
    monkeypatch.setattr(cooldown_module, "reduce_blocks", None)
    rnd = random.Random(6)
    hits, clock = [], -40_000
    for i in range(400):
        clock += rnd.choice([0, 1, 40, 300, 300, 700, 5000])
        hits.append((rnd.choice("aaab"), i * 7, clock - rnd.choice([0, 0, 0, 900, 4000])))
    df = hits_frame(spark, hits)
    kept = keep_by_blocks(df, "patient_id", cooldown, 10**6, chunk=500).collect()
    assert {(r["patient_id"], r["arrival_seq"]) for r in kept} == cooldown_model(hits, cooldown)
    assert len(kept) == len(cooldown_model(hits, cooldown))
    assert keep_by_blocks(df.filter("false"), "patient_id", cooldown, 0).isEmpty()


@pytest.mark.parametrize("cooldown", [0, 1, 600_000, 86_400_000])
def test_blocks_equal_the_fold_for_any_cooldown(spark, cooldown):
    rnd = random.Random(cooldown)
    rows, clock = [], T0
    for i in range(400):
        clock += rnd.choice([0, 0, 1, 2, 40_000, 700_000])
        rows.append((f"P{i % 2}", i, clock - rnd.choice([0, 0, 1, 500_000])))
    df = spark.createDataFrame(rows, "patient_id string, arrival_seq bigint, event_ms bigint")
    fold = keep_by_fold(df, "patient_id", cooldown).collect()
    blocks = keep_by_blocks(df, "patient_id", cooldown, clock - T0, chunk=100).collect()
    key = lambda found: sorted((r["patient_id"], r["arrival_seq"]) for r in found)
    assert key(fold) == key(blocks) and len(fold) >= 2
    with pytest.raises(ValueError):
        keep_by_fold(df, "patient_id", -1)


def test_running_max_over_small_chunks(spark):
    rnd = random.Random(3)
    rows = [
        (10 * i + rnd.randint(0, 9), rnd.choice("ab"), rnd.choice([None, rnd.randint(0, 10**6)]))
        for i in range(500)
    ]
    df = spark.createDataFrame(rows, "s bigint, k string, v bigint").repartition(7)
    for keys in ([], ["k"]):
        for inclusive in (True, False):
            got = {
                r["s"]: r["m"]
                for r in running_max(df, "s", "v", "m", keys, inclusive, chunk=50, block=4).collect()
            }
            best = {}
            for s, k, v in rows:
                group = k if keys else ""
                before = best.get(group)
                best[group] = max((x for x in (before, v) if x is not None), default=None)
                assert got[s] == (best[group] if inclusive else before)


def test_last_values_of_hot_keys(spark):
    rnd = random.Random(4)
    rows = [(i * 3, rnd.choice("aab"), rnd.choice([None, float(i)])) for i in range(300)]
    df = spark.createDataFrame(rows, "s bigint, k string, v double")
    marked = df.withColumn("hot", F.col("k") == "a").repartition(5)
    plain = last_values(df, "k", "s", {"x": F.col("v")}).select("s", "x")
    cut = last_values(marked, "k", "s", {"x": F.col("v")}, "hot", chunk=30).select("s", "x")
    assert sorted(plain.collect()) == sorted(cut.collect())
    last = {}
    for s, k, v in rows:
        last[k] = v if v is not None else last.get(k)
    assert plain.count() == 300


def test_left_join_spreads_hot_keys(spark):
    left = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("k"), "id"
    )
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3)], "k string, v int")
    joined = left_join_hot(left, right, "k", right.filter("k = 'hot'"), F.col("id"))
    want = {(r["k"], r["id"], r["v"]) for r in left.join(right, "k", "left").collect()}
    rows = joined.collect()
    assert {(r["k"], r["id"], r["v"]) for r in rows} == want and len(rows) == 1000
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and plan.count("xxhash64") >= 2


@pytest.mark.parametrize("most_bytes", [0, 64 << 20])
def test_any_number_of_hot_keys(spark, monkeypatch, most_bytes):
    """12,000 hot keys, by broadcast and by key; rows without a key meet nothing."""
    monkeypatch.setattr(skew, "BROADCAST_BYTES", most_bytes)
    events = spark.range(60_000).select(
        F.col("id").alias("arrival_seq"),
        F.when(F.col("id") < 36_000, F.concat(F.lit("p"), F.col("id") % 12_000))
        .when(F.col("id") < 50_000, F.concat(F.lit("c"), "id")).alias("patient_id"),
    )
    hot = find_hot_patients(events, 3)
    assert hot.count() == 12_000
    marked = skew.mark_hot(events, hot, "_hot")
    assert marked.columns == [*events.columns, "_hot"]
    row = marked.agg(
        F.count("*"), F.count_if("_hot"), F.count_if(F.col("_hot") != (F.col("arrival_seq") < 36_000))
    ).first()
    assert tuple(row) == (60_000, 36_000, 0)
    right = events.filter("patient_id is not null").groupBy("patient_id").agg(
        F.min("arrival_seq").alias("first")
    )
    hot_rows = right.join(hot, "patient_id", "left_semi")
    joined = left_join_hot(events, right, "patient_id", hot_rows, F.col("arrival_seq"))
    plain = events.join(right, "patient_id", "left").select("arrival_seq", "patient_id", "first")
    assert joined.columns == plain.columns
    assert joined.exceptAll(plain).isEmpty() and joined.count() == 60_000
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert ("_salt" in plan) == (most_bytes > 0)


def test_routing_and_alerts_beyond_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_BYTES", 0)
    events = random_events(9, 500)
    rows = route(frame(spark, events), "stream", 30, 5).collect()
    assert {r["arrival_seq"]: r["errors"] for r in rows} == route_model(events, "stream", 30_000)
    accepted = frame(spark, events)
    got = alerts_with_cooldown(accepted, 60_000, find_hot_patients(accepted, 20)).collect()
    assert {(r["patient_id"], r["arrival_seq"]) for r in got} == alert_model(events, 60_000)


@pytest.mark.parametrize("hot_rows", [10, 10**6])
def test_alerts_carry_on_over_batches(spark, hot_rows):
    """Batch by batch with carried state gives the alerts of one run over all events."""
    rng = random.Random(11)
    rows = [
        (rng.choice(["p", "p", "q", "r"]), seq, rng.randrange(0, 4000) + 40 * seq, f"e{seq}",
         rng.choice([None, "heart_rate", "temperature_c", "wbc", "lactate"]), rng.choice([1.0, 39.0, 120.0]))
        for seq in range(400)
    ]
    events = spark.createDataFrame(
        rows, "patient_id string, arrival_seq bigint, event_ms bigint, record_key string, "
        "signal string, signal_value double"
    )
    pick = lambda df: sorted(
        (r["patient_id"], r["arrival_seq"], r["alert_time_ms"]) for r in df.collect()
    )
    for cooldown in (0, 500):
        whole = pick(alerts_with_cooldown(events, cooldown, None))
        carried, parts = None, []
        for low in (0, 71, 300):
            high = {0: 71, 71: 300, 300: 400}[low]
            batch = events.filter(f"arrival_seq >= {low} and arrival_seq < {high}")
            hot = find_hot_patients(batch, hot_rows)
            alerts = alerts_with_cooldown(batch, cooldown, hot, carried).cache()
            parts += pick(alerts)
            state = patient_state(batch, alerts, carried).cache()
            known = {r["patient_id"]: r for r in state.collect()}
            if carried is not None:
                rest = [r for r in carried.collect() if r["patient_id"] not in known]
                known |= {r["patient_id"]: r for r in rest}
            carried = spark.createDataFrame([tuple(r) for r in known.values()], state.schema)
        assert sorted(parts) == whole
