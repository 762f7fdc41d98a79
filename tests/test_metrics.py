import random
import statistics

import pytest
from pyspark.sql import functions as F

from evpipe.functions.numeric import number_or_zero, value_or_zero
from evpipe.operators import experiments as exp
from evpipe.operators import metrics as met
from evpipe.operators import percentiles as pct
from evpipe.operators.prefix import dense_positions


@pytest.mark.parametrize("kind", ["ints", "floats", "same", "negative", "one"])
def test_percentiles_equal_sorted_list(spark, kind):
    rnd = random.Random(1)
    values = {
        "ints": [float(rnd.randint(1, 5000)) for _ in range(999)],
        "floats": [rnd.random() * 1e-3 for _ in range(1000)],
        "same": [7.0] * 50,
        "negative": [rnd.uniform(-1e6, 1e6) for _ in range(500)],
        "one": [3.5],
    }[kind]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    ordered, n = sorted(values), len(values)
    row = pct.latency_summary(df, "v").first()
    assert row["p95_ms"] == ordered[min(n - 1, int(n * 0.95))]
    assert row["p50_ms"] == pytest.approx(statistics.median(values))
    assert row["max_ms"] == ordered[-1] and row["avg_ms"] == pytest.approx(statistics.fmean(values))
    near = pct.percentile_nearest(df, "v", {"p50": 50, "p95": 95}).first()
    for p in (50, 95):
        assert near[f"p{p}"] == ordered[min(n - 1, round(p / 100 * (n - 1)))]


@pytest.mark.parametrize("kind", ["close", "tiny", "ties", "mixed"])
def test_ranks_in_crowded_buckets(spark, monkeypatch, kind):
    """Ranges are narrowed until few rows are left, also when all values share a bucket."""
    rnd = random.Random(2)
    values = {
        "close": [1e6 + rnd.random() * 1e-3 for _ in range(400)],
        "tiny": [rnd.choice([-1, 1]) * 10.0 ** rnd.uniform(-40, -5) for _ in range(300)],
        "ties": [5.0 + rnd.choice([0.0, 0.0, 1e-12, 3e-12]) for _ in range(300)],
        "mixed": [rnd.choice([3.0, -3.0, 0.0, -0.0, float("inf")]) + rnd.random() for _ in range(300)],
    }[kind]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    ordered, n = sorted(values), len(values)
    monkeypatch.setattr(pct, "NARROW_ROWS", 5)
    monkeypatch.setattr(pct, "PIECES", 8 if kind != "tiny" else 100_000)
    ranks = {f"r{k}": F.lit(k) for k in (0, n // 3, n // 2, n - 1)} | {"none": F.col("n")}
    row = pct.values_at_ranks(df, "v", ranks).first()
    assert [row[f"r{k}"] for k in (0, n // 3, n // 2, n - 1)] == [
        ordered[k] for k in (0, n // 3, n // 2, n - 1)
    ]
    assert row["none"] is None


def test_empty_latencies_are_zeros(spark):
    df = spark.createDataFrame([], "v double")
    assert tuple(pct.latency_summary(df, "v").first()) == (0.0, 0.0, 0.0, 0.0)
    assert pct.percentile_floor(df, "v", 0.95, "p").first()["p"] == 0.0


def test_number_helpers(spark):
    rows = [("1.5",), ("x",), (None,), ("NaN",), ("Infinity",)]
    df = spark.createDataFrame(rows, "t string")
    got = [r[0] for r in df.select(number_or_zero(F.col("t"))).collect()]
    assert got == [1.5, 0.0, 0.0, 0.0, 0.0]
    nan = spark.sql("select double('NaN') v union all select null union all select 2.0d")
    assert [r[0] for r in nan.select(value_or_zero(F.col("v"))).collect()] == [0.0, 0.0, 2.0]


def test_fixed_key_counts(spark):
    df = spark.createDataFrame([("a",), ("a",), ("z",)], "reason string")
    rows = {tuple(r) for r in met.count_for_keys(df, "reason", ["a", "b"]).collect()}
    assert rows == {("a", 2), ("b", 0)}
    assert met.count_for_keys(df, "reason", ["a", "b"], drop_zeros=True).count() == 1


def test_experiment_texts(spark):
    df = spark.sql(
        "select map('b', 3L, 'a', 3L, 'c', 1L) m, cast(map() as map<string,bigint>) e"
    )
    row = df.select(
        exp.top_reason(F.col("m")), exp.event_mix(F.col("m")),
        exp.top_reason(F.col("e")), exp.event_mix(F.col("e")),
    ).first()
    assert tuple(row) == ("a (3)", "a:3, b:3, c:1", "none", "none")


def test_buckets_include_the_rest(spark):
    rows = [(i, 1000 + 10 * i) for i in range(25)]
    df = spark.createDataFrame(rows, "arrival_seq bigint, processed_ms bigint")
    got = met.throughput_buckets(df, 10).orderBy("bucket").collect()
    assert [r["n"] for r in got] == [10, 10, 5]
    assert [round(r["seconds"], 6) for r in got] == [0.09, 0.1, 0.05]


def test_buckets_of_numbers_with_gaps(spark):
    rows = [((i % 3 << 33) + i, 1000 + i) for i in range(250)]
    df = spark.createDataFrame(rows, "arrival_seq bigint, processed_ms bigint")
    got = met.throughput_buckets(df, 100).orderBy("bucket").collect()
    assert [(r["bucket"], r["n"]) for r in got] == [(0, 100), (1, 100), (2, 50)]
    order = {r["arrival_seq"]: r["p"] for r in dense_positions(df, "arrival_seq", "p", 7, 2).collect()}
    assert [order[s] for s in sorted(order)] == list(range(250))
