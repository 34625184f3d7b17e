"""Counters and gauges on a grid of steps, and counters as a stream, against plain loops."""

import math
import random
from collections import defaultdict
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from annospark.operators import serving, steps
from annospark.streaming import counters, rates

BEGIN = 1_700_000_000
SCHEMA = "series string, ts timestamp, value double"


def at(seconds):
    return datetime.fromtimestamp(BEGIN + seconds, timezone.utc)


def made(seed, n, names="ab", span=5000):
    """Counters that begin anew now and then, with repeated times, nulls and a gap."""
    rng, rows = random.Random(seed), []
    for name in (*names, None):
        value = 0.0
        for s in sorted(rng.choice([rng.randrange(span), rng.randrange(span // 8)]) for _ in range(n)):
            value = float(rng.randrange(3)) if rng.random() < 0.1 else value + rng.randrange(9)
            rows.append((name, at(s), value))
    return [*rows, ("a", None, 5.0), ("a", at(7), None)]


def usable(rows):
    out = defaultdict(list)
    for name, ts, value in rows:
        if ts is not None and value is not None:
            out[name].append((round(ts.timestamp()), value))
    return {k: sorted(v) for k, v in out.items()}


def slow_counters(rows, step, span):
    out = {}
    for name, samples in usable(rows).items():
        for t in range(math.ceil(samples[0][0] / step) * step, samples[-1][0] + span + step, step):
            inside = [x for x in samples if t - span < x[0] <= t]
            if len(inside) > 1:
                out[name, t] = sum(v if v < u else v - u for (_, u), (_, v) in zip(inside, inside[1:]))
    return out


@pytest.mark.parametrize("slab", [60, 700, 10**7])
@pytest.mark.parametrize("step,span", [(60, 300), (100, 100), (90, 40), (1000, 2500)])
def test_counter_steps(spark, slab, step, span):
    rows = made(step, 60)
    found = steps.counter_steps(spark.createDataFrame(rows, SCHEMA), ["series"], step, span, slab).collect()
    assert {(r.series, round(r.step.timestamp())): r.increase for r in found} == slow_counters(rows, step, span)
    assert all(r.rate == r.increase / span for r in found)


@pytest.mark.parametrize("step,lookback", [(60, 300), (100, 100), (90, 40)])
def test_gauge_steps(spark, step, lookback):
    rows = made(step + 1, 60)
    want = {}
    for name, samples in usable(rows).items():
        for t in range(math.ceil(samples[0][0] / step) * step, samples[-1][0] + lookback + step, step):
            inside = [x for x in samples if t - lookback < x[0] <= t]
            if inside:
                want[name, t] = max(inside)[1]
    found = steps.gauge_steps(spark.createDataFrame(rows, SCHEMA), ["series"], step, lookback).collect()
    assert {(r.series, round(r.step.timestamp())): r.value for r in found} == want


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert steps.counter_steps(none, ["series"], 60, 300).count() == 0
    assert steps.gauge_steps(none, ["series"], 60, 300).count() == 0


def test_groups_without_samples_are_zeros(spark):
    grid = steps.step_grid(spark, BEGIN, BEGIN + 300, 100)
    found = steps.gauge_totals(steps.gauge_steps(spark.createDataFrame([("a", at(50), 2.0), (None, at(150), 0.0)], SCHEMA), ["series"], 100, 100), ["series"])
    groups = spark.createDataFrame([("a",), ("b",), (None,)], "series string")
    rows = steps.or_zero(found, groups, grid, ["series"], ["total", "mean", "up"]).collect()
    assert len(rows) == 12 and {(r.series, round(r.step.timestamp()) - BEGIN, r.total, r.up) for r in rows if r.up} == {("a", 100, 2.0, 1)}


def test_one_series_is_sorted_by_many_tasks(spark):
    rows = spark.range(20_000).select(F.lit("a").alias("series"), F.timestamp_seconds(F.col("id") + BEGIN).alias("ts"), F.col("id").cast("double").alias("value"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = steps.with_previous(rows, ["series"], 500).withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["count"] for r in placed) == 20_000 and len(placed) == 4 and max(r["count"] for r in placed) < 12_000


def test_stream_of_shuffled_samples_equals_the_table(spark, tmp_path):
    rng = random.Random(3)
    rows = [r for r in made(5, 80) if r[1] is not None and r[2] is not None]
    shuffled = sorted(rows, key=lambda r: r[1] + timedelta(seconds=rng.randrange(600)))
    (tmp_path / "in").mkdir()
    folder = str(tmp_path / "in")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)

    def send(part):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        rates.run_available(counters.counter_increases(stream, ["series"], "10 minutes"), str(tmp_path / "out"), str(tmp_path / "cp"))

    for a in range(0, len(shuffled), 90):
        send(shuffled[a : a + 90])
    send([("end", at(10**6), 1.0)])
    send([("a", at(3), 99.0)])  # too late
    shown = lambda df: sorted(((r.series, r.ts, r.value, r.increase) for r in df.collect()), key=repr)
    table = spark.createDataFrame(rows, SCHEMA)
    plain = serving.counter_increases(steps.with_previous(table, ["series"], 10**7).drop("before_ts", "before_value"), ["series"])
    got = shown(spark.read.parquet(str(tmp_path / "out")))
    assert [x[:3] for x in got] == [x[:3] for x in shown(plain)]
    want = defaultdict(float)
    for name, samples in usable(rows).items():
        want[name] = sum(v if v < u else v - u for (_, u), (_, v) in zip(samples, samples[1:]))
    total = defaultdict(float)
    for name, _, _, gained in got:
        total[name] += gained
    assert total == want
