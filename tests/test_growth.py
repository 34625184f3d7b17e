"""Steps that must grow with their input: nothing large is broadcast, nothing costly is computed again for every use."""

import itertools
import random
from collections import defaultdict
from datetime import datetime, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from annospark.functions.once import once
from annospark.operators import responses, sampling, steps
from annospark.plans import catalog
from annospark.plans.annotation_queries import EVENT_CONTRACT
from annospark.sources import manifest

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().toString()


def optimised(df):
    return df._jdf.queryExecution().optimizedPlan().toString().lower().replace("parsejson", "parse_json")


def test_response_schemas_read_their_chunks_once(spark):
    assert "Join" not in plan_of(catalog.QUERIES["response_schemas"](spark, FOLDER))


def test_ranges_are_not_broadcast_to_frames(spark):
    ranges = spark.createDataFrame([("v", "c0", 0, 10), ("v", "c1", 8, 12)], "video_id string, chunk_id string, chunk_start_ms long, chunk_end_ms long")
    frames = spark.createDataFrame([("v", 3), ("v", 8), ("v", 12), ("w", 1)], "video_id string, pts_ms long")
    inside = sampling.frames_in_ranges(ranges, frames, 5)
    assert "Broadcast" not in plan_of(inside)
    assert sorted((r.chunk_id, r.pts_ms) for r in inside.collect()) == [("c0", 3), ("c0", 8), ("c1", 8)]


def test_a_value_made_once_is_not_copied_into_its_uses(spark):
    rows = once(spark.createDataFrame([('{"a":1}',), ("x",)], "value string"), json=F.try_parse_json("value"))
    used = rows.withColumn("n", F.try_variant_get("json", "$.a", "int")).where("n = 1 or json is null").select("n", F.to_json("json").alias("j"))
    assert optimised(used).count("parse_json") == 1
    assert sorted(map(tuple, used.collect()), key=repr) == [(1, '{"a":1}'), (None, None)]


def test_manifest_lines_are_parsed_once(spark):
    lines = spark.createDataFrame([('{"video_id":"v","video_uri":"a/../b.mp4","dataset_id":"d","schema_version":"s","ontology_id":"o"}',), ("{oops",), (" ",)], "value string")
    items, bad = manifest.parse_manifest(lines, "/data")
    for found in (items.where("path like '/data/%'"), bad.groupBy("code").count()):
        assert optimised(found).count("parse_json") <= 1
    assert [tuple(r) for r in items.collect()] == [("v", "a/../b.mp4", "d", "s", "o", "{}", "{}", "/data/b.mp4")]
    assert [r.code for r in bad.collect()] == ["not_json"]


def test_responses_are_parsed_once(spark):
    segment = '{"segment_id":"s","start_ms":0,"end_ms":%s,"values":{"action":"view"},"sentence":"x","evidence_timestamps_ms":[1]}'
    texts = ['{"task_summary":"t","segments":[' + segment % end + "]}" for end in ("5", "5.0", "11")] + ["{oops"]
    answered = spark.createDataFrame([(f"r{i}", f"v{i}", 0, 10, t) for i, t in enumerate(texts)], "request_id string, video_id string, media_start_ms long, media_end_ms long, response string")
    good, bad = responses.coarse_segments(answered, EVENT_CONTRACT)
    assert optimised(good).count("parse_json") == 1 and optimised(bad).count("parse_json") <= 2
    assert [(r.video_id, r.start_ms, r.end_ms) for r in good.collect()] == [("v0", 0, 5)]
    assert sorted((r.video_id, r.code) for r in bad.collect()) == [("v1", "bad_segment"), ("v2", "bad_bounds"), ("v3", "bad_response")]


@pytest.mark.parametrize("whole", [False, True])
def test_buckets_are_added_up_before_they_are_dealt_to_steps(spark, whole):
    rng, bounds = random.Random(4), [1.0, 5.0, float("inf")]
    rows, counts = [], defaultdict(lambda: [0.0] * 3)
    for s in sorted(rng.sample(range(9000), 600)):
        series, kind = rng.randrange(9), rng.choice("ab")
        if rng.random() < 0.05:
            counts.pop((series, kind), None)  # begins anew
        x = rng.random() * 8
        counts[series, kind] = [n + (x <= le) for n, le in zip(counts[series, kind], bounds)]
        rows.append((series, kind, datetime.fromtimestamp(1_700_000_000 + s, timezone.utc), counts[series, kind]))
    table = spark.createDataFrame(rows, "series int, kind string, ts timestamp, value array<double>")
    each = table.select("series", "kind", "ts", F.posexplode("value").alias("i", "value")).withColumn("le", F.element_at(F.array(*map(F.lit, bounds)), F.col("i") + 1)).drop("i")
    found = steps.histogram_steps(table if whole else each, ["series", "kind"], ["kind"], 0.9, 60, 600, 300, *([bounds] if whole else []))
    steps_made = optimised(found).split("generate explode(sequence")[1]
    assert "aggregate [kind" in steps_made.split("\n")[1] + steps_made.split("\n")[2] and "series" not in "".join(steps_made.split("\n")[1:3])
    gained = defaultdict(lambda: defaultdict(float))  # by plain loops
    for (series, kind), own in itertools.groupby(sorted(rows), lambda r: r[:2]):
        for (_, _, t, u), (_, _, now, v) in itertools.pairwise(own):
            for step in range(-(-int(now.timestamp()) // 60) * 60, int(t.timestamp()) + 600, 60):
                for le, a, b in zip(bounds, u, v):
                    gained[kind, step][le] += b if b < a else b - a
    want = {}
    for key, n in gained.items():
        target, low, under = 0.9 * n[bounds[-1]], 0.0, 0.0
        for le in bounds:
            if n[bounds[-1]] and n[le] >= target:
                want[key] = low if le == bounds[-1] else low + (le - low) * (target - under) / (n[le] - under)
                break
            low, under = le, n[le]
    assert {(r.kind, int(r.step.timestamp())): round(r.value, 9) for r in found.collect()} == {k: round(v, 9) for k, v in want.items()}


def test_frames_of_targets_are_the_nearest_without_a_row_for_each_target(spark):
    rng, ranges = random.Random(6), [("v", f"c{i}", s, e) for i, (s, e) in enumerate([(0, 900), (800, 3001), (3000, 3007), (5000, 90_000), (7, 8)])] + [("w", "c0", 0, 900)]
    pts = {"v": sorted({rng.randrange(95_000) for _ in range(300)} | {0, 1, 7, 899, 3000, 3006}), "w": [450]}
    table = spark.createDataFrame(ranges, "video_id string, chunk_id string, chunk_start_ms long, chunk_end_ms long")
    inside = sampling.frames_in_ranges(table, spark.createDataFrame([(v, p) for v, own in pts.items() for p in own], "video_id string, pts_ms long"), 5000)
    for fps in (0.5, 3.0, 7.3, 240.0):
        found = sampling.frames_of_targets(inside, fps, ["video_id", "chunk_id"])
        assert "MapInArrow" in plan_of(found).split("Union")[0] and "Union" not in plan_of(found)
        want = [(v, c, p) for v, c, s, e in ranges for p in sampling.nearest_frames(np.array(pts[v]), s, e, fps).tolist()]
        assert sorted((r.video_id, r.chunk_id, r.pts_ms) for r in found.collect()) == sorted(want)
    assert sampling.frames_of_targets(inside, 300.0, ["video_id", "chunk_id"]).count() == 0  # can't be sampled


def test_sample_plan_makes_no_row_for_each_target(spark):
    plan = plan_of(catalog.QUERIES["sample_plan"](spark, FOLDER))
    assert plan.index("MapInArrow") < plan.index("Window") and "target_ms" not in plan
