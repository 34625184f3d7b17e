"""Probes, chunks and samples: worked examples, and the as-of join against the helper."""

import json
import random

import numpy as np
import pytest

from annospark.operators import probe, sampling


def probed(spark, frames, rate="0/0", duration="2", start=None, container="9", streams=1):
    stream = {"width": "640", "height": 360, "avg_frame_rate": rate} | ({"duration": duration} if duration is not None else {}) | ({"start_time": start} if start else {})
    body = {"streams": [stream] * streams, "format": {"duration": container}, "frames": [{"best_effort_timestamp_time": f} for f in frames]}
    return probe.normalise(spark.createDataFrame([("v", json.dumps(body))], "video_id string, probe string"))


def test_start_time_and_repeats(spark):
    assert probed(spark, ["6.0", "5.5", "5.0", "5.5"], start="5.0")[0].first().pts == [0, 500, 1000]


@pytest.mark.parametrize("rate", ["0/0", "N/A", "-3", "inf"])
def test_rate_from_gaps(spark, rate):
    row = probed(spark, ["4.08", "4.0", "4.04"], rate)[0].first()
    assert (row.nominal_fps, row.pts) == (25.0, [0, 40, 80])


@pytest.mark.parametrize("duration", [None, "N/A", "0", "-1", "NaN", "inf", "1.0d"])
def test_duration_from_the_container(spark, duration):
    assert probed(spark, ["0", "1"], duration=duration, container="0.0625")[0].first().duration_ms == 62


@pytest.mark.parametrize("case, code", [({"streams": 2}, "not_one_stream"), ({"frames": ["N/A"]}, "no_frames"), ({"frames": ["1"]}, "no_rate"), ({"duration": "0", "container": "x"}, "no_duration")])
def test_probe_rejects(spark, case, code):
    assert [r.code for r in probed(spark, **({"frames": ["0", "1"]} | case))[1].collect()] == [code]


def chunk_table(spark, rows):
    return spark.createDataFrame([("v", "c", s, e, p) for s, e, p in rows], "video_id string, chunk_id string, chunk_start_ms bigint, chunk_end_ms bigint, pts array<bigint>")


@pytest.mark.parametrize("start, end, fps, pts, want", [(0, 2000, 2.0, [0, 490, 1010, 1510, 1990], [0, 490, 1010, 1510]), (0, 1000, 2.0, [100, 600, 1100], [100, 600]), (1000, 2000, 1.0, [900, 1100, 1900], [1100]), (0, 1000, 1.0, [], [])])
def test_sample_examples(spark, start, end, fps, pts, want):
    assert sampling.sample_ranges(chunk_table(spark, [(start, end, pts)]), fps).first().samples == want


def test_targets_drift():
    assert len(sampling.target_times(0, 4000, 6.0)) == 25 and sampling.target_times(0, 4000, 6.0)[-1] == 4000


def test_builtin_targets_equal_the_helper(spark):
    ranges = spark.createDataFrame([("v", s, s + n) for s in (0, 7, 1234567) for n in (1, 999, 4000)], "video_id string, chunk_start_ms bigint, chunk_end_ms bigint")
    for fps in (1.0, 6.0, 7.0, 24.0, 29.97):
        found = {}
        for r in sampling.targets_table(ranges, fps).collect():
            found.setdefault((r.chunk_start_ms, r.chunk_end_ms), []).append(r.target_ms)
        for (s, e), got in found.items():
            assert sorted(got) == sampling.target_times(s, e, fps).tolist()


def test_as_of_join_equals_the_helper(spark):
    r = random.Random(5)
    rows = [(f"v{i}", 0, 3000, sorted(r.sample(range(4000), r.randrange(1, 40)))) for i in range(40)]
    ranges = spark.createDataFrame([x[:3] for x in rows], "video_id string, chunk_start_ms bigint, chunk_end_ms bigint").selectExpr("*", "'c' as chunk_id")
    frames = spark.createDataFrame([(v, t) for v, _, _, p in rows for t in p], "video_id string, pts_ms bigint")
    by = ["video_id", "chunk_id", "chunk_start_ms"]
    near = sampling.nearest_as_of(sampling.targets_table(ranges, 3.0), sampling.frames_in_ranges(ranges, frames, 500), by)
    found = {}
    for x in sampling.sample_points(near, by).collect():
        found.setdefault(x.video_id, set()).add(x.source_timestamp_ms)
    for v, s, e, p in rows:
        assert sorted(found.get(v, [])) == sampling.nearest_frames(np.array(p), s, e, 3.0).tolist()


def test_chunks(spark):
    videos = spark.createDataFrame([("a", 100), ("b", 250), ("c", 251)], "video_id string, duration_ms bigint")
    found = [(r.video_id, r.chunk_id, r.chunk_start_ms, r.chunk_end_ms) for r in sampling.build_chunks(videos, 100, 25).orderBy("video_id", "chunk_id").collect()]
    assert found == [("a", "chunk-0000", 0, 100), ("b", "chunk-0000", 0, 100), ("b", "chunk-0001", 75, 175), ("b", "chunk-0002", 150, 250), ("c", "chunk-0000", 0, 100), ("c", "chunk-0001", 75, 175), ("c", "chunk-0002", 150, 250), ("c", "chunk-0003", 225, 251)]
    with pytest.raises(ValueError):
        sampling.build_chunks(videos, 100, 100)
