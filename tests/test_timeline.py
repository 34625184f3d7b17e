"""Merging, conflicts and quality: worked examples, and windows against a plain fold."""

import random

import pytest

from annospark.operators import timeline

SCHEMA = "video_id string, segment_id string, start_ms bigint, end_ms bigint, values map<string,string>, sentence string, evidence array<bigint>"


def seg(i, start, end, action="grasp", sentence="take", evidence=(), video="v"):
    return (video, i, start, end, {"action": action}, sentence, list(evidence))


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_merges_within_gap_and_keeps_others(spark):
    rows = [seg("s1", 1000, 2000, evidence=[1500]), seg("s2", 2250, 3000, evidence=[2800, 2300]), seg("s3", 4000, 5000, evidence=[4500, 4500])]
    found = {r.segment_id: r for r in timeline.merge_segments(frame(spark, rows)).collect()}
    assert set(found) == {"s1", "s3"}
    assert (found["s1"].start_ms, found["s1"].end_ms, found["s1"].sources, found["s1"].evidence) == (1000, 3000, ["s1", "s2"], [1500, 2300, 2800])
    assert found["s3"].sources is None and found["s3"].evidence == [4500, 4500]


def test_one_more_millisecond_does_not_merge(spark):
    assert timeline.merge_segments(frame(spark, [seg("s1", 1000, 2000), seg("s2", 2251, 3000)])).count() == 2


@pytest.mark.parametrize("second, kind", [(seg("s2", 3000, 5000, "place"), "different-label"), (seg("s2", 3000, 5000, sentence="other"), "different-sentence")])
def test_conflicts_are_named(spark, second, kind):
    assert [tuple(r) for r in timeline.conflicts(frame(spark, [seg("s1", 1000, 4000), second])).collect()] == [("v", kind, "s1", "s2")]


def test_quality_of_shifts_short_and_empty(spark):
    coarse = frame(spark, [seg("a", 1000, 3000, video="x"), seg("b", 1000, 1299, video="y")])
    refined = frame(spark, [seg("a", 3500, 5000, video="x"), seg("b", 1000, 1299, video="y")])
    videos = spark.createDataFrame([("x",), ("y",), ("z",)], "video_id string")
    found = {r.video_id: r for r in timeline.quality(videos, timeline.merge_segments(refined), timeline.boundary_shifts(coarse, refined)).collect()}
    assert (found["x"].score, found["x"].max_boundary_shift_ms, found["x"].review_reasons) == (0.8, 2500, ["boundary_shift_gt_2s"])
    assert (found["y"].score, found["y"].review_reasons) == (0.8, ["segment_shorter_than_minimum"])
    assert (found["z"].score, found["z"].max_boundary_shift_ms, found["z"].empty_timeline) == (1.0, 0, True)


def fold(rows, gap):
    """Merged timelines and the first conflict, one segment after the other."""
    out = []
    for _, i, start, end, values, sentence, _ in sorted(rows, key=lambda r: (r[2], r[3], r[1])):
        if out and out[-1][3:] == (values, sentence) and start - out[-1][2] <= gap:
            out[-1] = (out[-1][0], out[-1][1], max(out[-1][2], end), values, sentence)
        elif out and start < out[-1][2]:
            return None, (out[-1][0], i)
        else:
            out.append((i, start, end, values, sentence))
    return [(x[0], x[1], x[2]) for x in out], None


@pytest.mark.parametrize("parts", [1, 5])
def test_windows_equal_a_fold(spark, parts):
    r = random.Random(3)
    rows = [seg(f"s{n}", s := r.randrange(0, 400), s + r.randrange(1, 40), r.choice("ab"), r.choice("xy"), video=f"v{v}") for v in range(150) for n in range(r.randrange(1, 7))]
    df = frame(spark, r.sample(rows, len(rows))).repartition(parts)
    clashes = {c.video_id: (c.head_id, c.segment_id) for c in timeline.conflicts(df, 10).collect()}
    merged = {}
    for m in timeline.merge_segments(df, 10).collect():
        merged.setdefault(m.video_id, []).append((m.segment_id, m.start_ms, m.end_ms))
    for v in {x[0] for x in rows}:
        want, clash = fold([x for x in rows if x[0] == v], 10)
        assert clashes.get(v) == clash
        if clash is None:
            assert sorted(merged[v], key=lambda m: m[1]) == want


def test_id_checks_and_faults(spark):
    a = frame(spark, [seg("s1", 0, 10), seg("s1", 20, 30), seg("s2", 40, 50, sentence=" 　")])
    assert [r.message for r in timeline.duplicate_ids(a, "coarse").collect()] == ["s1"]
    assert [r.message for r in timeline.unequal_ids(a, frame(spark, [seg("s2", 0, 1), seg("s3", 0, 1)])).collect()] == ["coarse only: s1; refined only: s3"]
    assert [r.message for r in timeline.blank_sentences(a).collect()] == ["s2"]
    ends = spark.createDataFrame([("v", 45)], "video_id string, duration_ms bigint")
    assert [(r.code, r.message) for r in timeline.timeline_faults(a, ends).collect()] == [("after_duration", "s2")]


@pytest.mark.parametrize("ranges", [1, 3, 7])
def test_ranges_of_a_long_timeline_equal_windows(spark, ranges):
    r = random.Random(ranges)
    rows = [seg(f"s{v}-{n}", s := r.randrange(0, 4000), s + r.randrange(1, 60), r.choice("ab"), r.choice("xy"), evidence=[s], video=v) for v, many in (("a", 5), ("long", 400), ("m", 60), (None, 30), ("z", 1)) for n in range(many)]
    # equal rows with one label over all ranges: one island, whose reach is set by its first segment
    rows += [seg(f"t{n}", n * 10, 9000 if n == 0 else n * 10 + 5, video="still") for n in range(120)]
    df = frame(spark, r.sample(rows, len(rows)))
    plain = lambda t: sorted(map(repr, t.collect()))
    assert plain(timeline.merge_segments(df, 15, long=True, ranges=ranges)) == plain(timeline.merge_segments(df, 15).select("video_id", "segment_id", "start_ms", "end_ms", "values", "sentence", "evidence", "sources"))
    assert plain(timeline.conflicts(df, 15, long=True, ranges=ranges)) == plain(timeline.conflicts(df, 15))


def test_ranges_of_no_segments(spark):
    assert timeline.merge_segments(frame(spark, []), long=True).count() == 0
    assert timeline.conflicts(frame(spark, []), long=True).count() == 0
