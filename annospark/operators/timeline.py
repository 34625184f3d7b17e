"""Finalising a timeline: id checks, boundary shifts, merging of equal neighbours, overlap conflicts, quality.

Segments are rows ``video_id, segment_id, start_ms, end_ms, values (map), sentence, evidence (array)``. All windows are by
``video_id``, so input that is partitioned by it is shuffled no further. Where one video can hold a large part of all segments,
``long=True`` scans ranges of time instead, with the same results; it writes the segments once below ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.intervals import islands
from ..functions.ordered import islands_by_ranges
from ..sources.manifest import reject

ORDER = ["start_ms", "end_ms", "segment_id"]
SHIFT_LIMIT_MS = 2_000


def _label() -> Column:
    return F.struct(F.array_sort(F.map_entries("values")).alias("values"), F.col("sentence"))


def duplicate_ids(segments: DataFrame, side: str) -> DataFrame:
    """A reject for each video with ids that occur more than once, which it lists in order."""
    twice = segments.groupBy("video_id", "segment_id").agg(F.count("*").alias("n")).where("n > 1")
    return reject(twice.groupBy("video_id").agg(F.array_join(F.array_sort(F.collect_list("segment_id")), ", ").alias("ids")), "finalise", f"duplicate_{side}_ids", F.col("ids"))


def unequal_ids(coarse: DataFrame, refined: DataFrame) -> DataFrame:
    """A reject for each video whose coarse and refined segments have different ids, with both lists."""
    sides = coarse.select("video_id", "segment_id", F.lit(1).alias("c"), F.lit(0).alias("r")).union(refined.select("video_id", "segment_id", F.lit(0), F.lit(1)))
    each = sides.groupBy("video_id", "segment_id").agg(F.max("c").alias("c"), F.max("r").alias("r")).where("c != r")
    listed = lambda side: F.array_join(F.array_sort(F.collect_list(F.when(F.col(side) == 1, F.col("segment_id")))), ", ")
    return reject(each.groupBy("video_id").agg(F.concat(F.lit("coarse only: "), listed("c"), F.lit("; refined only: "), listed("r")).alias("m")), "finalise", "unequal_ids", F.col("m"))


def blank_sentences(segments: DataFrame) -> DataFrame:
    blank = segments.where(F.col("sentence").isNull() | F.col("sentence").rlike(r"^(?U)\s*$"))
    return reject(blank, "finalise", "blank_sentence", F.col("segment_id"), item=F.col("segment_id"))


def boundary_shifts(coarse: DataFrame, refined: DataFrame) -> DataFrame:
    """``video_id, segment_id, shift_ms``: the larger move of a segment's two ends, before any merging."""
    before = coarse.select("video_id", "segment_id", F.col("start_ms").alias("s"), F.col("end_ms").alias("e"))
    return refined.join(before, ["video_id", "segment_id"]).select("video_id", "segment_id", F.greatest(F.abs(F.col("start_ms") - F.col("s")), F.abs(F.col("end_ms") - F.col("e"))).alias("shift_ms"))


def _marked(segments: DataFrame, gap_ms: int, long: bool = False, ranges: int | None = None) -> DataFrame:
    if long:
        return islands_by_ranges(segments, ["video_id"], ORDER, "start_ms", "end_ms", _label(), gap_ms, ranges)
    return islands(segments, ["video_id"], ORDER, "start_ms", "end_ms", _label(), gap_ms)


def merge_segments(segments: DataFrame, gap_ms: int = 250, long: bool = False, ranges: int | None = None) -> DataFrame:
    """Neighbours in order ``(start, end, id)`` with equal values and sentence, at most ``gap_ms`` apart (or overlapping), as one.

    The first one's id stays; ``sources`` lists all ids of a merged segment and is null for others. A merged segment's
    evidence is sorted and distinct, that of others is as it was.
    """
    place = F.struct(*ORDER)
    members = F.array_sort(F.collect_list(F.struct(*ORDER)))
    evidence = F.when(F.count("*") == 1, F.min_by("evidence", place)).otherwise(F.array_sort(F.array_distinct(F.flatten(F.collect_list("evidence")))))
    return (
        _marked(segments, gap_ms, long, ranges)
        .groupBy("video_id", "island")
        .agg(
            F.min_by("segment_id", place).alias("segment_id"),
            F.min("start_ms").alias("start_ms"),
            F.max("end_ms").alias("end_ms"),
            F.min_by("values", place).alias("values"),
            F.min_by("sentence", place).alias("sentence"),
            evidence.alias("evidence"),
            F.when(F.count("*") > 1, F.transform(members, lambda m: m["segment_id"])).alias("sources"),
        )
        .drop("island")
    )


def _long_conflicts(segments: DataFrame, gap_ms: int, ranges: int | None) -> DataFrame:
    marked = _marked(segments, gap_ms, True, ranges).withColumn("same_values", F.array_sort(F.map_entries("values")).eqNullSafe(F.col("label_before")["values"]))
    place = F.struct(*ORDER)
    heads = marked.groupBy("video_id", "island").agg(F.min_by(F.struct(*ORDER, "reach", "same_values"), place).alias("x"))  # partial within ranges
    clash = heads.where((F.col("island") > 1) & (F.col("x.start_ms") < F.col("x.reach")))
    first = clash.groupBy("video_id").agg(F.min(F.struct("island", "x")).alias("y")).select("video_id", "y.x", (F.col("y.island") - 1).alias("island"))
    before = heads.select(F.col("video_id").alias("v"), F.col("island").alias("i"), F.col("x.segment_id").alias("head_id"))
    kind = F.when(F.col("x.same_values"), "different-sentence").otherwise("different-label")
    return first.join(before, F.col("video_id").eqNullSafe(F.col("v")) & (F.col("island") == F.col("i"))).select("video_id", kind.alias("kind"), "head_id", "x.segment_id")


def conflicts(segments: DataFrame, gap_ms: int = 250, long: bool = False, ranges: int | None = None) -> DataFrame:
    """``video_id, kind, head_id, segment_id`` of each video's first overlap that merging can't resolve.

    The head is the first member of the merged segment before. Found on the same windows as the merge, without it.
    """
    if long:
        return _long_conflicts(segments, gap_ms, ranges)
    window = Window.partitionBy("video_id").orderBy(*ORDER)
    values = F.array_sort(F.map_entries("values"))
    marked = _marked(segments, gap_ms).withColumn("same_values", values.eqNullSafe(F.lag(values).over(window)))
    opens = F.col("island") > F.coalesce(F.lag("island").over(window), F.lit(0))
    headed = marked.withColumn("opens", opens).withColumn("head", F.last(F.when(F.col("opens"), F.col("segment_id")), ignorenulls=True).over(window))
    found = headed.withColumn("head_id", F.lag("head").over(window)).where(F.col("opens") & (F.col("start_ms") < F.col("reach")))
    kind = F.when(F.col("same_values"), "different-sentence").otherwise("different-label")
    first = found.groupBy("video_id").agg(F.min(F.struct(*ORDER, kind.alias("kind"), "head_id")).alias("x"))
    return first.select("video_id", "x.kind", "x.head_id", "x.segment_id")


def timeline_faults(segments: DataFrame, durations: DataFrame) -> DataFrame:
    """Rejects for segments that end after their video (``video_id, duration_ms``) or start before the end of an earlier one."""
    from ..functions.intervals import running_end

    placed = segments.withColumn("reach", running_end("end_ms", ["video_id"], ORDER)).join(durations.select("video_id", "duration_ms"), "video_id")
    code = F.when(F.col("start_ms") < F.col("reach"), "overlap").when(F.col("end_ms") > F.col("duration_ms"), "after_duration").when(F.col("end_ms") <= F.col("start_ms"), "empty_interval")
    return reject(placed.withColumn("code", code).where("code is not null"), "finalise", F.col("code"), F.col("segment_id"), item=F.col("segment_id"))


def quality(videos: DataFrame, merged: DataFrame, shifts: DataFrame, min_segment_ms: int = 300) -> DataFrame:
    """``video_id, score, max_boundary_shift_ms, segment_count, empty_timeline, merged_segment_sources, review_reasons``.

    One row for every row of ``videos``, without segments too. Each reason costs 0.2.
    """
    segment = merged.groupBy("video_id").agg(
        F.count("*").cast("int").alias("n"),
        F.max(F.col("end_ms") - F.col("start_ms") < min_segment_ms).alias("short"),
        F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("sources").isNotNull(), F.struct("segment_id", "sources"))))).alias("sources"),
    )
    shift = shifts.groupBy("video_id").agg(F.max("shift_ms").alias("shift"))
    joined = videos.select("video_id").join(segment, "video_id", "left").join(shift, "video_id", "left")
    most = F.coalesce("shift", F.lit(0)).cast("bigint")
    reasons = F.array_compact(F.array(F.when(most > SHIFT_LIMIT_MS, "boundary_shift_gt_2s"), F.when(F.coalesce("short", F.lit(False)), "segment_shorter_than_minimum")))
    count = F.coalesce("n", F.lit(0))
    return joined.select(
        "video_id",
        F.greatest(F.lit(0.0), 1 - 0.2 * F.size(reasons)).alias("score"),
        most.alias("max_boundary_shift_ms"),
        count.alias("segment_count"),
        (count == 0).alias("empty_timeline"),
        F.coalesce("sources", F.expr("cast(map() as map<string,array<string>>)")).alias("merged_segment_sources"),
        reasons.alias("review_reasons"),
    )
