"""Chunks of videos, and the frames that stand for evenly spaced times.

Two forms with the same results: arrays of frame times per video with a small numpy helper, and long tables with an as-of
join, for videos whose frames don't fit a row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.manifest import reject

MAX_CHUNK_MS, OVERLAP_MS = 120_000, 8_000
MAX_FPS, MAX_TARGETS = 240.0, 100_000
#: Ranges whose targets are made in one go, so that a batch stays below some million rows.
TARGET_ROWS = 64


def build_chunks(videos: DataFrame, max_chunk_ms: int = MAX_CHUNK_MS, overlap_ms: int = OVERLAP_MS) -> DataFrame:
    """``video_id, duration_ms`` with ``chunk_id, chunk_start_ms, chunk_end_ms``: steps of length less overlap, up to the end."""
    if max_chunk_ms <= 0 or not 0 <= overlap_ms < max_chunk_ms:
        raise ValueError("chunks need a positive length and an overlap below it")
    step = max_chunk_ms - overlap_ms
    n = F.when(F.col("duration_ms") <= max_chunk_ms, 1).otherwise(F.ceil((F.col("duration_ms") - max_chunk_ms) / step) + 1).cast("int")
    each = videos.select("video_id", "duration_ms", F.explode(F.sequence(F.lit(0), n - 1)).alias("i"))
    start = F.col("i").cast("bigint") * step
    return each.select("video_id", "duration_ms", F.format_string("chunk-%04d", "i").alias("chunk_id"), start.alias("chunk_start_ms"), F.least(start + max_chunk_ms, F.col("duration_ms")).alias("chunk_end_ms"))


def short_video_gate(chunks: DataFrame) -> DataFrame:
    """Rejects for videos of more than one chunk."""
    n = chunks.groupBy("video_id").agg(F.count("*").alias("n")).where("n != 1")
    return reject(n, "chunk", "not_one_chunk", F.col("n").cast("string"))


def sampling_fault(fps: Column, start: Column, end: Column) -> Column:
    """Why a range can't be sampled, checked before any target is made; else null."""
    step = F.lit(1000.0) / fps
    return F.when(fps.isNull() | F.isnan(fps) | (fps <= 0) | (fps == float("inf")), "bad_fps").when(fps > MAX_FPS, "fps_too_high").when(end - start > MAX_TARGETS * step, "too_many_targets")


def target_times(start: float, end: float, fps: float) -> np.ndarray:
    """Times from ``start`` in steps added one after the other in floating point, each rounded half to even.

    The sum drifts, and the drift may put one more target before the end: it is part of the rule.
    """
    step = 1000.0 / fps
    n = int(math.ceil((end - start) / step)) + 2
    times = np.add.accumulate(np.concatenate([[float(start)], np.full(n, step)]))
    return np.rint(times[times < end]).astype(np.int64)


def nearest_frames(pts: np.ndarray, start: int, end: int, fps: float) -> np.ndarray:
    """Frames in ``[start, end)`` nearest to the targets, the earlier one on a tie; ascending and distinct."""
    own = pts[np.searchsorted(pts, start) : np.searchsorted(pts, end)]
    if not len(own):
        return own
    at = target_times(start, end, fps)
    after = np.clip(np.searchsorted(own, at), 0, len(own) - 1)
    before = np.maximum(after - 1, 0)
    return np.unique(np.where(np.abs(own[before] - at) <= np.abs(own[after] - at), own[before], own[after]))


def sample_ranges(ranges: DataFrame, fps: float, start: str = "chunk_start_ms", end: str = "chunk_end_ms", pts: str = "pts") -> DataFrame:
    """``ranges`` without ``pts``, with ``samples`` (source times); empty where the range has no frame."""
    kept = ranges.drop("samples")
    schema = kept.drop(pts).limit(0).selectExpr("*", "cast(null as array<bigint>) samples").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [n for n in batch.schema.names if n != pts]
            found = [nearest_frames(np.asarray(p.values), s, e, fps) for p, s, e in zip(batch.column(pts), batch.column(start).to_pylist(), batch.column(end).to_pylist())]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(found, pa.list_(pa.int64()))], names=[*names, "samples"])

    return kept.mapInArrow(run, schema)


def sample_windows(windows: DataFrame, frames: DataFrame, fps: float, start: str = "window_start_ms", end: str = "window_end_ms") -> DataFrame:
    """``windows`` (``video_id`` and any columns) with ``samples``, as :func:`sample_ranges` gives them, from ``frames`` (``video_id, pts``).

    A video's windows meet its frames in one row, so the frames travel once for each video and are cut for all its windows in one pass.
    """
    rest = [c for c in windows.columns if c not in ("video_id", "samples")]
    gathered = windows.groupBy("video_id").agg(F.collect_list(F.struct(*rest)).alias("windows")).join(frames.select("video_id", "pts"), "video_id")
    schema = windows.limit(0).selectExpr("video_id", *(f"`{c}`" for c in rest), "cast(null as array<bigint>) samples").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("windows")
            each = lists.flatten()
            sizes = np.diff(lists.offsets.to_numpy())
            found, at = [], 0
            bounds = list(zip(each.field(start).to_pylist(), each.field(end).to_pylist()))
            for pts, n in zip(batch.column("pts"), sizes.tolist()):
                own = np.asarray(pts.values)
                found += [nearest_frames(own, s, e, fps) for s, e in bounds[at : at + n]]
                at += n
            owner = batch.column("video_id").take(pa.array(np.repeat(np.arange(batch.num_rows), sizes)))
            yield pa.RecordBatch.from_arrays([owner, *(each.field(c) for c in rest), pa.array(found, pa.list_(pa.int64()))], names=["video_id", *rest, "samples"])

    return gathered.mapInArrow(run, schema)


def guarded(ranges: DataFrame, fps: float, start: str = "chunk_start_ms", end: str = "chunk_end_ms", item: str = "chunk_id") -> tuple[DataFrame, DataFrame]:
    """The ranges that can be sampled at ``fps``, and rejects for the others."""
    fault = sampling_fault(F.lit(float(fps)), F.col(start), F.col(end))
    judged = ranges.withColumn("fault", fault)
    return judged.where("fault is null").drop("fault"), reject(judged.where("fault is not null"), "sampling", F.col("fault"), F.col(item), item=F.col(item))


def targets_table(ranges: DataFrame, fps: float, start: str = "chunk_start_ms", end: str = "chunk_end_ms") -> DataFrame:
    """``ranges`` with a row for each ``target_ms``; ranges that can't be sampled have none."""
    good, _ = guarded(ranges.drop("target_ms"), fps, start, end, start)
    schema = good.limit(0).selectExpr("*", "0L target_ms").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in range(0, batch.num_rows, TARGET_ROWS):
                rows = batch.slice(part, TARGET_ROWS)
                times = [target_times(s, e, fps) for s, e in zip(rows.column(start).to_pylist(), rows.column(end).to_pylist())]
                taken = rows.take(pa.array(np.repeat(np.arange(len(times)), [len(t) for t in times])))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(np.concatenate(times))], names=schema.names)

    return good.mapInArrow(run, schema)


def frames_in_ranges(ranges: DataFrame, frames: DataFrame, bin_ms: int, start: str = "chunk_start_ms", end: str = "chunk_end_ms") -> DataFrame:
    """``ranges`` joined to ``frames`` (``video_id, pts_ms``) in ``[start, end)``: an equi-join on bins of time, then the exact test.

    Ranges are made from few rows (a video's), by which their size is misjudged, and grow with the videos: they are never broadcast.
    """
    binned = ranges.withColumn("bin", F.explode(F.sequence(F.floor(F.col(start) / bin_ms), F.floor((F.col(end) - 1) / bin_ms))))
    placed = frames.withColumn("bin", F.floor(F.col("pts_ms") / bin_ms))
    return binned.hint("merge").join(placed, ["video_id", "bin"]).where((F.col("pts_ms") >= F.col(start)) & (F.col("pts_ms") < F.col(end))).drop("bin")


def frames_of_targets(inside: DataFrame, fps: float, by: list[str], start: str = "chunk_start_ms", end: str = "chunk_end_ms") -> DataFrame:
    """The rows of ``inside`` (distinct ``pts_ms`` of ranges, each range one of ``by``) that are nearest to a target of their range, the earlier one on a tie.

    A frame has the targets from the middle to the frame before, which is left out, up to the middle to the frame after. Rows are
    judged one by one with these two, so nothing grows with the targets, nor a task with a range. Ranges that can't be sampled have none.
    """
    order = Window.partitionBy(*by).orderBy("pts_ms")
    middle = lambda other: F.floor((F.col("pts_ms") + other) / 2)
    good, _ = guarded(inside, fps, start, end, start)
    names = inside.columns
    near = good.withColumn("above", middle(F.lag("pts_ms").over(order))).withColumn("up_to", middle(F.lead("pts_ms").over(order)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds = np.stack([batch.column(start).to_numpy(), batch.column(end).to_numpy()], axis=1)
            ranges, of = np.unique(bounds, axis=0, return_inverse=True)
            rows = np.split(np.argsort(of, kind="stable"), np.cumsum(np.bincount(of, minlength=len(ranges)))[:-1])
            above, up_to = batch.column("above").fill_null(-(1 << 62)).to_numpy(), batch.column("up_to").fill_null(1 << 62).to_numpy()
            chosen = np.zeros(batch.num_rows, bool)
            for (s, e), own in zip(ranges.tolist(), rows):
                at = target_times(s, e, fps)
                chosen[own] = np.searchsorted(at, up_to[own], "right") > np.searchsorted(at, above[own], "right")
            yield batch.filter(pa.array(chosen)).select(names)

    return near.mapInArrow(run, inside.schema)


def ranges_without_frames(ranges: DataFrame, inside: DataFrame) -> DataFrame:
    """Rejects for ranges (``video_id, chunk_id``) in which no frame lies."""
    empty = ranges.join(inside.select("video_id", "chunk_id").distinct(), ["video_id", "chunk_id"], "left_anti")
    return reject(empty, "sampling", "no_frame", F.col("chunk_id"), item=F.col("chunk_id"))


def nearest_as_of(targets: DataFrame, inside: DataFrame, by: list[str]) -> DataFrame:
    """The frame nearest to each target within its range, earlier on a tie: both tables in one order, looked at both ways.

    ``by, target_ms`` and ``by, pts_ms`` give ``by, target_ms, pts_ms``. One shuffle, no pair of target and frame is made.
    """
    mixed = targets.select(*by, F.col("target_ms").alias("t"), F.lit(None).cast("bigint").alias("pts")).unionByName(inside.select(*by, F.col("pts_ms").alias("t"), F.col("pts_ms").alias("pts")))
    order = Window.partitionBy(*by).orderBy("t")
    near = mixed.withColumn("before", F.last("pts", ignorenulls=True).over(order.rangeBetween(Window.unboundedPreceding, 0))).withColumn("after", F.first("pts", ignorenulls=True).over(order.rangeBetween(0, Window.unboundedFollowing)))
    chosen = F.when(F.col("after").isNull() | (F.col("t") - F.col("before") <= F.col("after") - F.col("t")), F.col("before")).otherwise(F.col("after"))
    return near.where(F.col("pts").isNull()).select(*by, F.col("t").alias("target_ms"), chosen.alias("pts_ms")).where(F.col("pts_ms").isNotNull())


def sample_points(nearest: DataFrame, by: list[str], start: str = "chunk_start_ms") -> DataFrame:
    """Distinct ``source_timestamp_ms`` with the time in its chunk. ``by`` includes the chunk's start."""
    return nearest.select(*by, F.col("pts_ms").alias("source_timestamp_ms"), (F.col("pts_ms") - F.col(start)).alias("chunk_timestamp_ms")).distinct()
