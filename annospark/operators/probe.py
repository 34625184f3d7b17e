"""Normalising probe documents: one JSON text per video, as a media prober prints it. No shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import finite, half_even
from ..functions.once import once
from ..sources.manifest import reject

PROBE = "struct<streams:array<struct<width:string,height:string,avg_frame_rate:string,duration:string,start_time:string>>,format:struct<duration:string>,frames:array<struct<best_effort_timestamp_time:string>>>"


def _duration(seconds: Column) -> Column:
    value = finite(seconds)
    return F.when((value > 0) & (half_even(value * 1000) > 0), half_even(value * 1000))


def _rate(text: Column) -> Column:
    """Frames a second written as a ratio of whole numbers or as a decimal, if positive."""
    parts = F.split(text, "/")
    top, below = finite(F.element_at(parts, 1)), finite(F.try_element_at(parts, F.lit(2)))
    ratio = F.when(text.rlike(r"^\s*[+-]?\d+/\d+\s*$"), F.when(below != 0, top / below)).when(F.size(parts) == 1, top)
    return F.when((ratio > 0) & (ratio < F.lit(float("inf"))), ratio)


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _median_gap(pts: Column) -> Column:
    middle = lambda g: (F.element_at(g, F.floor((F.size(g) + 1) / 2).cast("int")) + F.element_at(g, F.floor(F.size(g) / 2).cast("int") + 1)) / 2.0
    gaps = lambda p: F.array_sort(F.zip_with(F.slice(p, F.lit(2), F.size(p) - 1), F.slice(p, F.lit(1), F.size(p) - 1), lambda x, y: x - y))
    return _let(pts, lambda p: F.when(F.size(p) > 1, _let(gaps(p), middle)))


def _frame_times(frames: Column, start: Column) -> Column:
    """Distinct ascending milliseconds from the stream's start, or else from the earliest frame."""
    times = F.filter(F.transform(frames, lambda f: finite(f["best_effort_timestamp_time"])), lambda t: t.isNotNull())
    since = lambda ts, origin: F.filter(F.transform(ts, lambda t: half_even((t - origin) * 1000)), lambda t: t >= 0)
    return F.array_sort(F.array_distinct(_let(F.coalesce(times, F.expr("cast(array() as array<double>)")), lambda ts: _let(F.coalesce(finite(start), F.array_min(ts)), lambda origin: since(ts, origin)))))


def normalise(probes: DataFrame, column: str = "probe") -> tuple[DataFrame, DataFrame]:
    """``video_id, duration_ms, width, height, nominal_fps, pts`` and the rejects, from ``video_id`` and a JSON column.

    Durations come from the stream, else the container. Frame times count from the stream's start or else the earliest
    frame; earlier ones go; they are distinct and ascending. Rates come from the stream, else from the median gap.
    """
    parsed = once(probes.select("video_id", F.col(column)), p=F.from_json(column, PROBE)).withColumn("stream", F.try_element_at("p.streams", F.lit(1)))
    rows = once(parsed, pts=_frame_times(F.col("p.frames"), F.col("stream.start_time")))
    rows = rows.withColumn("duration_ms", F.coalesce(_duration(F.col("stream.duration")), _duration(F.col("p.format.duration"))))
    rows = rows.withColumn("nominal_fps", F.coalesce(_rate(F.col("stream.avg_frame_rate")), _let(_median_gap(F.col("pts")), lambda gap: F.when(gap > 0, F.lit(1000.0) / gap))))
    rows = rows.withColumn("width", F.col("stream.width").try_cast("int")).withColumn("height", F.col("stream.height").try_cast("int"))
    code = (
        F.when(F.coalesce(F.size("p.streams"), F.lit(0)) != 1, "not_one_stream")
        .when(F.col("duration_ms").isNull(), "no_duration")
        .when(F.size("pts") == 0, "no_frames")
        .when(F.col("nominal_fps").isNull(), "no_rate")
        .when(~F.coalesce((F.col("width") > 0) & (F.col("height") > 0), F.lit(False)), "no_size")
    )
    judged = rows.withColumn("code", code)
    good = judged.where(F.col("code").isNull()).select("video_id", "duration_ms", "width", "height", "nominal_fps", "pts")
    return good, reject(judged.where(F.col("code").isNotNull()), "probe", F.col("code"), F.substring(column, 1, 200))
