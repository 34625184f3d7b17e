"""Model responses as tables: attaching them to requests, strict checks, and absolute times."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.numbers import is_integer
from ..functions.once import once
from ..sources.contract import Contract
from ..sources.manifest import reject
from .values import value_problems

#: A backend takes requests and returns ``request_id, n, response``; the default joins a table of responses.
Backend = Callable[[DataFrame], DataFrame]


def numbered(requests: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Requests with ``n``, counted from 1 for each request id in ``order`` of calls."""
    return requests.withColumn("n", F.row_number().over(Window.partitionBy("request_id").orderBy(*(order or ["media_start_ms"]))))


def scripted(responses: DataFrame) -> Backend:
    """A backend that answers the n-th request of an id with the n-th response (``request_id, n, response``)."""
    return lambda requests: requests.join(responses.select("request_id", "n", "response"), ["request_id", "n"], "left")


def read_script(spark: SparkSession, path: str) -> DataFrame:
    """``request_id, n, response`` of a JSON file that maps request ids to lists of responses."""
    whole = spark.read.text(path, wholetext=True).select(F.parse_json("value").alias("json"))
    each = whole.select(F.explode(F.variant_get("json", "$", "map<string,variant>")).alias("request_id", "all"))
    return each.select("request_id", F.posexplode(F.variant_get("all", "$", "array<variant>")).alias("at", "one")).select("request_id", (F.col("at") + 1).alias("n"), F.to_json("one").alias("response"))


def attach(requests: DataFrame, backend: Backend) -> tuple[DataFrame, DataFrame]:
    """Requests with their response, and rejects for those without."""
    answered = backend(requests)
    missing = answered.where(F.col("response").isNull())
    return answered.where(F.col("response").isNotNull()), reject(missing, "response", "no_response", F.col("request_id"), item=F.col("request_id"))


def _kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def _get(path: str, kind: str = "variant") -> Column:
    return F.try_variant_get("json", path, kind)


def _keys_fault(keys: Column, wanted: list[str]) -> Column:
    """What is wrong with an object's keys; they are null where there is no object."""
    names = F.array(*map(F.lit, wanted))
    extra, missing = F.array_sort(F.array_except(keys, names)), F.array_sort(F.array_except(names, keys))
    return F.when(keys.isNull(), F.lit("no object")).when(F.size(extra) > 0, F.concat(F.lit("unexpected: "), F.array_join(extra, ", "))).when(F.size(missing) > 0, F.concat(F.lit("missing: "), F.array_join(missing, ", ")))


SEGMENT_KEYS = ["segment_id", "start_ms", "end_ms", "values", "sentence", "evidence_timestamps_ms"]
BOUNDARY_KEYS = ["segment_id", "boundary_kind", "boundary_ms", "evidence_timestamps_ms"]


def _times_fault(array: Column) -> Column:
    """Whether a VARIANT isn't an array of integers."""
    return F.coalesce(~_kind(array).rlike(r"^ARRAY<(VOID|BIGINT|INT|SMALLINT|TINYINT)>$"), F.lit(True))


def _strings_only(values: Column) -> Column:
    """``map<string,string>`` of a JSON object in which what isn't a string is null."""
    typed = F.from_json(F.to_json(values), "map<string,variant>")
    return F.transform_values(typed, lambda _, v: F.when(_kind(v) == "STRING", F.try_variant_get(v, "$", "string")))


def coarse_segments(answered: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """Segments in absolute time with their place in the response, and rejects.

    ``answered`` has ``request_id, video_id, media_start_ms, media_end_ms, response``. Whole responses are checked for
    their form and every segment for its own; times are integers as such, ``0 <= start < end <= duration``, and evidence
    lies in the clip. Rejects name the segment.
    """
    rows = once(answered.select("request_id", "video_id", "media_start_ms", "media_end_ms", "response"), json=F.try_parse_json("response"), keys=F.json_object_keys("response"))
    rows = once(rows, fault=F.coalesce(_keys_fault(F.col("keys"), ["task_summary", "segments"]), F.when(_kind(_get("$.task_summary")) != "STRING", "task_summary").when(F.length(_get("$.task_summary", "string")) == 0, "task_summary").when(~_kind(_get("$.segments")).startswith("ARRAY"), "segments"), F.when(F.col("json").isNull(), "no JSON")))
    bad = reject(rows.where(F.col("fault").isNotNull()), "coarse", "bad_response", F.col("fault"), item=F.col("request_id"))
    each = rows.where(F.col("fault").isNull()).select("request_id", "video_id", "media_start_ms", "media_end_ms", _get("$.task_summary", "string").alias("task_summary"), F.posexplode(_get("$.segments", "array<variant>")).alias("pos", "json"))
    duration = F.col("media_end_ms") - F.col("media_start_ms")
    wrong = (
        F.when(F.coalesce(_kind(_get("$.segment_id")) != "STRING", F.lit(True)) | (F.length(_get("$.segment_id", "string")) == 0), "segment_id")
        .when(F.coalesce(_kind(_get("$.sentence")) != "STRING", F.lit(True)) | (F.length(_get("$.sentence", "string")) == 0), "sentence")
        .when(~is_integer(_get("$.start_ms")), "start_ms")
        .when(~is_integer(_get("$.end_ms")), "end_ms")
        .when(_times_fault(_get("$.evidence_timestamps_ms")), "evidence_timestamps_ms")
    )
    each = once(
        each,
        keys=F.json_object_keys(F.to_json("json")),
        wrong=wrong,
        segment_id=_get("$.segment_id", "string"),
        sentence=_get("$.sentence", "string"),
        start=_get("$.start_ms", "bigint"),
        end=_get("$.end_ms", "bigint"),
        evidence=_get("$.evidence_timestamps_ms", "array<bigint>"),
        values=_strings_only(_get("$.values")),
    )
    start, end = F.col("start"), F.col("end")
    bounds = F.when((start < 0) | (end <= start) | (end > duration), "bounds").when(F.exists("evidence", lambda t: (t < 0) | (t >= duration)), "evidence outside the clip")
    judged = once(each, form=F.coalesce(_keys_fault(F.col("keys"), SEGMENT_KEYS), F.col("wrong")), bounds=bounds, problems=value_problems(F.col("values"), contract))
    code = F.when(F.col("form").isNotNull(), "bad_segment").when(F.col("bounds").isNotNull(), "bad_bounds").when(F.size("problems") > 0, "bad_values")
    judged = judged.withColumn("code", code).withColumn("message", F.coalesce("form", "bounds", F.array_join("problems", "; ")))
    shifted = judged.where(F.col("code").isNull()).select(
        "request_id",
        "video_id",
        "task_summary",
        "pos",
        "segment_id",
        (start + F.col("media_start_ms")).alias("start_ms"),
        (end + F.col("media_start_ms")).alias("end_ms"),
        "values",
        "sentence",
        F.transform("evidence", lambda t: t + F.col("media_start_ms")).alias("evidence"),
        F.col("media_start_ms").alias("chunk_start_ms"),
        F.col("media_end_ms").alias("chunk_end_ms"),
    )
    return shifted, bad.union(reject(judged.where(F.col("code").isNotNull()), "coarse", F.col("code"), F.col("message"), item=F.coalesce("segment_id", F.col("pos").cast("string"))))


def task_summaries(answered: DataFrame) -> DataFrame:
    """``video_id, task_summary`` of the responses, those without segments too."""
    return answered.withColumn("json", F.try_parse_json("response")).select("video_id", _get("$.task_summary", "string").alias("task_summary"))


def boundaries(answered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``video_id, segment_id, kind, boundary_ms, evidence`` in absolute time, and rejects.

    A boundary may lie on either end of its window; evidence lies before the window's end. Ids and kinds must be those asked for.
    """
    rows = once(answered.select("request_id", "video_id", "segment_id", "kind", "media_start_ms", "media_end_ms", "response"), json=F.try_parse_json("response"), keys=F.json_object_keys("response"))
    length = F.col("media_end_ms") - F.col("media_start_ms")
    wrong = F.when(F.col("json").isNull(), "no JSON").when(~is_integer(_get("$.boundary_ms")), "boundary_ms").when(_times_fault(_get("$.evidence_timestamps_ms")), "evidence_timestamps_ms")
    other = F.when(~_get("$.segment_id", "string").eqNullSafe(F.col("segment_id")), "segment_id").when(~_get("$.boundary_kind", "string").eqNullSafe(F.col("kind")), "boundary_kind")
    rows = once(rows, wrong=wrong, other=other, at=_get("$.boundary_ms", "bigint"), evidence=_get("$.evidence_timestamps_ms", "array<bigint>"))
    at = F.col("at")
    form = F.coalesce(F.when(F.col("json").isNull(), "no JSON"), _keys_fault(F.col("keys"), BOUNDARY_KEYS), F.col("wrong"))
    bounds = F.when((at < 0) | (at > length), "boundary outside the window").when(F.exists("evidence", lambda t: (t < 0) | (t >= length)), "evidence outside the window")
    judged = once(rows, form=form, bounds=bounds)
    code = F.when(F.col("form").isNotNull(), "bad_response").when(F.col("other").isNotNull(), "other_boundary").when(F.col("bounds").isNotNull(), "bad_bounds")
    judged = judged.withColumn("code", code).withColumn("message", F.coalesce("form", "other", "bounds"))
    good = judged.where(F.col("code").isNull()).select("video_id", "segment_id", "kind", (at + F.col("media_start_ms")).alias("boundary_ms"), F.transform("evidence", lambda t: t + F.col("media_start_ms")).alias("evidence"))
    return good, reject(judged.where(F.col("code").isNotNull()), "refine", F.col("code"), F.col("message"), item=F.col("request_id"))


def refined_segments(coarse: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Segments with their refined boundaries, values and sentence as before, and rejects for empty intervals.

    Evidence is the sorted distinct union of both boundaries'.
    """
    both = found.groupBy("video_id", "segment_id").agg(
        F.max(F.when(F.col("kind") == "start", F.col("boundary_ms"))).alias("start_ms"),
        F.max(F.when(F.col("kind") == "end", F.col("boundary_ms"))).alias("end_ms"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("evidence")))).alias("evidence"),
    )
    joined = coarse.select("video_id", "segment_id", "values", "sentence").join(both.where("start_ms is not null and end_ms is not null"), ["video_id", "segment_id"])
    empty = joined.where("end_ms <= start_ms")
    return joined.where("end_ms > start_ms").select("video_id", "segment_id", "start_ms", "end_ms", "values", "sentence", "evidence"), reject(empty, "refine", "empty_interval", F.concat_ws("-", F.col("start_ms").cast("string"), F.col("end_ms").cast("string")), item=F.col("segment_id"))
