"""The whole annotation run: manifest and probes to finished documents."""

from __future__ import annotations

import math
from dataclasses import asdict, dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.canonical import digest, sorted_map
from ..functions.ordered import kept
from ..operators import identity, probe, requests, responses, sampling, sinks, timeline
from ..sources import manifest
from ..sources.contract import Contract, load_contract


@dataclass(frozen=True)
class RunConfig:
    """Parameters of a run. Rates are frames a second."""

    coarse_fps: float = 2.0
    refine_fps: float = 6.0
    refine_window_ms: int = 4_000
    merge_gap_ms: int = 250
    min_segment_ms: int = 300
    model_id: str = "scripted"
    model_revision: str = "1"
    extra: dict[str, Any] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if not all(math.isfinite(x) and 0 < x <= sampling.MAX_FPS for x in (self.coarse_fps, self.refine_fps)):
            raise ValueError(f"rates must be above 0 and at most {sampling.MAX_FPS:g}")
        if not (self.coarse_fps > 0 and self.refine_fps > 0 and self.refine_window_ms > 0 and self.merge_gap_ms >= 0 and self.min_segment_ms >= 1):
            raise ValueError("rates, windows and lengths must be positive, and the gap not negative")


@dataclass
class RunResult:
    """Tables of a run; ``rejects`` has a row for everything that was refused."""

    run_id: str
    plans: DataFrame
    coarse: DataFrame
    refined: DataFrame
    documents: DataFrame
    rejects: DataFrame


def _all(tables: list[DataFrame]) -> DataFrame:
    every = tables[0]
    for more in tables[1:]:
        every = every.union(more)
    return every


def _ask(made: DataFrame, backend: responses.Backend, rejects: list[DataFrame]) -> DataFrame:
    """The answers to requests. Each request reaches the backend once: what comes back is kept, and all later tables are read from there."""
    made = kept(responses.numbered(made), "requests")
    bad = requests.bad_requests(made)
    answered, missing = responses.attach(made.join(bad.select(F.col("item_id").alias("request_id")), "request_id", "left_anti"), lambda r: kept(backend(r), "answers"))
    rejects += [bad, missing]
    return answered


def run_annotation(
    items: DataFrame,
    probes: DataFrame,
    contract: Contract,
    backend: responses.Backend,
    config: RunConfig = RunConfig(),
    digests: DataFrame | None = None,
    strict: bool = False,
    listing: DataFrame | None = None,
    inputs: dict[str, str] | None = None,
    artifact_root: str | None = None,
    output: str | None = None,
) -> RunResult:
    """Annotates the videos of ``items`` (see :func:`manifest.parse_manifest`) with ``probes`` (``video_id, probe``).

    A video with any reject has no document, and one that the manifest's checks refuse isn't worked on at all. ``strict`` raises on the first rejects instead. An empty
    manifest, several datasets or an output that is an input (or holds one) stop the run before any request or write, strict or not. ``documents`` has
    ``video_id, json`` in canonical form and the columns it was made from. Every request is answered once. With a ``listing`` of
    files (``path``), videos that aren't in it are rejected; ``digests`` (``video_id, digest``) and ``inputs`` (digests of the manifest, the
    script and the like) are part of the run's identity. ``artifact_root`` and ``output`` say where stage artifacts and the export are written.
    """
    spark = items.sparkSession
    contracts = spark.createDataFrame([(contract.schema_id, contract.ontology_id)], "schema_id string, ontology_id string")
    checks = [manifest.check_manifest(items, contracts, listing)]
    for place in (output, artifact_root):
        if place is not None:
            checks += [identity.aliased_videos(items, place), identity.linked_videos(items, place)]
    refused = kept(_all(checks).distinct(), "refused")
    manifest.stop_run(refused)
    if strict:
        manifest.raise_rejects(refused)
    rejects = [refused]
    items = items.join(refused.select("video_id").distinct(), "video_id", "left_anti")
    probed = items.join(probes, "video_id")
    found, bad = probe.normalise(probed)
    found = kept(found, "videos")
    rejects += [bad, manifest.reject(items.join(probes, "video_id", "left_anti"), "probe", "no_probe", F.col("video_id"))]
    chunks = sampling.build_chunks(found)
    long = sampling.short_video_gate(chunks)
    paths = items.select("video_id", "path")
    ranged = chunks.join(found.select("video_id", "pts"), "video_id").join(paths, "video_id")
    able, bad = sampling.guarded(ranged, config.coarse_fps)
    rejects += [long, bad]
    plans = kept(sampling.sample_ranges(able, config.coarse_fps), "plans")
    rejects.append(manifest.reject(plans.where(F.size("samples") == 0), "sampling", "no_frame", F.col("chunk_id"), item=F.col("chunk_id")))
    single = plans.join(long.select("video_id").distinct(), "video_id", "left_anti").where(F.size("samples") > 0)
    answered = _ask(requests.coarse_requests(single, contract), backend, rejects)
    coarse, faults = responses.coarse_segments(answered, contract)
    coarse = kept(coarse, "coarse")
    rejects += [faults, timeline.duplicate_ids(coarse, "coarse")]
    windows = requests.boundary_windows(requests.with_neighbours(coarse), config.refine_window_ms)
    windows, bad = sampling.guarded(windows, config.refine_fps, "window_start_ms", "window_end_ms", "segment_id")
    sampled = kept(sampling.sample_windows(windows, found, config.refine_fps), "windows")
    rejects += [bad, requests.windows_without_frames(sampled)]
    replies = _ask(requests.boundary_requests(sampled.where(F.size("samples") > 0).join(paths, "video_id")), backend, rejects)
    ends, faults = responses.boundaries(replies)
    refined, empty = responses.refined_segments(coarse, ends)
    refined = kept(refined, "refined")
    rejects += [faults, empty, timeline.unequal_ids(coarse, refined), timeline.blank_sentences(refined)]
    clash = timeline.conflicts(refined, config.merge_gap_ms)
    rejects.append(manifest.reject(clash, "finalise", F.col("kind"), F.concat_ws(", ", "head_id", "segment_id")))
    merged = kept(timeline.merge_segments(refined, config.merge_gap_ms), "merged")
    rejects.append(timeline.timeline_faults(merged, found))
    quality = timeline.quality(found, merged, timeline.boundary_shifts(coarse, refined), config.min_segment_ms)
    every = kept(_all(rejects), "rejects")
    if strict:
        manifest.raise_rejects(every)
    settings = asdict(config)
    prompts = {"boundary": requests.BOUNDARY_PROMPT, "coarse": requests.COARSE_PROMPT}
    videos = identity.video_set_digest(digests) if digests is not None else None
    run = identity.run_id(settings, {"schema": contract.schema_hash, "ontology": contract.ontology_hash, "videos": videos, "inputs": inputs or {}, "prompts": prompts, "stages": identity.STAGE_VERSIONS, "model": [config.model_id, config.model_revision]})
    provenance = F.struct(
        F.lit(digest(settings)).alias("config_hash"),
        F.lit(config.model_id).alias("model_id"),
        F.lit(config.model_revision).alias("model_revision"),
        F.lit(contract.ontology_hash).alias("ontology_hash"),
        F.create_map(*(F.lit(x) for pair in sorted(prompts.items()) for x in pair)).alias("prompt_versions"),
        F.lit(contract.schema_id).alias("schema_version"),
    )
    stopped = every.where(F.col("video_id").isNotNull()).select("video_id").distinct()
    finished = found.select("video_id", "duration_ms").join(responses.task_summaries(answered), "video_id").join(quality, "video_id").join(stopped, "video_id", "left_anti")
    finished = finished.join(listed_segments(merged), "video_id", "left").withColumn("segments", F.coalesce("segments", _NO_SEGMENTS()))
    scored = F.struct("review_reasons", "score", F.struct("empty_timeline", "max_boundary_shift_ms", "merged_segment_sources", "segment_count").alias("signals"))
    documents = finished.withColumn("document", sinks.document(scored, provenance))
    documents = kept(documents.withColumn("json", sinks.to_canonical_json(F.col("document"))).drop("document"), "documents")
    if artifact_root is not None:
        by_video = lambda rows: F.struct(F.col("segments"), F.col("video_id"))
        stages = [
            sinks.artifact_rows(plans.groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct("chunk_end_ms", "chunk_id", "chunk_start_ms", "samples"))).alias("chunks")), run, "coarse-sample-plan", F.struct("chunks", "video_id")),
            sinks.artifact_rows(listed_segments(coarse), run, "coarse", by_video(coarse)),
            sinks.artifact_rows(listed_segments(refined), run, "refined", by_video(refined)),
            documents.select("video_id", "json", F.sha2("json", 256).alias("sha256"), F.lit(run).alias("run_id"), F.lit("final").alias("stage")),
        ]
        sinks.write_artifacts(_all(stages), artifact_root)
    if output is not None:
        sinks.export_jsonl(documents, output)
    return RunResult(run, plans, coarse, refined, documents, every)


_SEGMENT = "struct<end_ms:bigint,evidence_timestamps_ms:array<bigint>,segment_id:string,sentence:string,start_ms:bigint,values:map<string,string>>"


def _NO_SEGMENTS() -> F.Column:
    return F.expr(f"cast(array() as array<{_SEGMENT}>)")


def listed_segments(segments: DataFrame) -> DataFrame:
    """``video_id, segments``: a video's segments in order of start and id, as structs in alphabetical order."""
    out = F.struct("end_ms", F.col("evidence").alias("evidence_timestamps_ms"), "segment_id", "sentence", "start_ms", sorted_map(F.col("values")).alias("values")).cast(_SEGMENT)
    # a map can't be ordered, so the order is that of the fields before it
    keyed = segments.groupBy("video_id").agg(F.collect_list(F.struct("start_ms", "segment_id", out.alias("out"))).alias("all"))
    ordered = F.array_sort("all", lambda a, b: F.when(a["start_ms"] < b["start_ms"], -1).when(a["start_ms"] > b["start_ms"], 1).when(a["segment_id"] < b["segment_id"], -1).when(a["segment_id"] > b["segment_id"], 1).otherwise(0))
    return keyed.select("video_id", F.transform(ordered, lambda s: s["out"]).alias("segments"))


@dataclass(frozen=True)
class RunFiles:
    """Where a run finds its inputs and puts its outputs. ``probes`` is JSON lines ``{"video_id": ..., "probe": "..."}``, ``script`` a map of request ids to lists of responses."""

    manifest: str
    schema: str
    ontology: str
    probes: str
    script: str
    output: str
    artifact_root: str


def run_files(spark: SparkSession, files: RunFiles, config: RunConfig = RunConfig(), strict: bool = False) -> RunResult:
    """The whole job on files: checks that the output is no input, lists and digests the videos on the executors, and writes artifacts and the export.

    Videos must lie on storage that executors can open.
    """
    named = {"manifest": files.manifest, "schema": files.schema, "ontology": files.ontology, "probes": files.probes, "script": files.script}
    for place in (files.output, files.artifact_root):
        if (alias := identity.output_alias(place, named)) is not None:
            raise ValueError(f"{place} is or holds the {alias} file")
    items, bad = manifest.read_manifest(spark, files.manifest)
    manifest.stop_run(bad)
    if strict:
        manifest.raise_rejects(bad)
    contract = load_contract(files.schema, files.ontology)
    digested = identity.streamed_digests(spark.createDataFrame(list(named.items()), "name string, path string").repartition(len(named))).collect()  # five rows
    inputs = {name: row.digest for name, path in named.items() for row in digested if row.path == path}
    found = kept(identity.present_files(items.select("path").distinct()), "listing")
    digests = items.join(found.where("digest is not null"), "path").select("video_id", "digest")
    probes = spark.read.schema("video_id string, probe string").json(files.probes)
    result = run_annotation(items, probes, contract, responses.scripted(responses.read_script(spark, files.script)), config, digests, strict, found.where("digest is not null"), inputs, files.artifact_root, files.output)
    result.rejects = bad.union(result.rejects)
    return result
