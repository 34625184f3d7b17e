"""The whole run on one small video, and what stops a video."""

import json

import pytest
from pyspark.sql import functions as F

from annospark.operators import identity, responses, sampling, sinks
from annospark.plans import job
from annospark.plans.job import RunConfig, run_annotation
from annospark.sources import manifest
from annospark.sources.contract import ContractError, make_contract

SCHEMA = {"schema_id": "subtask-1", "segment_values": {"action": {"type": "enum", "source": "ontology.actions", "required": True}, "target": {"type": "string", "required": True}}, "text_output": {"field": "sentence", "language": "zh-CN", "style": "imperative", "required": True}}
ONTOLOGY = {"ontology_id": "kitchen", "revision": "1", "vocabularies": {"actions": [{"id": "grasp", "name": "g", "definition": "d"}, {"id": "place", "name": "p", "definition": "d"}]}}
SUMMARY = "将杯子放到托盘"


def inputs(spark, coarse=None, start=100, end=800):
    lines = [json.dumps({"video_id": "v1", "video_uri": "v1.mp4", "dataset_id": "d", "schema_version": "subtask-1", "ontology_id": "kitchen"}), "  "]
    items, bad = manifest.parse_manifest(spark.createDataFrame([(x,) for x in lines], "value string"), "/data")
    assert bad.isEmpty()
    body = {"streams": [{"width": 64, "height": 64, "avg_frame_rate": "30/1", "duration": "1.0"}], "format": {"duration": "1"}, "frames": [{"best_effort_timestamp_time": f"{i / 30:.6f}"} for i in range(30)]}
    probes = spark.createDataFrame([("v1", json.dumps(body))], "video_id string, probe string")
    segment = {"segment_id": "s1", "start_ms": 0, "end_ms": 900, "values": {"action": "grasp", "target": "cup"}, "sentence": "拿起杯子", "evidence_timestamps_ms": [100]}
    coarse = coarse or {"task_summary": SUMMARY, "segments": [segment]}
    reply = lambda kind, at, e: {"segment_id": "s1", "boundary_kind": kind, "boundary_ms": at, "evidence_timestamps_ms": e}
    script = {"coarse:v1": coarse, "boundary-start:v1:s1": reply("start", start, [100, 200]), "boundary-end:v1:s1": reply("end", end, [800, 700])}
    table = spark.createDataFrame([(k, 1, json.dumps(v)) for k, v in script.items()], "request_id string, n int, response string")
    return items, probes, make_contract(SCHEMA, ONTOLOGY), responses.scripted(table)


def test_golden_run(spark):
    result = run_annotation(*inputs(spark))
    assert result.rejects.count() == 0
    doc = json.loads(result.documents.first().json)
    assert list(doc) == sorted(doc) and doc["task_summary"] == SUMMARY and doc["duration_ms"] == 1000
    assert doc["segments"] == [{"end_ms": 800, "evidence_timestamps_ms": [100, 200, 700, 800], "segment_id": "s1", "sentence": "拿起杯子", "start_ms": 100, "values": {"action": "grasp", "target": "cup"}}]
    assert doc["quality"]["score"] == 1.0 and doc["quality"]["signals"]["max_boundary_shift_ms"] == 100
    assert result.run_id.startswith("run-") and result.run_id != run_annotation(*inputs(spark), RunConfig(merge_gap_ms=1)).run_id


def test_each_request_is_answered_once(spark):
    items, probes, contract, backend = inputs(spark)
    asked = spark.sparkContext.accumulator(0)

    def counting(made):
        def run(batches):
            for batch in batches:
                asked.add(batch.num_rows)
                yield batch

        return backend(made.mapInArrow(run, made.schema))

    result = run_annotation(items, probes, contract, counting)
    assert result.rejects.count() == 0 and result.documents.count() == 1 and result.refined.count() == 1
    assert asked.value == 3  # one coarse request, two boundaries


@pytest.mark.parametrize("rates", [{"coarse_fps": float("inf")}, {"coarse_fps": 1e9}, {"refine_fps": float("nan")}, {"refine_fps": 0}])
def test_rates_are_bounded(rates):
    with pytest.raises(ValueError):
        RunConfig(**rates)


def test_ranges_with_too_many_targets_are_rejected(spark):
    ranges = spark.createDataFrame([("v", "c", 0, 100_000_000)], "video_id string, chunk_id string, chunk_start_ms bigint, chunk_end_ms bigint")
    good, bad = sampling.guarded(ranges, 2.0)
    assert good.isEmpty() and [r.code for r in bad.collect()] == ["too_many_targets"]


def written_run(folder, videos=("v1", "v2"), datasets=("d", "d")):
    """A run's input files; there is a file of v1 alone."""
    (folder / "v1.mp4").write_bytes(b"film")
    lines = [{"video_id": v, "video_uri": f"{v}.mp4", "dataset_id": d, "schema_version": "subtask-1", "ontology_id": "kitchen"} for v, d in zip(videos, datasets)]
    (folder / "manifest.jsonl").write_text("\n".join(map(json.dumps, lines)))
    (folder / "schema.yaml").write_text(json.dumps(SCHEMA))
    (folder / "ontology.yaml").write_text(json.dumps(ONTOLOGY))
    body = {"streams": [{"width": 64, "height": 64, "avg_frame_rate": "30/1", "duration": "1.0"}], "format": {"duration": "1"}, "frames": [{"best_effort_timestamp_time": f"{i / 30:.6f}"} for i in range(30)]}
    (folder / "probes.jsonl").write_text("\n".join(json.dumps({"video_id": v, "probe": json.dumps(body)}) for v in ("v1", "v2")))
    segment = {"segment_id": "s1", "start_ms": 0, "end_ms": 900, "values": {"action": "grasp", "target": "cup"}, "sentence": "拿起杯子", "evidence_timestamps_ms": [100]}
    reply = lambda kind, at: [{"segment_id": "s1", "boundary_kind": kind, "boundary_ms": at, "evidence_timestamps_ms": [200]}]
    script = {f"coarse:{v}": [{"task_summary": SUMMARY, "segments": [segment]}] for v in ("v1", "v2")} | {"boundary-start:v1:s1": reply("start", 100), "boundary-end:v1:s1": reply("end", 800)}
    (folder / "script.json").write_text(json.dumps(script, ensure_ascii=False))
    return job.RunFiles(*(str(folder / x) for x in ("manifest.jsonl", "schema.yaml", "ontology.yaml", "probes.jsonl", "script.json", "out", "artifacts")))


def test_run_on_files(spark, tmp_path):
    files = written_run(tmp_path)
    first = job.run_files(spark, files)
    assert {(r.code, r.video_id) for r in first.rejects.collect()} == {("missing_file", "v2")}
    text = [r.value for r in spark.read.text(files.output).collect()]
    assert len(text) == 1 and json.loads(text[0])["segments"][0]["end_ms"] == 800
    for stage in sinks.STAGES:
        assert "v1" in {r.video_id for r in sinks.read_artifacts(spark, files.artifact_root, first.run_id, stage).collect()}, stage
    (tmp_path / "v1.mp4").write_bytes(b"other film")
    assert job.run_files(spark, files).run_id != first.run_id
    (tmp_path / "v1.mp4").write_bytes(b"film")
    assert job.run_files(spark, files).run_id == first.run_id
    with pytest.raises(ValueError, match="script"):
        job.run_files(spark, job.RunFiles(**(vars(files) | {"output": files.script})))


def unchanged(folder):
    return {str(p): p.read_bytes() if p.is_file() else None for p in folder.rglob("*")}


@pytest.mark.parametrize("place", ["v1.mp4", "linked.mp4", "hard.mp4", "."])
@pytest.mark.parametrize("field", ["output", "artifact_root"])
def test_no_input_is_overwritten(spark, tmp_path, place, field):
    (tmp_path / "in").mkdir()
    files = written_run(tmp_path / "in")
    (tmp_path / "in" / "linked.mp4").symlink_to(tmp_path / "in" / "v1.mp4")
    (tmp_path / "in" / "hard.mp4").hardlink_to(tmp_path / "in" / "v1.mp4")
    before = unchanged(tmp_path)
    with pytest.raises(ValueError, match="output_is_input|holds"):
        job.run_files(spark, job.RunFiles(**(vars(files) | {field: str(tmp_path / "in" / place)})))
    assert unchanged(tmp_path) == before


@pytest.mark.parametrize("videos, datasets, code", [((), (), "empty_manifest"), (("v1", "v2"), ("d", "e"), "mixed_datasets"), (("v1", ""), ("d", "d"), "empty_field")])
def test_a_bad_manifest_stops_the_run_before_it_writes(spark, tmp_path, videos, datasets, code):
    files = written_run(tmp_path, videos, datasets)
    before = unchanged(tmp_path)
    with pytest.raises(manifest.RejectedRows, match=code):
        job.run_files(spark, files)
    assert unchanged(tmp_path) == before


def test_a_repeated_video_is_rejected_for_that_alone(spark):
    items, probes, contract, backend = inputs(spark)
    result = run_annotation(items.union(items), probes, contract, backend)
    assert {r.code for r in result.rejects.collect()} == {"duplicate_in_dataset", "duplicate_video"} and result.documents.isEmpty()


def coarse_with(**change):
    segment = {"segment_id": "s1", "start_ms": 0, "end_ms": 900, "values": {"action": "grasp", "target": "cup"}, "sentence": "x", "evidence_timestamps_ms": [100]} | change
    return {"task_summary": "t", "segments": [segment]}


@pytest.mark.parametrize(
    "change, code",
    [
        ({"start_ms": "0"}, "bad_segment"),
        ({"end_ms": 900.0}, "bad_segment"),
        ({"sentence": ""}, "bad_segment"),
        ({"extra": 1}, "bad_segment"),
        ({"end_ms": 1001}, "bad_bounds"),
        ({"evidence_timestamps_ms": [1000]}, "bad_bounds"),
        ({"evidence_timestamps_ms": [1.5]}, "bad_segment"),
        ({"values": {"action": "fly", "target": "cup"}}, "bad_values"),
        ({"values": {"action": "grasp", "target": 3}}, "bad_values"),
        ({"values": {"action": "grasp"}}, "bad_values"),
    ],
)
def test_bad_segments_reject_the_video(spark, change, code):
    result = run_annotation(*inputs(spark, coarse_with(**change)))
    assert code in {r.code for r in result.rejects.collect()} and result.documents.isEmpty()


def test_strict_raises_and_boundaries_are_checked(spark):
    with pytest.raises(manifest.RejectedRows, match="bad_bounds"):
        run_annotation(*inputs(spark, end=1001), strict=True)
    assert "empty_interval" in {r.code for r in run_annotation(*inputs(spark, start=800, end=800)).rejects.collect()}


def test_no_segments_is_a_document(spark):
    doc = json.loads(run_annotation(*inputs(spark, {"task_summary": "none", "segments": []})).documents.first().json)
    assert doc["segments"] == [] and doc["quality"]["signals"]["empty_timeline"] is True


@pytest.mark.parametrize("change", [{"vocabularies": {"actions": []}}, {"vocabularies": {"actions": [{"id": "a"}, {"id": "a"}]}}, {"more": 1}])
def test_contract_faults(change):
    with pytest.raises(ContractError):
        make_contract(SCHEMA, ONTOLOGY | change)


def test_sentence_field_is_fixed():
    with pytest.raises(ContractError):
        make_contract(SCHEMA | {"text_output": SCHEMA["text_output"] | {"field": "caption"}}, ONTOLOGY)


def test_artifacts_are_replaced_and_exported_in_order(spark, tmp_path):
    rows = spark.createDataFrame([("b", 2), ("a", 1)], "video_id string, n int")
    made = sinks.artifact_rows(rows, "run-1", "final", F.struct("n", "video_id"))
    for _ in range(2):
        sinks.write_artifacts(made, str(tmp_path / "art"))
    assert sinks.read_artifacts(spark, str(tmp_path / "art"), "run-1", "final").count() == 2
    sinks.export_jsonl(made, str(tmp_path / "out"))
    assert [r.value for r in spark.read.text(str(tmp_path / "out")).collect()] == ['{"n":1,"video_id":"a"}', '{"n":2,"video_id":"b"}']


def test_digests_do_not_depend_on_order(spark, tmp_path):
    (tmp_path / "x").write_bytes(b"abc")
    whole = identity.file_digests(spark, str(tmp_path / "x")).first()
    assert identity.streamed_digests(spark.createDataFrame([(whole.path,)], "path string")).first().digest == whole.digest
    rows = [(f"v{i}", str(i)) for i in range(50)]
    ids = [identity.video_set_digest(spark.createDataFrame(r, "video_id string, digest string").repartition(n)) for r, n in ((rows, 1), (rows[::-1], 7))]
    assert ids[0] == ids[1] != identity.video_set_digest(spark.createDataFrame(rows[1:], "video_id string, digest string"))
    assert identity.output_alias("/a/../a/x", {"config": "/a/x"}) == "config"
