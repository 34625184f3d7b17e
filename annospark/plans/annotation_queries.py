"""Queries of the annotation job: manifests, probes, sampling, requests, responses, timelines, artifacts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.canonical import to_canonical_json
from ..operators import identity, probe, requests, responses, sampling, sinks, timeline, values
from ..sources import contract as contracts
from ..sources import manifest
from . import adapters as a
from . import job
from .registry import query

GAP_MS = 21_600_000
ORDER = "PARTITION BY video_id ORDER BY start_ms, end_ms, segment_id"
ISLANDS = f"""marked AS (SELECT *, max(end_ms) OVER ({ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach, lag(event_type) OVER ({ORDER}) AS prev FROM segments),
numbered AS (SELECT *, sum(CASE WHEN reach IS NOT NULL AND prev = event_type AND start_ms - reach <= {GAP_MS} THEN 0 ELSE 1 END) OVER ({ORDER}) AS island FROM marked)"""
MERGED = f"""{ISLANDS}, merged AS (SELECT video_id, island, first(segment_id ORDER BY start_ms, end_ms, segment_id) AS segment_id, min(start_ms) AS start_ms, max(end_ms) AS end_ms,
  min(event_type) AS action, count(*) AS members, string_agg(segment_id, ',' ORDER BY start_ms, end_ms, segment_id) AS ids FROM numbered GROUP BY 1, 2)"""

#: The contract that the queries check events against: one event type is unknown to it.
EVENT_CONTRACT = contracts.make_contract(
    {"schema_id": "events-1", "segment_values": {"action": {"type": "enum", "source": "ontology.actions", "required": True}, "note": {"type": "string", "required": False}}, "text_output": {"field": "sentence", "language": "en", "style": "imperative", "required": True}},
    {"ontology_id": "events", "revision": "1", "vocabularies": {"actions": [{"id": i, "name": i, "definition": i} for i in ("view", "click", "purchase", "signup")]}},
)


# --- A: manifest and contract


def _customer_lines(spark, sf_dir):
    """Customers as manifest lines: every 50th has an unknown key, every 51st no dataset, every 52nd a remote uri; some lines are blank or broken."""
    c = a.table(spark, sf_dir, "customer").repartition("c_custkey")  # one small file would be parsed in one task
    k = F.col("c_custkey")
    plain = F.struct(
        F.concat(F.lit("v"), k.cast("string")).alias("video_id"),
        F.when(k % 52 == 0, F.concat(F.lit("s3://b/"), k.cast("string"))).otherwise(F.concat(F.lit("clips/../raw/"), k.cast("string"), F.lit(".mp4"))).alias("video_uri"),
        F.when(k % 51 == 0, "").otherwise(F.col("c_mktsegment")).alias("dataset_id"),
        F.lit("events-1").alias("schema_version"),
        F.when(k % 40 == 0, "other").otherwise("events").alias("ontology_id"),
        F.struct(F.col("c_nationkey").alias("nation")).alias("metadata"),
    )
    extra = F.struct(plain["video_id"].alias("video_id"), F.lit(1).alias("colour"))
    line = F.when(k % 50 == 0, F.to_json(extra)).when(k % 53 == 0, "  ").when(k % 54 == 0, "{oops").otherwise(F.to_json(plain))
    return c.select(line.alias("value"))


ITEMS = """items AS (SELECT 'v' || c_custkey AS video_id, c_custkey, c_mktsegment AS dataset_id, CASE WHEN c_custkey % 40 = 0 THEN 'other' ELSE 'events' END AS ontology_id,
  '/data/raw/' || c_custkey || '.mp4' AS path, '{"nation":' || c_nationkey || '}' AS metadata FROM customer
  WHERE c_custkey % 50 <> 0 AND c_custkey % 53 <> 0 AND c_custkey % 54 <> 0 AND c_custkey % 51 <> 0 AND c_custkey % 52 <> 0)"""


def _items(spark, sf_dir):
    return manifest.parse_manifest(_customer_lines(spark, sf_dir), "/data")


@query(f"WITH {ITEMS} SELECT video_id, dataset_id, ontology_id, path, metadata, '{{}}' AS context FROM items")
def manifest_items(spark, sf_dir):
    return _items(spark, sf_dir)[0].select("video_id", "dataset_id", "ontology_id", "path", "metadata", "context")


@query("""SELECT code, count(*) AS n FROM (SELECT CASE WHEN c_custkey % 50 = 0 THEN 'unknown_keys' WHEN c_custkey % 53 = 0 THEN NULL WHEN c_custkey % 54 = 0 THEN 'not_json'
  WHEN c_custkey % 51 = 0 THEN 'empty_field' WHEN c_custkey % 52 = 0 THEN 'remote_uri' END AS code FROM customer) WHERE code IS NOT NULL GROUP BY code""")
def manifest_rejects(spark, sf_dir):
    return _items(spark, sf_dir)[1].groupBy("code").agg(F.count("*").alias("n"))


def _repeated_items(spark, sf_dir):
    items = _items(spark, sf_dir)[0]
    again = items.where("length(video_id) % 2 = 0").withColumn("video_uri", F.concat("video_uri", F.lit(".copy")))
    return items.union(again).union(items.where("video_id like '%7'").withColumn("dataset_id", F.lit("OTHER")))


@query(f"""WITH {ITEMS}, twice AS (SELECT video_id, dataset_id FROM items UNION ALL SELECT video_id, dataset_id FROM items WHERE length(video_id) % 2 = 0
  UNION ALL SELECT video_id, 'OTHER' FROM items WHERE video_id LIKE '%7')
  SELECT code, video_id, count(*) AS n FROM (
    SELECT 'duplicate_in_dataset' AS code, video_id, row_number() OVER (PARTITION BY dataset_id, video_id) AS nth FROM twice UNION ALL
    SELECT 'duplicate_video', video_id, row_number() OVER (PARTITION BY video_id) FROM twice) WHERE nth > 1 GROUP BY 1, 2""")
def manifest_duplicates(spark, sf_dir):
    rows = _repeated_items(spark, sf_dir)
    return manifest.repeated_items(rows).union(manifest.repeated_items(rows, ("video_id",))).groupBy("code", "video_id").agg(F.count("*").alias("n"))


@query(f"WITH {ITEMS} SELECT video_id, path AS message FROM items WHERE c_custkey % 7 = 0")
def manifest_missing_files(spark, sf_dir):
    listing = a.table(spark, sf_dir, "customer").where("c_custkey % 7 <> 0").select(F.concat(F.lit("file:/data/raw/"), F.col("c_custkey").cast("string"), F.lit(".mp4")).alias("path"))
    return manifest.missing_files(_items(spark, sf_dir)[0], listing).select("video_id", "message")


@query(f"WITH {ITEMS} SELECT 'mixed_datasets' AS code, string_agg(DISTINCT dataset_id, ', ' ORDER BY dataset_id) AS message FROM items HAVING count(DISTINCT dataset_id) > 1")
def manifest_datasets(spark, sf_dir):
    return manifest.dataset_problems(_items(spark, sf_dir)[0]).select("code", "message")


@query("""SELECT 'p' || p_partkey || CASE WHEN p_partkey % 3 = 0 THEN '/x' WHEN p_partkey % 5 = 0 THEN '\\y' ELSE '' END AS video_id FROM part WHERE p_partkey % 3 = 0 OR p_partkey % 5 = 0
  UNION ALL SELECT '..' FROM part WHERE p_partkey = 1""")
def manifest_unsafe_ids(spark, sf_dir):
    k = F.col("p_partkey")
    ids = a.table(spark, sf_dir, "part").select(F.when(k == 1, "..").otherwise(F.concat(F.lit("p"), k.cast("string"), F.when(k % 3 == 0, "/x").when(k % 5 == 0, "\\y").otherwise(""))).alias("video_id"), F.lit("d").alias("dataset_id"))
    return manifest.unsafe_ids(ids).select("video_id")


@query(f"WITH {ITEMS} SELECT 'ontology_mismatch' AS code, video_id, 'events-1/other' AS message FROM items WHERE ontology_id = 'other'")
def manifest_contracts(spark, sf_dir):
    known = spark.createDataFrame([("events-1", "events")], "schema_id string, ontology_id string")
    return manifest.contract_mismatches(_items(spark, sf_dir)[0], known).select("code", "video_id", "message")


@query("SELECT p_type AS vocabulary, p_name AS id, count(*) AS n FROM part GROUP BY 1, 2 HAVING count(*) > 1")
def vocabulary_repeats(spark, sf_dir):
    return contracts.repeated_terms(a.table(spark, sf_dir, "part").select(F.col("p_type").alias("vocabulary"), F.col("p_name").alias("id")))


@query("""SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 'unexpected values: zone' ELSE '' END || CASE WHEN event_id % 10 = 0 AND (event_type = 'error' OR event_id % 15 = 0) THEN '; ' ELSE '' END
  || CASE WHEN event_id % 15 = 0 THEN 'missing value: action' WHEN event_type = 'error' THEN 'unknown action: error' ELSE '' END AS problems
  FROM events WHERE event_id % 10 = 0 OR event_id % 15 = 0 OR event_type = 'error'""")
def value_checks(spark, sf_dir):
    e = a.table(spark, sf_dir, "events")
    action = F.when(F.col("event_id") % 15 != 0, F.create_map(F.lit("action"), "event_type")).otherwise(F.create_map(F.lit("note"), F.lit("x")))
    held = F.when(F.col("event_id") % 10 == 0, F.map_concat(action, F.create_map(F.lit("zone"), F.lit("1")))).otherwise(action)
    return e.select("event_id", F.array_join(values.value_problems(held, EVENT_CONTRACT), "; ").alias("problems")).where("problems <> ''")


@query("""WITH r AS (SELECT event_id, event_type AS t, event_id % 15 = 0 AS noted, CASE WHEN event_id % 10 = 0 THEN 'unexpected values: zone' END AS extra, CASE WHEN event_id % 50 = 7 THEN 'events-3' WHEN event_id % 2 = 0 THEN 'events-1' ELSE 'events-2' END AS schema_version FROM events),
  p AS (SELECT event_id, schema_version, CASE schema_version WHEN 'events-3' THEN 'unknown schema: events-3'
    WHEN 'events-1' THEN concat_ws('; ', extra, CASE WHEN noted THEN 'missing value: action' WHEN t NOT IN ('view', 'click', 'purchase', 'signup') THEN 'unknown action: ' || t END)
    ELSE concat_ws('; ', extra, CASE WHEN NOT noted AND t NOT IN ('view', 'error') THEN 'unknown action: ' || t END, CASE WHEN NOT noted THEN 'missing value: note' END) END AS problems FROM r)
  SELECT * FROM p WHERE problems <> ''""")
def contract_checks(spark, sf_dir):
    """Events under two contracts in one job; some name a third that isn't there."""
    schema = {"schema_id": "events-2", "segment_values": {"action": {"type": "enum", "source": "ontology.actions", "required": False}, "note": {"type": "string"}}, "text_output": EVENT_CONTRACT.schema["text_output"]}
    other = contracts.make_contract(schema, {"ontology_id": "errors", "revision": "1", "vocabularies": {"actions": [{"id": "view"}, {"id": "error"}]}})
    k = F.col("event_id")
    action = F.when(k % 15 != 0, F.create_map(F.lit("action"), "event_type")).otherwise(F.create_map(F.lit("note"), F.lit("x")))
    held = F.when(k % 10 == 0, F.map_concat(action, F.create_map(F.lit("zone"), F.lit("1")))).otherwise(action)
    named = F.when(k % 50 == 7, "events-3").when(k % 2 == 0, "events-1").otherwise("events-2")
    rows = a.table(spark, sf_dir, "events").select("event_id", named.alias("schema_version"), held.alias("values"))
    found = values.contract_problems(rows, contracts.contract_table(spark, [EVENT_CONTRACT, other]))
    return found.select("event_id", "schema_version", F.array_join("problems", "; ").alias("problems")).where("problems <> ''")


@query("SELECT event_type AS action, count(*) AS n FROM events WHERE event_type NOT IN ('view', 'click', 'purchase', 'signup') GROUP BY 1")
def unknown_terms(spark, sf_dir):
    rows = a.table(spark, sf_dir, "events").select(F.col("event_type").alias("action"))
    return values.unknown_terms(rows, EVENT_CONTRACT.vocabulary_table(spark), "action", "actions").groupBy("action").agg(F.count("*").alias("n"))


@query("""SELECT c_custkey, 'sha256:' || sha256('{"key":' || c_custkey || ',"segment":"' || c_mktsegment || '"}') AS digest FROM customer""")
def canonical_digests(spark, sf_dir):
    row = to_canonical_json(F.struct(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("segment")))
    return a.table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("sha256:"), F.sha2(row, 256)).alias("digest"))


# --- B: probes


def _probes(spark, sf_dir):
    """Probe documents from events: times in s with three decimals, offset by the start; some without stream, duration or rate."""
    t = a.timed_events(spark, sf_dir)
    user = F.regexp_extract("video_id", r"(\d+)$", 1).cast("int")
    each = t.groupBy("video_id").agg(F.sort_array(F.collect_list("start_ms"), asc=False).alias("ms")).withColumn("u", user)
    frames = F.transform("ms", lambda m: F.struct(F.format_string("%.3f", m / 1000.0 + 5).alias("best_effort_timestamp_time")))
    stream = F.struct(
        F.lit("640").alias("width"),
        F.lit("360").alias("height"),
        F.when(F.col("u") % 3 == 0, "30/1").when(F.col("u") % 3 == 1, "0/0").when(F.col("u") % 2 == 0, "25").when(F.col("u") % 4 == 1, "30.0/1.0").otherwise("30 / 1").alias("avg_frame_rate"),
        F.when(F.col("u") % 4 == 0, "N/A").when(F.col("u") % 4 == 1, "-1").otherwise(F.format_string("%.4f", (F.element_at("ms", 1) + 1) / 1000.0 + 0.0005)).alias("duration"),
        F.lit("5.000").alias("start_time"),
    )
    body = F.struct(F.when(F.col("u") % 10 == 9, F.array(stream, stream)).otherwise(F.array(stream)).alias("streams"), F.struct(F.when(F.col("u") % 20 == 8, "inf").otherwise("123.4565").alias("duration")).alias("format"), frames.alias("frames"))
    return each.select("video_id", F.to_json(body).alias("probe"))


PROBED = f"""WITH {a.TIMED}, distinct_ms AS (SELECT DISTINCT video_id, start_ms FROM timed),
gaps AS (SELECT video_id, start_ms - lag(start_ms) OVER (PARTITION BY video_id ORDER BY start_ms) AS gap FROM distinct_ms),
med AS (SELECT video_id, median(gap) AS gap FROM gaps GROUP BY 1),
u AS (SELECT video_id, CAST(regexp_extract(video_id, '(\\d+)$', 1) AS INT) AS u, count(*) AS n, max(start_ms) AS last, sum(start_ms) AS total FROM distinct_ms GROUP BY 1)"""


@query(f"""{PROBED} SELECT video_id, CASE WHEN u % 4 IN (0, 1) THEN 123456 ELSE CAST(round_even(CAST(printf('%.4f', (last + 1) / 1000.0 + 0.0005) AS DOUBLE) * 1000, 0) AS BIGINT) END AS duration_ms,
  round(CASE WHEN u % 3 = 0 THEN 30.0 WHEN u % 3 = 2 AND u % 2 = 0 THEN 25.0 ELSE 1000.0 / gap END, 9) AS fps, CAST(n AS INT) AS n_frames, last AS last_ms, CAST(total AS BIGINT) AS sum_ms
  FROM u JOIN med USING (video_id) WHERE u % 10 <> 9 AND NOT (u % 20 = 8 AND u % 4 IN (0, 1))""")
def probe_videos(spark, sf_dir):
    good, _ = probe.normalise(_probes(spark, sf_dir))
    return good.select("video_id", "duration_ms", F.round("nominal_fps", 9).alias("fps"), F.size("pts").alias("n_frames"), F.element_at("pts", -1).alias("last_ms"), F.aggregate("pts", F.lit(0).cast("bigint"), lambda s, x: s + x).alias("sum_ms"))


@query(f"""{PROBED} SELECT video_id, CASE WHEN u % 10 = 9 THEN 'not_one_stream' ELSE 'no_duration' END AS code FROM u WHERE u % 10 = 9 OR (u % 20 = 8 AND u % 4 IN (0, 1))""")
def probe_rejects(spark, sf_dir):
    return probe.normalise(_probes(spark, sf_dir))[1].select("video_id", "code")


# --- C: chunks and samples

STEP = a.CHUNK_MS - a.CHUNK_OVERLAP_MS
CHUNKS = f"""{a.TIMED}, durations AS (SELECT video_id, max(start_ms) + 1 AS duration_ms FROM timed GROUP BY 1),
chunks AS (SELECT video_id, duration_ms, printf('chunk-%04d', i) AS chunk_id, i * {STEP} AS chunk_start_ms, least(i * {STEP} + {a.CHUNK_MS}, duration_ms) AS chunk_end_ms
  FROM (SELECT *, unnest(generate_series(0, CASE WHEN duration_ms <= {a.CHUNK_MS} THEN 0 ELSE CAST(ceil((duration_ms - {a.CHUNK_MS}) / {STEP}.0) AS BIGINT) END)) AS i FROM durations))"""


def _chunks(spark, sf_dir):
    durations = a.timed_events(spark, sf_dir).groupBy("video_id").agg((F.max("start_ms") + 1).alias("duration_ms"))
    return sampling.build_chunks(durations, a.CHUNK_MS, a.CHUNK_OVERLAP_MS)


@query(f"WITH {CHUNKS} SELECT video_id, chunk_id, chunk_start_ms, chunk_end_ms FROM chunks")
def video_chunks(spark, sf_dir):
    return _chunks(spark, sf_dir).drop("duration_ms")


@query(f"WITH {CHUNKS} SELECT video_id, CAST(count(*) AS VARCHAR) AS message FROM chunks GROUP BY 1 HAVING count(*) <> 1")
def short_video_gate(spark, sf_dir):
    return sampling.short_video_gate(_chunks(spark, sf_dir)).select("video_id", "message")


@query(f"""WITH {CHUNKS} SELECT c.video_id, chunk_id, count(*) AS n, sum(f.start_ms - chunk_start_ms)::BIGINT AS offsets FROM chunks c
  JOIN (SELECT DISTINCT video_id, start_ms FROM timed) f ON c.video_id = f.video_id AND f.start_ms >= chunk_start_ms AND f.start_ms < chunk_end_ms GROUP BY 1, 2""")
def chunk_frames(spark, sf_dir):
    inside = sampling.frames_in_ranges(_chunks(spark, sf_dir), a.frames(spark, sf_dir), a.CHUNK_MS)
    return inside.groupBy("video_id", "chunk_id").agg(F.count("*").alias("n"), F.sum(F.col("pts_ms") - F.col("chunk_start_ms")).alias("offsets"))


@query(f"""WITH {CHUNKS} SELECT video_id, chunk_id AS message FROM chunks c WHERE NOT EXISTS (SELECT 1 FROM timed f WHERE c.video_id = f.video_id AND f.start_ms >= chunk_start_ms AND f.start_ms < chunk_end_ms)""")
def empty_chunks(spark, sf_dir):
    chunks = _chunks(spark, sf_dir)
    return sampling.ranges_without_frames(chunks, sampling.frames_in_ranges(chunks, a.frames(spark, sf_dir), a.CHUNK_MS)).select("video_id", "message")


SAMPLES = f"""WITH RECURSIVE {CHUNKS}, steps AS (SELECT video_id, chunk_id, chunk_start_ms, chunk_end_ms, CAST(chunk_start_ms AS DOUBLE) AS cur FROM chunks
  UNION ALL SELECT video_id, chunk_id, chunk_start_ms, chunk_end_ms, cur + CAST({1000.0 / a.HOURLY_FPS!r} AS DOUBLE) FROM steps WHERE cur + CAST({1000.0 / a.HOURLY_FPS!r} AS DOUBLE) < chunk_end_ms),
targets AS (SELECT video_id, chunk_id, chunk_start_ms, CAST(round_even(cur, 0) AS BIGINT) AS target_ms FROM steps),
pts AS (SELECT DISTINCT c.video_id, chunk_id, f.start_ms AS pts_ms FROM chunks c JOIN timed f ON c.video_id = f.video_id AND f.start_ms >= chunk_start_ms AND f.start_ms < chunk_end_ms),
near AS (SELECT DISTINCT t.video_id, t.chunk_id, t.chunk_start_ms, first(p.pts_ms ORDER BY abs(p.pts_ms - target_ms), p.pts_ms) AS pts_ms FROM targets t JOIN pts p USING (video_id, chunk_id) GROUP BY t.video_id, t.chunk_id, t.chunk_start_ms, target_ms)"""


@query(f"{SAMPLES} SELECT video_id, chunk_id, pts_ms AS source_timestamp_ms, pts_ms - chunk_start_ms AS chunk_timestamp_ms FROM near")
def sample_plan(spark, sf_dir):
    inside = sampling.frames_in_ranges(_chunks(spark, sf_dir), a.frames(spark, sf_dir), a.CHUNK_MS)
    found = sampling.frames_of_targets(inside, a.HOURLY_FPS, ["video_id", "chunk_id"])
    return found.select("video_id", "chunk_id", F.col("pts_ms").alias("source_timestamp_ms"), (F.col("pts_ms") - F.col("chunk_start_ms")).alias("chunk_timestamp_ms"))


@query(f"{SAMPLES} SELECT video_id, chunk_id, count(*)::INT AS n, string_agg(pts_ms, ',' ORDER BY pts_ms) AS samples FROM near GROUP BY 1, 2")
def sample_arrays(spark, sf_dir):
    pts = a.frames(spark, sf_dir).groupBy("video_id").agg(F.array_sort(F.collect_list("pts_ms")).alias("pts"))
    plans = sampling.sample_ranges(_chunks(spark, sf_dir).join(pts, "video_id"), a.HOURLY_FPS)
    return plans.where(F.size("samples") > 0).select("video_id", "chunk_id", F.size("samples").alias("n"), F.array_join("samples", ",").alias("samples"))


@query(f"""WITH {CHUNKS} SELECT fault, count(*) AS n FROM (SELECT CASE WHEN fps <= 0 THEN 'bad_fps' WHEN fps > 240 THEN 'fps_too_high' WHEN chunk_end_ms - chunk_start_ms > 100000 * (1000.0 / fps) THEN 'too_many_targets' ELSE 'none' END AS fault
  FROM (SELECT *, CAST(substr(chunk_id, 7) AS INT) % 5 * 61 - 1.0 AS fps FROM chunks)) GROUP BY 1""")
def sampling_guards(spark, sf_dir):
    fps = F.substring("chunk_id", 7, 9).cast("int") % 5 * 61 - F.lit(1.0)
    fault = sampling.sampling_fault(fps, F.col("chunk_start_ms"), F.col("chunk_end_ms"))
    return _chunks(spark, sf_dir).select(F.coalesce(fault, F.lit("none")).alias("fault")).groupBy("fault").agg(F.count("*").alias("n"))


# --- D: requests


@query(f"""{SAMPLES}, listed AS (SELECT video_id, chunk_id, count(*) AS n FROM near GROUP BY 1, 2)
  SELECT 'coarse:' || video_id AS request_id, chunk_start_ms AS media_start_ms, chunk_end_ms AS media_end_ms, n::INT AS n_samples, chunk_end_ms - chunk_start_ms AS max_end_ms, chunk_end_ms - chunk_start_ms - 1 AS max_start_ms
  FROM chunks JOIN listed USING (video_id, chunk_id)""")
def coarse_requests(spark, sf_dir):
    pts = a.frames(spark, sf_dir).groupBy("video_id").agg(F.array_sort(F.collect_list("pts_ms")).alias("pts"))
    plans = sampling.sample_ranges(_chunks(spark, sf_dir).join(pts, "video_id").withColumn("path", F.lit("/v")), a.HOURLY_FPS).where(F.size("samples") > 0)
    made = requests.coarse_requests(plans, EVENT_CONTRACT)
    limit = lambda name: F.get_json_object("response_schema", f"$.properties.segments.items.properties.{name}.maximum").cast("bigint")
    return made.select("request_id", "media_start_ms", "media_end_ms", F.size("sample_timestamps_ms").alias("n_samples"), limit("end_ms").alias("max_end_ms"), limit("start_ms").alias("max_start_ms"))


_SCHEMA_SQL = """{"additionalProperties":false,"properties":{"segments":{"items":{"additionalProperties":false,"properties":{"end_ms":{"maximum":' || d || ',"minimum":1,"type":"integer"},"evidence_timestamps_ms":{"items":{"maximum":' || d - 1 || ',"minimum":0,"type":"integer"},"type":"array"},"segment_id":{"type":"string"},"sentence":{"minLength":1,"type":"string"},"start_ms":{"maximum":' || d - 1 || ',"minimum":0,"type":"integer"},"values":{"additionalProperties":false,"properties":{"action":{"enum":["view","click","purchase","signup"],"type":"string"},"note":{"type":"string"}},"required":["action"],"type":"object"}},"required":["segment_id","start_ms","end_ms","values","sentence","evidence_timestamps_ms"],"type":"object"},"type":"array"},"task_summary":{"minLength":1,"type":"string"}},"required":["task_summary","segments"],"type":"object"}"""


@query("WITH " + CHUNKS + ", c AS (SELECT video_id, chunk_id, chunk_end_ms - chunk_start_ms AS d FROM chunks) SELECT video_id, chunk_id, '" + _SCHEMA_SQL + "' AS response_schema FROM c")
def response_schemas(spark, sf_dir):
    """The whole response schema of each chunk, with its limits."""
    plans = _chunks(spark, sf_dir).withColumn("path", F.lit("/v")).withColumn("samples", F.array("chunk_start_ms"))
    return requests.coarse_requests(plans, EVENT_CONTRACT, ("chunk_id",)).select("video_id", "chunk_id", "response_schema")


WINDOW_MS = 4_000_000


def _windows(spark, sf_dir):
    rows = a.segments(spark, sf_dir)
    last = rows.groupBy("video_id").agg(F.max("end_ms").alias("chunk_end_ms"))
    return requests.boundary_windows(requests.with_neighbours(rows.join(last, "video_id").withColumn("chunk_start_ms", F.lit(0).cast("bigint"))), WINDOW_MS)


WINDOWS = f"""{a.SEGMENTS}, ends AS (SELECT video_id, max(end_ms) AS ce FROM segments GROUP BY 1),
centred AS (SELECT s.*, ce, k.kind, CASE k.kind WHEN 'start' THEN start_ms ELSE end_ms END AS c FROM segments s JOIN ends USING (video_id) CROSS JOIN (VALUES ('start'), ('end')) k(kind)),
windows AS (SELECT *, greatest(0, least(ce, greatest(0, c - {WINDOW_MS // 2}) + {WINDOW_MS}) - {WINDOW_MS}) AS ws, least(ce, greatest(0, c - {WINDOW_MS // 2}) + {WINDOW_MS}) AS we FROM centred)"""


@query(f"WITH {WINDOWS} SELECT video_id, segment_id, kind, ws AS window_start_ms, we AS window_end_ms FROM windows")
def boundary_windows(spark, sf_dir):
    return _windows(spark, sf_dir).select("video_id", "segment_id", "kind", "window_start_ms", "window_end_ms")


@query(f"WITH {a.SEGMENTS} SELECT video_id, segment_id, lag(segment_id) OVER ({ORDER}) AS previous_id, lead(segment_id) OVER ({ORDER}) AS following_id, lead(start_ms) OVER ({ORDER}) AS following_start_ms FROM segments")
def segment_neighbours(spark, sf_dir):
    rows = requests.with_neighbours(a.segments(spark, sf_dir))
    return rows.select("video_id", "segment_id", F.col("previous.segment_id").alias("previous_id"), F.col("following.segment_id").alias("following_id"), F.col("following.start_ms").alias("following_start_ms"))


@query(f"""WITH RECURSIVE {WINDOWS}, held AS (SELECT * FROM windows WHERE we - ws > 0),
  steps AS (SELECT video_id, segment_id, kind, ws, we, CAST(ws AS DOUBLE) AS cur FROM held UNION ALL SELECT video_id, segment_id, kind, ws, we, cur + 400000.0::DOUBLE FROM steps WHERE cur + 400000.0::DOUBLE < we),
  inside AS (SELECT w.video_id, segment_id, kind, f.start_ms AS pts FROM held w JOIN (SELECT DISTINCT video_id, start_ms FROM timed) f ON f.video_id = w.video_id AND f.start_ms >= ws AND f.start_ms < we),
  near AS (SELECT DISTINCT s.video_id, s.segment_id, s.kind, first(i.pts ORDER BY abs(i.pts - round_even(cur, 0)::BIGINT), i.pts) AS pts FROM steps s JOIN inside i USING (video_id, segment_id, kind) GROUP BY s.video_id, s.segment_id, s.kind, cur)
  SELECT video_id, segment_id, kind, string_agg(pts, ',' ORDER BY pts) AS samples FROM near GROUP BY 1, 2, 3""")
def window_samples(spark, sf_dir):
    """The frames that stand for the evenly spaced times of each boundary window."""
    pts = a.frames(spark, sf_dir).groupBy("video_id").agg(F.array_sort(F.collect_list("pts_ms")).alias("pts"))
    rows = sampling.sample_ranges(_windows(spark, sf_dir).drop("previous", "following", "values", "evidence").join(pts, "video_id"), 0.0025, "window_start_ms", "window_end_ms")
    return rows.where(F.size("samples") > 0).select("video_id", "segment_id", "kind", F.array_join("samples", ",").alias("samples"))


@query(f"""WITH {WINDOWS} SELECT kind || ' of ' || segment_id AS message FROM windows w WHERE NOT EXISTS (SELECT 1 FROM timed f WHERE f.video_id = w.video_id AND f.event_id % 3 = 0 AND f.start_ms >= ws AND f.start_ms < we)""")
def windows_without_frames(spark, sf_dir):
    pts = a.timed_events(spark, sf_dir).where("event_id % 3 = 0").groupBy("video_id").agg(F.collect_set("start_ms").alias("pts"))
    rows = _windows(spark, sf_dir).join(pts, "video_id", "left").withColumn("pts", F.coalesce("pts", F.expr("cast(array() as array<bigint>)")))
    return requests.windows_without_frames(rows).select("message")


@query(f"WITH {WINDOWS} SELECT 'boundary-' || kind || ':' || video_id || ':' || segment_id AS request_id, 'boundary-' || kind AS stage, segment_id AS asked, we - ws AS max_boundary_ms FROM windows")
def boundary_requests(spark, sf_dir):
    made = requests.boundary_requests(_windows(spark, sf_dir).withColumn("path", F.lit("/v")).withColumn("samples", F.array("window_start_ms")))
    get = lambda path, kind: F.try_variant_get(F.parse_json("response_schema"), path, kind)
    return made.select("request_id", "stage", get("$.properties.segment_id.const", "string").alias("asked"), get("$.properties.boundary_ms.maximum", "bigint").alias("max_boundary_ms"))


@query(f"""WITH {a.TIMED} SELECT segment_id AS request_id, CASE WHEN event_id % 5 = 0 THEN 'empty_range' ELSE 'sample_outside_range' END AS code FROM timed WHERE event_id % 5 = 0 OR event_id % 7 = 0""")
def bad_requests(spark, sf_dir):
    t = a.timed_events(spark, sf_dir)
    made = t.select("video_id", F.col("segment_id").alias("request_id"), F.col("start_ms").alias("media_start_ms"), (F.col("start_ms") + F.when(F.col("event_id") % 5 == 0, 0).otherwise(10)).alias("media_end_ms"), F.array(F.col("start_ms") + F.when(F.col("event_id") % 7 == 0, 10).otherwise(9)).alias("sample_timestamps_ms"))
    return requests.bad_requests(made).select(F.col("item_id").alias("request_id"), "code")


# --- E: responses


def _asked(spark, sf_dir):
    """A coarse request for each user, and a scripted response that covers the user's events; some are missing or wrong."""
    t = a.segments(spark, sf_dir)
    form = F.struct(
        F.array("start_ms").alias("evidence_timestamps_ms"),
        F.when(F.col("event_id") % 30 == 7, F.format_string("%d.0", "end_ms")).otherwise(F.col("end_ms").cast("string")).alias("end_ms"),
        "segment_id",
        "sentence",
        F.col("start_ms").cast("string").alias("start_ms"),
        "values",
    )
    # numbers are written without quotes so that 1000.0 stays as it is
    text = F.regexp_replace(F.to_json(form), r'"(start_ms|end_ms)":"([0-9.]+)"', r'"$1":$2')
    each = t.groupBy("video_id").agg(F.array_join(F.array_sort(F.collect_list(text)), ",").alias("body"), F.max("end_ms").alias("duration_ms"))
    user = F.regexp_extract("video_id", r"(\d+)$", 1).cast("int")
    each = each.withColumn("u", user)
    response = F.when(F.col("u") % 9 == 4, F.concat(F.lit('{"segments":['), "body", F.lit("]}"))).otherwise(F.concat(F.lit('{"task_summary":"day","segments":['), "body", F.lit("]}")))
    asked = each.select(F.concat(F.lit("coarse:"), "video_id").alias("request_id"), "video_id", F.lit(1000).cast("bigint").alias("media_start_ms"), (F.col("duration_ms") - F.when(F.col("u") % 8 == 3, 1).otherwise(0) + 1000).alias("media_end_ms"))
    script = each.where("u % 10 <> 5").select(F.concat(F.lit("coarse:"), "video_id").alias("request_id"), F.lit(1).alias("n"), response.alias("response"))
    return asked, script


ASKED = f"""{a.SEGMENTS}, who AS (SELECT video_id, CAST(regexp_extract(video_id, '(\\d+)$', 1) AS INT) AS u, max(end_ms) AS duration_ms FROM segments GROUP BY 1),
judged AS (SELECT s.*, u, duration_ms, CASE WHEN event_id % 30 = 7 THEN 'bad_segment' WHEN end_ms > duration_ms - CASE WHEN u % 8 = 3 THEN 1 ELSE 0 END OR start_ms >= duration_ms - CASE WHEN u % 8 = 3 THEN 1 ELSE 0 END THEN 'bad_bounds'
  WHEN event_type = 'error' THEN 'bad_values' END AS code FROM segments s JOIN who USING (video_id) WHERE u % 10 <> 5 AND u % 9 <> 4)"""


@query(f"WITH {ASKED} SELECT 'coarse:' || video_id AS message FROM who WHERE u % 10 = 5")
def exhausted_scripts(spark, sf_dir):
    asked, script = _asked(spark, sf_dir)
    return responses.attach(responses.numbered(asked), responses.scripted(script))[1].select("message")


@query(f"WITH {ASKED} SELECT video_id, segment_id, start_ms + 1000 AS start_ms, end_ms + 1000 AS end_ms, event_type AS action, sentence, start_ms + 1000 AS evidence FROM (SELECT *, 'do ' || event_type AS sentence FROM judged) WHERE code IS NULL")
def coarse_segments(spark, sf_dir):
    asked, script = _asked(spark, sf_dir)
    good, _ = responses.coarse_segments(responses.attach(responses.numbered(asked), responses.scripted(script))[0], EVENT_CONTRACT)
    return good.select("video_id", "segment_id", "start_ms", "end_ms", F.col("values")["action"].alias("action"), "sentence", F.element_at("evidence", 1).alias("evidence"))


@query(f"""WITH {ASKED} SELECT code, count(*) AS n FROM (SELECT code FROM judged WHERE code IS NOT NULL UNION ALL SELECT 'bad_response' FROM who WHERE u % 10 <> 5 AND u % 9 = 4) GROUP BY 1""")
def coarse_rejects(spark, sf_dir):
    asked, script = _asked(spark, sf_dir)
    _, bad = responses.coarse_segments(responses.attach(responses.numbered(asked), responses.scripted(script))[0], EVENT_CONTRACT)
    return bad.groupBy("code").agg(F.count("*").alias("n"))


@query(f"""WITH {ASKED}, calls AS (SELECT 'coarse:' || video_id AS request_id, u, unnest([1, 2, 3]) AS n FROM who)
  SELECT request_id, n AS call, CASE WHEN n <= 1 + u % 3 THEN request_id || '#' || n END AS response FROM calls WHERE n = 1 OR u % 2 = 0 OR n = 2 AND u % 4 = 1""")
def repeated_calls(spark, sf_dir):
    """The n-th request of an id, in order of its range, gets the n-th response of its script."""
    asked, _ = _asked(spark, sf_dir)
    user = F.regexp_extract("video_id", r"(\d+)$", 1).cast("int")
    calls = asked.withColumn("u", user).withColumn("k", F.explode(F.array(F.lit(3), F.lit(1), F.lit(2))))
    calls = calls.where("k = 1 OR u % 2 = 0 OR k = 2 AND u % 4 = 1").withColumn("media_start_ms", F.col("media_start_ms") + F.col("k") * 100)
    script = asked.withColumn("u", user).select("request_id", F.explode(F.sequence(F.lit(1), 1 + F.col("u") % 3)).alias("n")).withColumn("response", F.concat("request_id", F.lit("#"), F.col("n").cast("string")))
    return responses.scripted(script)(responses.numbered(calls)).select("request_id", F.col("n").alias("call"), "response")


def _replies(spark, sf_dir):
    """Boundary responses for the windows: mostly right, some with another id, a quoted number or a late boundary."""
    w = _windows(spark, sf_dir)
    at = F.col("centre_ms") - F.col("window_start_ms")
    k = F.col("event_id")
    number = F.when(k % 12 == 5, F.concat(F.lit('"'), at.cast("string"), F.lit('"'))).when(k % 12 == 7, (F.col("window_end_ms") - F.col("window_start_ms") + 1).cast("string")).otherwise(at.cast("string"))
    body = F.concat(F.lit('{"segment_id":"'), F.when(k % 12 == 3, "other").otherwise(F.col("segment_id")), F.lit('","boundary_kind":"'), "kind", F.lit('","boundary_ms":'), number, F.lit(',"evidence_timestamps_ms":[0,0]}'))
    return w.select("video_id", "segment_id", "kind", F.concat_ws(":", "kind", "segment_id").alias("request_id"), F.col("window_start_ms").alias("media_start_ms"), F.col("window_end_ms").alias("media_end_ms"), body.alias("response"))


@query(f"WITH {WINDOWS} SELECT video_id, segment_id, kind, c AS boundary_ms, ws AS evidence FROM windows WHERE event_id % 12 NOT IN (3, 5, 7)")
def boundary_decisions(spark, sf_dir):
    return responses.boundaries(_replies(spark, sf_dir))[0].select("video_id", "segment_id", "kind", "boundary_ms", F.element_at("evidence", 1).alias("evidence"))


@query(f"WITH {WINDOWS} SELECT CASE event_id % 12 WHEN 3 THEN 'other_boundary' WHEN 5 THEN 'bad_response' ELSE 'bad_bounds' END AS code, count(*) AS n FROM windows WHERE event_id % 12 IN (3, 5, 7) GROUP BY 1")
def boundary_rejects(spark, sf_dir):
    return responses.boundaries(_replies(spark, sf_dir))[1].groupBy("code").agg(F.count("*").alias("n"))


@query(f"WITH {WINDOWS} SELECT video_id, segment_id, start_ms, end_ms, CASE WHEN min(ws) = max(ws) THEN min(ws)::VARCHAR ELSE min(ws) || ',' || max(ws) END AS evidence FROM windows WHERE event_id % 12 NOT IN (3, 5, 7) GROUP BY ALL")
def refined_segments(spark, sf_dir):
    good, _ = responses.refined_segments(a.segments(spark, sf_dir), responses.boundaries(_replies(spark, sf_dir))[0])
    return good.select("video_id", "segment_id", "start_ms", "end_ms", F.array_join("evidence", ",").alias("evidence"))


# --- F: timelines


@query(f"""WITH {a.SEGMENTS}, {a.VIDEOS}, {MERGED},
  counted AS (SELECT video_id, count(*)::INT AS n, bool_or(end_ms - start_ms < 300) AS short, sum(CASE WHEN members > 1 THEN 1 ELSE 0 END)::INT AS joined FROM merged GROUP BY 1),
  shifts AS (SELECT video_id, max(event_id % 7 * 500) AS shift FROM segments GROUP BY 1),
  q AS (SELECT video_id, coalesce(shift, 0) AS shift, coalesce(n, 0) AS n, coalesce(joined, 0) AS joined, coalesce(shift > 2000, false) AS r1, coalesce(short, false) AS r2 FROM videos LEFT JOIN counted USING (video_id) LEFT JOIN shifts USING (video_id))
  SELECT video_id, greatest(0.0, 1 - 0.2::DOUBLE * (r1::INT + r2::INT))::DOUBLE AS score, shift AS max_boundary_shift_ms, n AS segment_count, n = 0 AS empty_timeline, joined AS merged_segments,
    CASE WHEN r1 THEN 'boundary_shift_gt_2s' ELSE '' END || CASE WHEN r1 AND r2 THEN ',' ELSE '' END || CASE WHEN r2 THEN 'segment_shorter_than_minimum' ELSE '' END AS review_reasons FROM q""")
def timeline_quality(spark, sf_dir):
    rows = a.segments(spark, sf_dir)
    found = timeline.quality(a.videos(spark, sf_dir), timeline.merge_segments(rows, GAP_MS), timeline.boundary_shifts(rows, a.moved(rows)))
    return found.select("video_id", "score", "max_boundary_shift_ms", "segment_count", "empty_timeline", F.size("merged_segment_sources").alias("merged_segments"), F.array_join("review_reasons", ",").alias("review_reasons"))


@query(f"WITH {a.SEGMENTS}, {MERGED} SELECT video_id, segment_id, start_ms, end_ms, action, CASE WHEN members > 1 THEN ids END AS sources FROM merged")
def merged_segments(spark, sf_dir):
    rows = timeline.merge_segments(a.segments(spark, sf_dir), GAP_MS)
    return rows.select("video_id", "segment_id", "start_ms", "end_ms", F.col("values")["action"].alias("action"), F.array_join("sources", ",").alias("sources"))


@query(f"""WITH {a.CLASHING}, {ISLANDS}, heads AS (SELECT *, lag(island) OVER ({ORDER}) AS before FROM numbered),
  named AS (SELECT *, first_value(segment_id) OVER (PARTITION BY video_id, island ORDER BY start_ms, end_ms, segment_id) AS head FROM heads),
  found AS (SELECT *, lag(head) OVER ({ORDER}) AS head_id FROM named)
  SELECT video_id, 'different-label' AS kind, head_id, segment_id FROM (SELECT *, row_number() OVER ({ORDER}) AS nth FROM found WHERE island <> before AND start_ms < reach) WHERE nth = 1""")
def overlap_conflicts(spark, sf_dir):
    return timeline.conflicts(a.clashing_segments(spark, sf_dir), GAP_MS)


@query(f"""WITH {a.STREAM}, {MERGED} SELECT video_id, segment_id, start_ms, end_ms, action, members FROM merged""")
def long_timeline(spark, sf_dir):
    """All events as the segments of one video, merged by ranges of time."""
    rows = timeline.merge_segments(a.one_timeline(spark, sf_dir), GAP_MS, long=True)
    return rows.select("video_id", "segment_id", "start_ms", "end_ms", F.col("values")["action"].alias("action"), F.coalesce(F.size("sources"), F.lit(1)).cast("bigint").alias("members"))


@query(f"""WITH {a.STREAM}, {ISLANDS}, heads AS (SELECT *, lag(island) OVER ({ORDER}) AS before FROM numbered),
  named AS (SELECT *, first_value(segment_id) OVER (PARTITION BY video_id, island ORDER BY start_ms, end_ms, segment_id) AS head FROM heads),
  found AS (SELECT *, lag(head) OVER ({ORDER}) AS head_id FROM named)
  SELECT video_id, 'different-label' AS kind, head_id, segment_id FROM (SELECT *, row_number() OVER ({ORDER}) AS nth FROM found WHERE island <> before AND start_ms < reach) WHERE nth = 1""")
def long_timeline_conflict(spark, sf_dir):
    return timeline.conflicts(a.one_timeline(spark, sf_dir), GAP_MS, long=True)


@query(f"WITH {a.SEGMENTS} SELECT video_id, segment_id, event_id % 7 * 500 AS shift_ms FROM segments")
def boundary_shifts(spark, sf_dir):
    rows = a.segments(spark, sf_dir)
    return timeline.boundary_shifts(rows, a.moved(rows))


@query(f"""WITH {a.TIMED} SELECT video_id, 'coarse only: ' || coalesce(string_agg(segment_id, ', ' ORDER BY segment_id) FILTER (event_id % 13 = 0), '') || '; refined only: ' || coalesce(string_agg(segment_id, ', ' ORDER BY segment_id) FILTER (event_id % 11 = 0), '') AS message
  FROM timed WHERE (event_id % 11 = 0) <> (event_id % 13 = 0) GROUP BY 1""")
def unequal_ids(spark, sf_dir):
    rows = a.segments(spark, sf_dir)
    return timeline.unequal_ids(rows.where("event_id % 11 <> 0"), rows.where("event_id % 13 <> 0")).select("video_id", "message")


@query(f"WITH {a.TIMED} SELECT video_id, string_agg(segment_id, ', ' ORDER BY segment_id) AS message FROM timed WHERE event_id % 19 = 0 GROUP BY 1")
def duplicate_ids(spark, sf_dir):
    rows = a.segments(spark, sf_dir)
    return timeline.duplicate_ids(rows.union(rows.where("event_id % 19 = 0")), "coarse").select("video_id", "message")


@query(f"WITH {a.TIMED} SELECT video_id, segment_id AS message FROM timed WHERE event_id % 17 = 0")
def blank_sentences(spark, sf_dir):
    rows = a.segments(spark, sf_dir).withColumn("sentence", F.when(F.col("event_id") % 17 == 0, " 　\t").otherwise(F.col("sentence")))
    return timeline.blank_sentences(rows).select("video_id", "message")


@query(f"""WITH {a.CLASHING}, ends AS (SELECT video_id, max(start_ms) + 1 AS duration_ms FROM timed GROUP BY 1), reached AS (SELECT *, max(end_ms) OVER ({ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM segments)
  SELECT code, video_id, segment_id AS message FROM (SELECT *, CASE WHEN start_ms < reach THEN 'overlap' WHEN end_ms > duration_ms THEN 'after_duration' END AS code FROM reached JOIN ends USING (video_id)) WHERE code IS NOT NULL""")
def timeline_faults(spark, sf_dir):
    rows = a.clashing_segments(spark, sf_dir)
    ends = rows.groupBy("video_id").agg((F.max("start_ms") + 1).alias("duration_ms"))
    return timeline.timeline_faults(rows, ends).select("code", "video_id", "message")


# --- G: identity and artifacts


@query("""WITH rows AS (SELECT doc_id::VARCHAR AS key, sha256(text) AS digest, ('0x' || substring(md5(doc_id::VARCHAR), 1, 8))::BIGINT % (SELECT greatest(1, (count(*) + 63) // 64) FROM documents) AS part FROM documents)
  SELECT part, sha256(string_agg(length(key) || ' ' || key || ' ' || digest, chr(10) ORDER BY length(key) || ' ' || key || ' ' || digest)) AS digest FROM rows GROUP BY 1""")
def content_digests(spark, sf_dir):
    d = a.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("key"), F.sha2("text", 256).alias("digest"))
    return identity.part_digests(d, max(1, -(-d.count() // 64)))


ARTIFACTS = f"""WITH {a.SEGMENTS}, {MERGED} SELECT video_id, '{{"segments":[' || string_agg('{{"end_ms":' || end_ms || ',"segment_id":"' || segment_id || '","start_ms":' || start_ms || ',"values":{{"action":"' || action || '"}}}}', ',' ORDER BY start_ms, segment_id) || '],"video_id":"' || video_id || '"}}' AS json FROM merged GROUP BY video_id"""


def _artifacts(spark, sf_dir):
    rows = timeline.merge_segments(a.segments(spark, sf_dir), GAP_MS)
    each = rows.groupBy("video_id").agg(F.collect_list(F.struct("start_ms", "segment_id", "end_ms", F.col("values")["action"].alias("action"))).alias("all"))
    made = F.transform(F.array_sort("all"), lambda s: F.struct(s["end_ms"].alias("end_ms"), s["segment_id"].alias("segment_id"), s["start_ms"].alias("start_ms"), F.create_map(F.lit("action"), s["action"]).alias("values")))
    return sinks.artifact_rows(each.withColumn("segments", made), "run-1", "final", F.struct("segments", "video_id"))


@query(f"SELECT video_id, json, sha256(json) AS sha256, 'run-1' AS run_id, 'final' AS stage FROM ({ARTIFACTS})")
def stage_artifacts(spark, sf_dir):
    return _artifacts(spark, sf_dir)


@query(f"SELECT row_number() OVER (ORDER BY video_id)::INT AS line, json FROM ({ARTIFACTS})")
def jsonl_export(spark, sf_dir):
    return sinks.numbered_lines(_artifacts(spark, sf_dir)).withColumn("line", F.col("line").cast("int"))


@query(f"WITH {ITEMS} SELECT video_id, path AS message FROM items WHERE c_custkey = 11")
def output_aliases(spark, sf_dir):
    return identity.aliased_videos(_items(spark, sf_dir)[0], "/data/raw/../raw/11.mp4").select("video_id", "message")


# --- the whole run

#: A user's events as a short video: the n-th event is at n * 100 ms and lasts 100 ms; two of three are segments. One user in five has an event type that the contract doesn't know.
SHORT = f"""{a.TIMED}, placed AS (SELECT * REPLACE (CASE WHEN event_type = 'error' AND CAST(regexp_extract(video_id, '(\\d+)$', 1) AS INT) % 5 <> 0 THEN 'click' ELSE event_type END AS event_type), (row_number() OVER (PARTITION BY video_id ORDER BY start_ms, event_id) - 1) * 100 AS pos, count(*) OVER (PARTITION BY video_id) * 100 AS duration_ms, CAST(regexp_extract(video_id, '(\\d+)$', 1) AS INT) AS u FROM timed),
segments AS (SELECT video_id, segment_id, event_type, pos AS start_ms, pos + 100 AS end_ms FROM placed WHERE pos // 100 % 3 < 2)"""


def _short_videos(spark, sf_dir):
    user = F.regexp_extract("video_id", r"(\d+)$", 1).cast("int")
    t = a.timed_events(spark, sf_dir).withColumn("event_type", F.when((F.col("event_type") == "error") & (user % 5 != 0), "click").otherwise(F.col("event_type")))
    each = t.groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct("start_ms", "event_id", "segment_id", "event_type"))).alias("e"))
    return each.select("video_id", F.regexp_extract("video_id", r"(\d+)$", 1).cast("int").alias("u"), F.size("e").alias("n"), F.transform("e", lambda x, i: F.struct((i * 100).cast("bigint").alias("at"), x["segment_id"].alias("segment_id"), x["event_type"].alias("event_type"))).alias("e"))


def _run(spark, sf_dir):
    """The whole job over short videos: every 7th user has no script, every 11th a boundary that was asked for and isn't there."""
    v = _short_videos(spark, sf_dir)
    items = v.select("video_id", F.concat("video_id", F.lit(".mp4")).alias("video_uri"), F.lit("d").alias("dataset_id"), F.lit("events-1").alias("schema_version"), F.lit("events").alias("ontology_id"), F.lit("{}").alias("context"), F.lit("{}").alias("metadata"), F.concat(F.lit("/v/"), "video_id").alias("path"))
    frames = F.transform("e", lambda x: F.struct(F.format_string("%.3f", x["at"] / 1000.0).alias("best_effort_timestamp_time")))
    stream = F.struct(F.lit("64").alias("width"), F.lit("64").alias("height"), F.lit("10/1").alias("avg_frame_rate"), F.format_string("%.3f", F.col("n") / 10.0).alias("duration"), F.lit("0").alias("start_time"))
    probes = v.select("video_id", F.to_json(F.struct(F.array(stream).alias("streams"), F.struct(F.lit("1").alias("duration")).alias("format"), frames.alias("frames"))).alias("probe"))
    chosen = F.filter("e", lambda x: x["at"] / 100 % 3 < 2)
    segments = F.transform(chosen, lambda x: F.struct(F.array(x["at"]).alias("evidence_timestamps_ms"), (x["at"] + 100).alias("end_ms"), x["segment_id"].alias("segment_id"), F.concat(F.lit("do "), x["event_type"]).alias("sentence"), x["at"].alias("start_ms"), F.create_map(F.lit("action"), x["event_type"]).alias("values")))
    script = v.where("u % 7 <> 0").select(F.concat(F.lit("coarse:"), "video_id").alias("request_id"), F.to_json(F.struct(F.lit("day").alias("task_summary"), segments.alias("segments"))).alias("response"))
    ends = v.select("video_id", "u", (F.col("n") * 100).cast("bigint").alias("d"), F.explode(chosen).alias("x")).select("*", F.explode(F.array(F.lit("start"), F.lit("end"))).alias("kind")).where("u % 11 <> 0 OR x.at > 0")
    at = F.when(F.col("kind") == "start", F.col("x.at")).otherwise(F.col("x.at") + 100)
    first = F.greatest(F.lit(0), F.least(F.col("d"), F.greatest(F.lit(0), at - 2000) + 4000) - 4000)
    reply = F.struct((at - first).alias("boundary_ms"), F.col("kind").alias("boundary_kind"), F.array(F.col("x.at") - first).alias("evidence_timestamps_ms"), F.col("x.segment_id").alias("segment_id"))
    replies = ends.select(F.concat(F.lit("boundary-"), "kind", F.lit(":"), "video_id", F.lit(":"), "x.segment_id").alias("request_id"), F.to_json(reply).alias("response"))
    return job.run_annotation(items, probes, EVENT_CONTRACT, responses.scripted(script.union(replies).withColumn("n", F.lit(1))), job.RunConfig(coarse_fps=5.0, refine_fps=5.0))


#: Videos with a reject and the code of it: no script, a missing boundary, or an event type that the contract doesn't know.
STOPPED = """stopped AS (SELECT DISTINCT video_id FROM placed p WHERE duration_ms > 120000 OR u % 7 = 0 OR u % 11 = 0 OR event_type = 'error' AND pos // 100 % 3 < 2)"""


@query(f"""WITH {SHORT}, {STOPPED}, {ISLANDS.replace(str(GAP_MS), '250')},
  merged AS (SELECT video_id, island, first(segment_id ORDER BY start_ms) AS segment_id, min(start_ms) AS start_ms, max(end_ms) AS end_ms, min(event_type) AS action FROM numbered WHERE video_id NOT IN (SELECT video_id FROM stopped) GROUP BY 1, 2)
  SELECT video_id, count(*)::INT AS segments, string_agg(segment_id || ':' || start_ms || '-' || end_ms || ':' || action, ',' ORDER BY start_ms) AS timeline,
    CASE WHEN bool_or(end_ms - start_ms < 300) THEN 0.8 ELSE 1.0 END::DOUBLE AS score FROM merged GROUP BY 1""")
def run_documents(spark, sf_dir):
    found = _run(spark, sf_dir).documents
    line = F.transform("segments", lambda s: F.concat_ws(":", s["segment_id"], F.concat_ws("-", s["start_ms"].cast("string"), s["end_ms"].cast("string")), s["values"]["action"]))
    return found.select("video_id", F.size("segments").alias("segments"), F.array_join(line, ",").alias("timeline"), "score")


@query(f"""WITH {SHORT}, short AS (SELECT * FROM placed WHERE duration_ms <= 120000)
  SELECT 'no_response' AS code, count(DISTINCT video_id) AS n FROM short WHERE u % 7 = 0 HAVING count(*) > 0 UNION ALL
  SELECT 'bad_values', count(*) FROM short WHERE u % 7 <> 0 AND event_type = 'error' AND pos // 100 % 3 < 2 HAVING count(*) > 0""")
def run_rejects(spark, sf_dir):
    found = _run(spark, sf_dir).rejects.where("code = 'bad_values' OR code = 'no_response' AND item_id LIKE 'coarse:%'")
    return found.groupBy("code").agg(F.count("*").alias("n"))
