"""The given tables as models of the annotation job, and the same as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

DAY_MS = 86_400_000
CHUNK_MS, CHUNK_OVERLAP_MS, HOURLY_FPS = 2 * DAY_MS, DAY_MS // 6, 1000.0 / 3_600_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def timed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by user as a video, with milliseconds since the user's first one."""
    events = table(spark, sf_dir, "events")
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    first = F.min(ms).over(Window.partitionBy("user_id"))
    return events.select(F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("video_id"), F.concat(F.lit("ev-"), F.lpad(F.col("event_id").cast("string"), 9, "0")).alias("segment_id"), "event_id", "event_type", "value", (ms - first).alias("start_ms"))


TIMED = """timed AS (SELECT 'user-' || user_id AS video_id, 'ev-' || lpad(CAST(event_id AS VARCHAR), 9, '0') AS segment_id, event_id, event_type, value,
  epoch_us(ts) // 1000 - min(epoch_us(ts) // 1000) OVER (PARTITION BY user_id) AS start_ms FROM events)"""


def _segments(timed: DataFrame, end: F.Column) -> DataFrame:
    return timed.withColumn("end_ms", end).select("video_id", "segment_id", "event_id", "start_ms", "end_ms", F.create_map(F.lit("action"), "event_type").alias("values"), F.concat(F.lit("do "), "event_type").alias("sentence"), F.array("start_ms").alias("evidence"))


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments without conflicts: an event lasts by its value, at most to the next one."""
    timed = timed_events(spark, sf_dir)
    following = F.lead("start_ms").over(Window.partitionBy("video_id").orderBy("start_ms", "segment_id"))
    raw = timed.withColumn("following", following)
    return _segments(raw, F.greatest(F.col("start_ms") + 1, F.least(F.col("start_ms") + F.floor(F.col("value") * 100_000) + 1, F.coalesce("following", F.lit(1 << 60)))))


SEGMENTS = f"""{TIMED}, raw AS (SELECT *, lead(start_ms) OVER (PARTITION BY video_id ORDER BY start_ms, segment_id) AS following FROM timed),
segments AS (SELECT video_id, segment_id, event_id, event_type, start_ms,
  greatest(start_ms + 1, least(start_ms + CAST(floor(value * 100000) AS BIGINT) + 1, coalesce(following, 1152921504606846976))) AS end_ms FROM raw)"""


def clashing_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments that may overlap."""
    return _segments(timed_events(spark, sf_dir), F.col("start_ms") + F.floor(F.col("value") * 10_000) + 1)


CLASHING = f"""{TIMED}, segments AS (SELECT video_id, segment_id, event_id, event_type, start_ms, start_ms + CAST(floor(value * 10000) AS BIGINT) + 1 AS end_ms FROM timed)"""


def one_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as segments of one video, which overlap in part."""
    first = table(spark, sf_dir, "events").agg(F.min(F.unix_millis(F.col("ts").cast("timestamp"))).alias("first"))
    events = table(spark, sf_dir, "events").crossJoin(F.broadcast(first))  # one row
    timed = events.select(F.lit("stream").alias("video_id"), F.concat(F.lit("ev-"), F.lpad(F.col("event_id").cast("string"), 9, "0")).alias("segment_id"), "event_id", "event_type", "value", (F.unix_millis(F.col("ts").cast("timestamp")) - F.col("first")).alias("start_ms"))
    return _segments(timed, F.col("start_ms") + F.floor(F.col("value") * 10_000) + 1)


STREAM = """segments AS (SELECT 'stream' AS video_id, 'ev-' || lpad(CAST(event_id AS VARCHAR), 9, '0') AS segment_id, event_type,
  epoch_us(ts) // 1000 - min(epoch_us(ts) // 1000) OVER () AS start_ms, start_ms + CAST(floor(value * 10000) AS BIGINT) + 1 AS end_ms FROM events)"""


def moved(rows: DataFrame) -> DataFrame:
    """The same segments with boundaries moved by up to 3 s, as refinement would."""
    by = F.pmod("event_id", F.lit(7)) * 500
    return rows.withColumn("start_ms", F.col("start_ms") + by).withColumn("end_ms", F.col("end_ms") + by)


def videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``video_id, duration_ms``: up to the last event. Customers who are no users have none, and a duration of a day."""
    seen = timed_events(spark, sf_dir).groupBy("video_id").agg((F.max("start_ms") + 1).alias("duration_ms"))
    every = table(spark, sf_dir, "customer").select(F.concat(F.lit("user-"), F.col("c_custkey").cast("string")).alias("video_id"))
    return every.union(seen.select("video_id")).distinct().join(seen, "video_id", "left").select("video_id", F.coalesce("duration_ms", F.lit(DAY_MS)).alias("duration_ms"))


VIDEOS = """videos AS (SELECT v.video_id, coalesce(s.duration_ms, 86400000) AS duration_ms FROM
  (SELECT 'user-' || c_custkey AS video_id FROM customer UNION SELECT video_id FROM timed) v
  LEFT JOIN (SELECT video_id, max(start_ms) + 1 AS duration_ms FROM timed GROUP BY 1) s USING (video_id))"""


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timed_events(spark, sf_dir).select("video_id", F.col("start_ms").alias("pts_ms")).distinct()
