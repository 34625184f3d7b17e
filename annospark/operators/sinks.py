"""Stage artifacts and the export of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.canonical import to_canonical_json
from ..functions.ordered import numbered
from ..sources.manifest import unsafe_id

STAGES = ("coarse-sample-plan", "coarse", "refined", "final")


def artifact_rows(rows: DataFrame, run: str, stage: str, document: Column) -> DataFrame:
    """``video_id, json, sha256, run_id, stage``; the struct's fields are in alphabetical order."""
    if stage not in STAGES:
        raise ValueError(f"unknown stage {stage}")
    return rows.where(~unsafe_id(F.col("video_id"))).select("video_id", to_canonical_json(document).alias("json")).select("video_id", "json", F.sha2("json", 256).alias("sha256"), F.lit(run).alias("run_id"), F.lit(stage).alias("stage"))


def write_artifacts(rows: DataFrame, root: str) -> None:
    """A rerun replaces its own stages' partitions and no others."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id", "stage").parquet(root)


def read_artifacts(spark: SparkSession, root: str, run: str, stage: str) -> DataFrame:
    """``video_id, json, sha256`` of one stage: only its partition is read."""
    return spark.read.parquet(root).where((F.col("run_id") == run) & (F.col("stage") == stage)).select("video_id", "json", "sha256")


def document(row_quality: Column, provenance: Column) -> Column:
    """A finished annotation as a struct in alphabetical order; ``segments`` is an array of such structs."""
    return F.struct(F.col("duration_ms"), provenance.alias("provenance"), row_quality.alias("quality"), F.col("segments"), F.col("task_summary"), F.col("video_id"))


def numbered_lines(lines: DataFrame) -> DataFrame:
    """``line, json``: the lines of an export with their numbers, in order of ``video_id``."""
    return numbered(lines.select("video_id", "json"), ["video_id"]).select("line", "json")


def export_jsonl(lines: DataFrame, path: str, files: int | None = None) -> None:
    """``video_id, json`` as text in order of ``video_id``, over as many files as ranges (one only when asked)."""
    ordered = lines.repartitionByRange(files, "video_id").sortWithinPartitions("video_id") if files else lines.orderBy("video_id")
    ordered.select(F.col("json").alias("value")).write.mode("overwrite").text(path)
