"""Identity of a run and its files."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from pathlib import Path
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.canonical import canonical_json
from ..sources.manifest import reject

STAGE_VERSIONS = {"chunk": "1", "coarse": "1", "refine": "1", "finalise": "1"}


def file_digests(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """``path, length, digest`` of whole files below 2 GB."""
    return spark.read.format("binaryFile").load(paths).select("path", "length", F.sha2("content", 256).alias("digest"))


def present_files(files: DataFrame, path: str = "path") -> DataFrame:
    """``path, digest`` of files on storage that executors mount; the digest is null where there is no such file."""
    return streamed_digests(files, path, missing=True)


def streamed_digests(files: DataFrame, path: str = "path", block: int = 1 << 20, missing: bool = False) -> DataFrame:
    """``path, digest`` of files of any size on storage that executors mount, read in blocks. A file that isn't there is an error, or with ``missing`` a null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for name in batch.column(0).to_pylist():
                if missing and not Path(name.removeprefix("file:")).is_file():
                    found.append(None)
                    continue
                with open(name.removeprefix("file:"), "rb") as f:
                    digest = hashlib.sha256()
                    while data := f.read(block):
                        digest.update(data)
                found.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=["path", "digest"])

    return files.select(F.col(path).alias("path")).mapInArrow(run, "path string, digest string")


#: Digests that are folded into one at a time.
FOLDED = 4096


def part_digests(rows: DataFrame, parts: int) -> DataFrame:
    """``part, digest`` of ``key, digest`` rows: the digest of a part's rows in order. A key's part follows from its own digest."""
    part = F.conv(F.substring(F.md5("key"), 1, 8), 16, 10).cast("long") % parts
    row = F.concat_ws(" ", F.length("key").cast("string"), "key", "digest")
    return rows.select(part.alias("part"), row.alias("row")).groupBy("part").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("row")), "\n"), 256).alias("digest"))


def video_set_digest(digests: DataFrame) -> str:
    """One digest for ``video_id, digest`` rows in any order: rows are folded into parts, as many as keep a part small, and these again."""
    rows, n = digests.select(F.col("video_id").alias("key"), "digest"), digests.count()
    while n > FOLDED:
        rows = part_digests(rows, -(-n // FOLDED)).select(F.col("part").cast("string").alias("key"), "digest")
        n = rows.count()
    last = part_digests(rows, 1).first()
    return last.digest if last else hashlib.sha256(b"").hexdigest()


def run_id(config: dict[str, Any], identity: dict[str, Any]) -> str:
    return "run-" + hashlib.sha256(canonical_json({"config": config, "identity": identity}).encode()).hexdigest()


def _below(path: str, folder: str) -> bool:
    return path == folder or path.startswith(folder.rstrip("/") + "/")


def output_alias(output: str, inputs: dict[str, str]) -> str | None:
    """The name of an input that writing the output would replace, before anything is written: its file, under any name or link, or one in the output's folder."""
    place = Path(output).resolve()
    for name, path in inputs.items():
        here = Path(path).resolve()
        if _below(str(here), str(place)) or (here.exists() and place.exists() and here.samefile(place)):
            return name
    return None


def aliased_videos(items: DataFrame, output: str) -> DataFrame:
    """Rejects for items whose file is the output or lies in its folder."""
    place = str(Path(output).resolve())
    return reject(items.where((F.col("path") == place) | F.col("path").startswith(place.rstrip("/") + "/")), "output", "output_is_input", F.col("path"))


def linked_videos(items: DataFrame, output: str) -> DataFrame:
    """Rejects for items whose file is the output's by a hard or symbolic link, on storage that executors mount; others see no link and give none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = Path(output)
        for batch in batches:
            if place.is_file():
                same = [p is not None and os.path.exists(p) and os.path.samefile(p, place) for p in batch.column("path").to_pylist()]
                yield batch.filter(pa.array(same, pa.bool_()))

    named = items.select("video_id", "path")
    return reject(named.mapInArrow(run, named.schema), "output", "output_is_input", F.col("path"))
