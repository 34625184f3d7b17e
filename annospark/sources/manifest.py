"""Manifests of videos: JSON lines, and the checks of a whole manifest.

Every check returns rows ``stage, video_id, item_id, code, message``; nothing stops the job until :func:`raise_rejects` is asked to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.once import once

FIELDS = ("video_id", "video_uri", "dataset_id", "schema_version", "ontology_id")
KEYS = (*FIELDS, "context", "metadata")
REJECT = "stage string, video_id string, item_id string, code string, message string"


class RejectedRows(ValueError):
    """Strict mode met rejects."""


def reject(rows: DataFrame, stage: str, code: str | Column, message: Column, video: Column | None = None, item: Column | None = None) -> DataFrame:
    """Rows of the rejects table."""
    none = F.lit(None).cast("string")
    return rows.select(F.lit(stage).alias("stage"), (F.col("video_id") if video is None else video).cast("string").alias("video_id"), (none if item is None else item.cast("string")).alias("item_id"), (F.lit(code) if isinstance(code, str) else code).alias("code"), message.alias("message"))


def raise_rejects(rejects: DataFrame, show: int = 5) -> None:
    if first := rejects.orderBy("stage", "video_id", "item_id", "code").take(show):
        raise RejectedRows("; ".join(f"{r.code} [{r.video_id}]: {r.message}" for r in first))


#: Rejects that concern the run and not one video; so does any reject without a video or with an empty id.
RUN_LEVEL = ("output_is_input",)


def stop_run(rejects: DataFrame) -> None:
    """Raises on rejects of the whole run: a line that names no video, no items at all, several datasets, an output that is an input."""
    raise_rejects(rejects.where((F.coalesce("video_id", F.lit("")) == "") | F.col("code").isin(*RUN_LEVEL)))


def normal_path(path: Column) -> Column:
    """A path without ``.`` and ``..`` steps."""
    steps = F.filter(F.split(path, "/"), lambda s: ~s.isin("", "."))
    folded = F.aggregate(steps, F.expr("cast(array() as array<string>)"), lambda done, s: F.when(s == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(F.concat(done, F.array(s))))
    return F.concat(F.when(path.startswith("/"), "/").otherwise(""), F.array_join(folded, "/"))


def resolved_uri(uri: Column, folder: str) -> Column:
    """The path of a local uri; null for one with a scheme."""
    return F.when(~uri.contains("://"), normal_path(F.when(uri.startswith("/"), uri).otherwise(F.concat(F.lit(folder.rstrip("/") + "/"), uri))))


def parse_manifest(lines: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Items and rejects of manifest lines (column ``value``). Blank lines don't count.

    Unknown keys, missing, empty or non-string ids, and uris with a scheme are rejected. ``context`` and ``metadata`` are
    JSON text, ``{}`` by default, and must be objects.
    """
    rows = once(lines.select("value").where(F.trim("value") != ""), json=F.try_parse_json("value"), keys=F.json_object_keys("value"))
    text = lambda name: F.when(F.schema_of_variant(F.variant_get("json", f"$.{name}", "variant")) == "STRING", F.try_variant_get("json", f"$.{name}", "string"))
    part = lambda name: F.coalesce(F.to_json(F.variant_get("json", f"$.{name}", "variant")), F.lit("{}"))
    found = once(rows, **{n: text(n) for n in FIELDS}, **{n: part(n) for n in ("context", "metadata")})
    extra = F.array_sort(F.array_except("keys", F.array(*map(F.lit, KEYS))))
    empty = F.array_compact(F.array(*(F.when(F.coalesce(F.length(n), F.lit(0)) == 0, F.lit(n)) for n in FIELDS)))
    flawed = F.array_compact(F.array(*(F.when(~F.col(n).startswith("{"), F.lit(n)) for n in ("context", "metadata"))))
    code = F.when(F.col("json").isNull() | F.col("keys").isNull(), "not_json").when(F.size(extra) > 0, "unknown_keys").when(F.size(empty) > 0, "empty_field").when(F.size(flawed) > 0, "not_object").when(F.col("video_uri").contains("://"), "remote_uri")
    message = F.when(F.size(extra) > 0, F.array_join(extra, ", ")).when(F.size(empty) > 0, F.array_join(empty, ", ")).when(F.size(flawed) > 0, F.array_join(flawed, ", ")).otherwise(F.substring("value", 1, 200))
    judged = once(found, code=code, message=message)
    items = once(judged.where(F.col("code").isNull()), path=resolved_uri(F.col("video_uri"), folder))
    return items.select(*FIELDS, "context", "metadata", "path"), reject(judged.where(F.col("code").isNotNull()), "manifest", F.col("code"), F.col("message"))


def read_manifest(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return parse_manifest(spark.read.text(path), path.rsplit("/", 1)[0] if "/" in path else ".")


def repeated_items(items: DataFrame, by: tuple[str, ...] = ("dataset_id", "video_id")) -> DataFrame:
    """The second and later rows of a key, in order of uri."""
    nth = F.row_number().over(Window.partitionBy(*by).orderBy("video_uri"))
    code = "duplicate_in_dataset" if len(by) > 1 else "duplicate_video"
    return reject(items.withColumn("nth", nth).where("nth > 1"), "manifest", code, F.concat_ws("/", *by))


def missing_files(items: DataFrame, listing: DataFrame) -> DataFrame:
    """Items whose ``path`` isn't in a listing of files (column ``path``)."""
    there = listing.select(F.regexp_replace("path", "^file:/*", "/").alias("path")).distinct()
    return reject(items.join(there, "path", "left_anti"), "manifest", "missing_file", F.col("path"))


def dataset_problems(items: DataFrame) -> DataFrame:
    """One row if there is no item, or more than one dataset, whose ids it names."""
    ids = items.agg(F.array_sort(F.collect_set("dataset_id")).alias("ids"))
    code = F.when(F.size("ids") == 0, "empty_manifest").when(F.size("ids") > 1, "mixed_datasets")
    return reject(ids.withColumn("code", code).where("code is not null"), "manifest", F.col("code"), F.array_join("ids", ", "), video=F.lit(None))


def unsafe_id(value: Column) -> Column:
    return value.isin("", ".", "..") | value.rlike(r"[/\\]")


def unsafe_ids(items: DataFrame) -> DataFrame:
    """Items with an id that can't be a folder's name."""
    return reject(items.where(unsafe_id(F.col("video_id")) | unsafe_id(F.col("dataset_id"))), "manifest", "unsafe_id", F.concat_ws("/", "dataset_id", "video_id"))


def contract_mismatches(items: DataFrame, contracts: DataFrame) -> DataFrame:
    """Items whose schema or ontology no row of ``contracts`` (``schema_id, ontology_id``) has; the schema is named first."""
    schemas = contracts.select(F.col("schema_id").alias("schema_version"), F.lit(True).alias("has_schema")).distinct()
    ontologies = contracts.select(F.col("schema_id").alias("schema_version"), "ontology_id", F.lit(True).alias("has_ontology")).distinct()
    judged = items.join(schemas, "schema_version", "left").join(ontologies, ["schema_version", "ontology_id"], "left")
    code = F.when(F.col("has_schema").isNull(), "schema_mismatch").when(F.col("has_ontology").isNull(), "ontology_mismatch")
    return reject(judged.withColumn("code", code).where("code is not null"), "manifest", F.col("code"), F.concat_ws("/", "schema_version", "ontology_id"))


def check_manifest(items: DataFrame, contracts: DataFrame, listing: DataFrame | None = None) -> DataFrame:
    """All rejects of a manifest."""
    found = [repeated_items(items), repeated_items(items, ("video_id",)), dataset_problems(items), unsafe_ids(items), contract_mismatches(items, contracts)]
    if listing is not None:
        found.append(missing_files(items, listing))
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out
