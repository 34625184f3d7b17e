"""Exact deduplication by an extendible-hash index on shared files, in DataFrame operations only.

A text's key is a 64-bit hash, and a bucket is a range of keys: all that share their first bits. The directory starts with
one bucket and doubles until every bucket fits; a round splits overfull buckets and leaves the others at their depth. Rows
are then dealt to the owners of their buckets. An owner lays the texts of a key in a chain, each compared byte for byte with
the one before it in order, and so finds equal ones. The index that it writes holds a row's key, place in the chain, and
the id and number of the rows of equal text; results are read from these files.

A key with very many rows is dealt to several owners by salt. Each sends on one row for each text of it, and these few are
chained again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import fitted, shared_path, stored, unused

#: Buckets aimed at for each shuffle partition, so that owners stay even at any size, and rows below which a bucket isn't split.
BUCKETS_A_PARTITION, LEAST_BUCKET = 4, 64
#: The share of a bucket up to which rows of one key stay together.
KEY_SHARE = 4


def _key(text: Column) -> Column:
    return F.xxhash64(text)


def _prefix(bits: Column | int) -> Column:
    """The first bits of the key as a number."""
    return F.expr(f"CASE WHEN {bits} = 0 THEN 0L ELSE shiftrightunsigned(key, 64 - {bits}) END")


def directory(keys: DataFrame, capacity: int) -> tuple[DataFrame, int]:
    """``cell, bucket, depth`` for every cell that holds keys, and the bits of a cell (the global depth).

    ``keys`` has ``key, weight``. A bucket's depth is the least one at which it weighs at most ``capacity`` (or holds a
    single key). The directory doubles as long as one of its last cells is overfull with more than one key: there is no limit to it but the
    bits of a key.
    """
    total = keys.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
    bits = min(64, max(0, (total // capacity).bit_length() + 2))
    while True:
        cells = keys.groupBy(_prefix(bits).alias("cell")).agg(F.sum("weight").alias("weight"), F.count("*").alias("held"))
        cells = stored(cells, "cells")
        if bits == 64 or cells.where(f"weight > {capacity} and held > 1").isEmpty():
            break
        bits = min(64, bits + 2)
    levels = cells.select("cell", "weight", "held", F.explode(F.sequence(F.lit(0), F.lit(bits))).alias("depth"))
    levels = levels.withColumn("bucket", F.expr(f"CASE WHEN depth = 0 THEN 0L ELSE shiftrightunsigned(cell, {bits} - depth) END"))
    sums = levels.groupBy("depth", "bucket").agg(F.sum("weight").alias("weight"), F.sum("held").alias("held"))
    fits = levels.select("cell", "depth", "bucket").join(fitted(sums.where(f"weight <= {capacity} or held = 1").select("depth", "bucket")), ["depth", "bucket"])
    chosen = fits.groupBy("cell").agg(F.min(F.struct("depth", "bucket")).alias("at"))
    return stored(chosen.select("cell", "at.bucket", "at.depth"), "directory"), bits


def _same_as_before(text: str, order: Window) -> Column:
    """Whether a row's text has the bytes of the row before it in the chain."""
    return F.coalesce(F.col(text) == F.lag(text).over(order), F.lit(False))


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text", hashed=_key, capacity: int | None = None) -> DataFrame:
    """The index of ``docs``, from shared files: a row for each of theirs, ``id, key, bucket, depth, chain, keep_id, group_size, sha``.

    ``chain`` tells texts of equal key apart: it numbers them in the order of their bytes. Without a ``capacity``, it
    follows from the number of rows and of shuffle partitions.
    """
    held = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("body")).withColumn("key", hashed(F.col("body")))
    keys = stored(held.groupBy("key").agg(F.count("*").alias("n")), "keys")
    if capacity is None:
        rows = keys.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        capacity = max(LEAST_BUCKET, rows // (BUCKETS_A_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    together = max(1, capacity // KEY_SHARE)
    hot = stored(keys.where(F.col("n") > together).select("key", F.ceil(F.col("n") / together).cast("int").alias("salts")), "hot-keys")
    cells, bits = directory(keys.select("key", F.least(F.col("n"), F.lit(together)).alias("weight")), capacity)
    placed = held.withColumn("row", F.monotonically_increasing_id()).withColumn("cell", _prefix(bits)).join(fitted(cells), "cell").join(fitted(hot), "key", "left")
    salt = F.coalesce(F.pmod(F.xxhash64("row"), F.col("salts")), F.lit(0)).cast("int")
    owned = placed.select("id", "key", "bucket", "depth", "body", F.col("salts").isNotNull().alias("hot"), salt.alias("salt")).repartition("bucket", "salt")
    order = Window.partitionBy("bucket", "salt", "key").orderBy("body")
    same = owned.withColumn("fresh", ~_same_as_before("body", order))
    # of texts dealt by salt the first of each owner goes on to be compared again
    chained = same.withColumn("chain", F.sum(F.col("fresh").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    chained = chained.select("id", "key", "bucket", "depth", "hot", "salt", "chain", F.sha2("body", 256).alias("sha"), F.when(F.col("hot") & F.col("fresh"), F.col("body")).alias("head"))
    equal = Window.partitionBy("bucket", "salt", "key", "chain")
    owners = stored(chained.withColumn("keep_id", F.max("id").over(equal)).withColumn("group_size", F.count("*").over(equal)), "owners")
    heads = owners.where("head is not null").groupBy("bucket", "key", "head", "sha").agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    again = Window.partitionBy("bucket", "key").orderBy("head")
    merged = heads.withColumn("fresh", ~_same_as_before("head", again)).withColumn("chain", F.sum(F.col("fresh").cast("int")).over(again.rowsBetween(Window.unboundedPreceding, 0)))
    merged = stored(merged.select("bucket", "key", "sha", F.struct("chain", "keep_id", "group_size").alias("all")), "hot-chains")
    index = owners.join(fitted(merged), ["bucket", "key", "sha"], "left")
    of = lambda name: F.coalesce(F.col(f"all.{name}"), F.col(name)).alias(name)
    return index.select("id", "key", "bucket", "depth", of("chain"), of("keep_id"), of("group_size"), "sha")


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", hashed=_key, capacity: int | None = None) -> DataFrame:
    """Per row: ``key, keep_id, group_size, kept, text_sha256``.

    Null texts count as empty ones. Of equal texts the row of the largest ``key`` stays; null keys are smaller than any
    other, and stay if the whole group has none else. Rows that repeat both text and the largest key are one document
    written several times: all of them are kept. An empty table gives an empty result; other columns are ignored.
    """
    index = build_index(docs, key, text, hashed, capacity)
    return index.select(F.col("id").alias(key), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256"))


def write_index(docs: DataFrame, path: str | None = None, **parameters) -> DataFrame:
    """:func:`build_index` as files of their own, in order of buckets, for later :func:`look_up`."""
    path = path or shared_path(docs.sparkSession, "index")
    build_index(docs, **parameters).sortWithinPartitions("bucket", "key", "chain").write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def look_up(docs: DataFrame, index: DataFrame, key: str = "doc_id", text: str = "text", hashed=_key) -> DataFrame:
    """``id, keep_id, group_size`` of the rows of ``docs`` whose text the index holds. Texts of one key are told apart by digest."""
    chains = index.where(F.col("id").eqNullSafe(F.col("keep_id"))).select("key", "sha", "keep_id", "group_size").distinct()
    held = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    return held.select("id", hashed(F.col("body")).alias("key"), F.sha2("body", 256).alias("sha")).join(chains, ["key", "sha"]).select("id", "keep_id", "group_size")


def drop_exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`exact_duplicates` keeps, with all their columns, whatever their names.

    Only the ids of rows to drop are joined to the texts: as a broadcast while their measured size allows it. Null and
    empty texts are equal; an empty table stays empty; rows that repeat the id and text that stay are all kept.
    """
    at, sha = unused(docs.columns, "lost_id"), unused(docs.columns, "lost_sha")
    lost = exact_duplicates(docs, key, text).where("not kept").select(F.col(key).alias(at), F.col("text_sha256").alias(sha)).distinct()
    return docs.join(fitted(stored(lost, "lost")), F.col(key).eqNullSafe(F.col(at)) & (F.sha2(F.coalesce(F.col(text), F.lit("")), 256) == F.col(sha)), "left_anti")
