"""Token ids as ORC files.

Rows lie in ascending order of document id: over the files, and within each. Stripes are read in parallel (Spark splits files
at stripes); integer columns are run-length encoded; row indexes and a Bloom filter on the document id let a look-up skip
stripes and row groups.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import SLICE, LibraryBPE, tokenizer, vocabulary
from .text import flat, pieces

#: Options of the ORC writer; characters of text for a file, beyond the least number of files.
STRIPE_BYTES, INDEX_ROWS, BLOOM_FPP = 16 << 20, 1_000, 0.01
FILE_CHARS = 256_000_000


def write_tokens(docs: DataFrame, path: str, vocabulary_path: str, end_id: int, files: int | None = None, key: str = "doc_id", text: str = "text") -> None:
    """Encodes each text, appends ``end_id`` and writes ``key, file, offset, n_tokens, token_ids`` in ascending order of ``key``.

    ``file`` counts the files in that order and ``offset`` the ids in the file before the row; what precedes a file is the
    sum over those before it, so no task sees more than its own rows. Null keys come first; rows of equal key lie in order
    of the text's hash, so that a key with very many rows spans several files. Null texts hold just ``end_id``.
    An empty table gives files without rows; other columns are left out. The number of files follows from the shuffle
    partitions and the length of all texts.
    """
    spark = docs.sparkSession
    held = vocabulary(spark, vocabulary_path)
    if files is None:
        chars = docs.agg(F.coalesce(F.sum(F.length(text)), F.lit(0))).first()[0]
        files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-chars // FILE_CHARS))
    tie = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    ordered = docs.select(key, text).repartitionByRange(files, F.col(key), tie).sortWithinPartitions(F.col(key), tie).withColumn("file", F.spark_partition_id())
    schema = ordered.limit(0).selectExpr(f"`{key}`", "file", "0L offset", "0L n_tokens", "cast(null as array<int>) token_ids").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, before = tokenizer(held.value, LibraryBPE), 0
        for batch in pieces(batches, text, SLICE):
            ids, at = bpe.encode(*flat(batch.column(1)))
            n = np.diff(at) + 1
            ended = np.insert(ids, at[1:], end_id)
            upto = np.concatenate([[0], np.cumsum(n)])
            tokens = pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), pa.array(ended.view(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(before + upto[:-1]), pa.array(n), tokens], names=[key, "file", "offset", "n_tokens", "token_ids"])
            before += int(upto[-1])

    options = {
        "orc.stripe.size": STRIPE_BYTES,
        "orc.create.index": "true",
        "orc.row.index.stride": INDEX_ROWS,
        "orc.bloom.filter.columns": key,
        "orc.bloom.filter.fpp": BLOOM_FPP,
        "compression": "zlib",
    }
    ordered.mapInArrow(run, schema).write.options(**options).orc(path)


def read_tokens(spark, path: str) -> DataFrame:
    """The rows of such files with ``start``: the number of ids of all rows before.

    Of the ids none is read for the files' sums; there is one row a file in the table of what precedes each.
    """
    rows = spark.read.orc(path)
    sums = rows.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    before = sums.select("file", F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return rows.join(F.broadcast(before), "file").withColumn("start", F.col("before") + F.col("offset")).drop("before")


def look_up(spark, path: str, key_value: int, key: str = "doc_id") -> DataFrame:
    """The rows of one document; stripes and row groups whose index or Bloom filter rules it out are not read.

    All rows that repeat the key are returned; a key that isn't there, or a null one, gives an empty result."""
    return spark.read.orc(path).where(F.col(key) == F.lit(key_value))


def check_sums(tokens: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per row of :func:`read_tokens`: ``key, start, n_tokens`` and the CRC-32 of the ids as little-endian 32-bit integers.

    Every row has its end id at least, those of null texts too; null keys and rows that repeat are rows like others; an empty
    table gives an empty result; other columns are ignored."""
    kept = tokens.select(key, "start", "token_ids")
    schema = kept.limit(0).selectExpr(f"`{key}`", "start", "0L n_tokens", "0L ids_crc32").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            offsets = lists.offsets.to_numpy()
            values = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<i4")
            sums = [zlib.crc32(values[a:b]) for a, b in zip(offsets.tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.diff(offsets).astype(np.int64)), pa.array(sums, pa.int64())], names=[key, "start", "n_tokens", "ids_crc32"])

    return kept.mapInArrow(run, schema)
