"""Best-fit packing of token sequences, in bulk-synchronous supersteps.

Pieces are range-sorted by falling length, and each gets its rank among those of its length: the ranges' counts say what lies before each range.
Gaps of open sequences are kept in runs: so many sequences, numbered in a row, with the same room left. A superstep places all pieces of one length. They all want the
same gaps, the successors of their length among the gaps there are; the conflict is resolved by rank, the lowest rank getting the first gap of
the nearest run, and a sequence takes as many of them as fit. The run's gap is updated in one go, and the sweep goes on to the next successor; when no gap
is left that is wide enough, new sequences are opened. The next superstep has the next shorter length.

There are no more lengths and gaps than tokens in a sequence, so the steps work on tables that this bounds, whatever the
corpus; what each piece gets of them follows from its length and rank by a join with the table of steps. The result is that
of best fit one by one over falling lengths.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import SLICE, LibraryBPE, tokenizer, vocabulary
from .shared import stored
from .text import flat, pieces

#: Tokens of a sequence.
CAPACITY = 2048


def token_pieces(docs: DataFrame, vocabulary_path: str, end_id: int, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, piece, start, length, ids_crc32`` of each text's ids with ``end_id`` after them, cut from the end into pieces of ``capacity``.

    The first piece has what is left over. Ids stay in the worker; null and empty texts are a piece with just the end id.
    """
    held = vocabulary(docs.sparkSession, vocabulary_path)
    kept = docs.select(key, text)
    schema = kept.limit(0).selectExpr(f"`{key}`", "0 piece", "0L start", "0L length", "0L ids_crc32").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(held.value, LibraryBPE)
        for batch in pieces(batches, text, SLICE):
            ids, at = bpe.encode(*flat(batch.column(1)))
            ended = np.ascontiguousarray(np.insert(ids, at[1:], end_id), "<u4")
            size = np.diff(at) + 1
            n = -(-size // capacity)
            row = np.repeat(np.arange(len(size)), n)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            first = (size - (n - 1) * capacity)[row]
            start = np.where(piece == 0, 0, first + (piece - 1) * capacity)
            length = np.where(piece == 0, first, capacity)
            begin = (np.cumsum(size) - size)[row] + start
            sums = [zlib.crc32(ended[a:b]) for a, b in zip(begin.tolist(), (begin + length).tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(sums, pa.int64())], names=[key, "piece", "start", "length", "ids_crc32"])

    return kept.mapInArrow(run, schema)


def ranked(rows: DataFrame, tie: list[str], length: str = "length") -> DataFrame:
    """``rows`` with ``nth``, their number from 0 among those of equal length in order of ``tie``.

    By ranges of length and tie, so a length that most rows have is spread over many tasks; what precedes a range comes from one row a range and length.
    """
    order = [F.desc(length), *tie]
    place = F.monotonically_increasing_id()
    placed = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("range", F.shiftright(place, 33)).withColumn("at", place.bitwiseAND(F.lit((1 << 33) - 1))), "ranges")
    sizes = placed.groupBy("range", length).agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(length).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # at most a row for each range and one for each length
    shift = sizes.select("range", length, (before - F.col("first")).alias("shift"))
    return placed.join(F.broadcast(shift), ["range", length]).withColumn("nth", F.col("at") + F.col("shift")).drop("range", "at", "shift")


def steps(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """``length, first, n, each, sequence, offset``: the ``n`` pieces of a length from rank ``first`` on lie ``each`` to a sequence, in sequences from
    ``sequence`` on, from ``offset`` on. ``counts`` has the number of pieces of each length."""
    out, opened = [], 0
    gaps: list[deque[tuple[int, int]]] = [deque() for _ in range(capacity + 1)]  # runs (first sequence, number) by gap
    there = np.zeros(capacity + 1, bool)

    def leave(gap: int, sequence: int, n: int, front: bool = False) -> None:
        if n and gap:
            (gaps[gap].appendleft if front else gaps[gap].append)((sequence, n))
            there[gap] = True

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            near = int(there[length:].argmax())  # the successor among gaps
            if there[length + near]:
                gap = length + near
                sequence, n = gaps[gap].popleft()
                there[gap] = bool(gaps[gap])
            else:
                gap, sequence, n = capacity, opened, -(-left // (capacity // length))
                opened += n
            each = gap // length
            whole = min(n, left // each)
            if whole:
                out.append((length, rank, whole * each, each, sequence, capacity - gap))
                leave(gap - each * length, sequence, whole)
                rank, left = rank + whole * each, left - whole * each
            if left and whole < n:  # fewer than would fill the next sequence
                out.append((length, rank, left, left, sequence + whole, capacity - gap))
                leave(gap - left * length, sequence + whole, 1)
                whole, left = whole + 1, 0
            leave(gap, sequence + whole, n - whole, front=True)
    return out


def packed(rows: DataFrame, tie: list[str], capacity: int = CAPACITY) -> DataFrame:
    """``rows`` (with ``length``, 1 to ``capacity``) with ``sequence_id`` and ``offset``: their place in as few sequences as best fit by falling length needs.

    Sequences have no gaps. The same rows get the same places in every run; of rows that are equal in ``tie`` any may have either's place.
    An empty table gives an empty result.
    """
    spark = rows.sparkSession
    placed = stored(ranked(rows, tie), "ranked")
    counts = {r.length: r.n for r in placed.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most one for each length
    plan = spark.createDataFrame(steps(counts, capacity), "length long, first long, n long, each long, sequence long, base long")
    inside = F.col("nth") - F.col("first")
    # the steps are bounded by the capacity, not by the rows
    found = placed.join(F.broadcast(plan), "length").where((F.col("nth") >= F.col("first")) & (F.col("nth") < F.col("first") + F.col("n")))
    return found.select(*rows.columns, (F.col("sequence") + F.floor(inside / F.col("each"))).cast("long").alias("sequence_id"), (F.col("base") + inside % F.col("each") * F.col("length")).cast("long").alias("offset"))


def pack_documents(docs: DataFrame, vocabulary_path: str, end_id: int, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, piece, start, length, ids_crc32, sequence_id, offset``: whole texts as token pieces, packed.

    Null and empty texts are one token; repeated rows, null keys included, are packed each; a text beyond ``capacity`` is parted into pieces
    that are packed by themselves; an empty table gives an empty result; other columns are ignored.
    """
    made = stored(token_pieces(docs, vocabulary_path, end_id, capacity, key, text), "pieces")
    return packed(made, [key, "piece", "ids_crc32"], capacity)
