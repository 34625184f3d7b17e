"""Stupid-backoff scores of all documents under counts of all documents, as joins by n-gram.

``score_whole`` counts every trigram and its context, over all words. Since the texts scored are the texts counted, each trigram has
been seen, so the back-off is never taken and the score is a sum of log counts of trigrams less one of contexts: both are dealt by
their own hash, and no table of words is broadcast.

N-grams are exploded from every text and dealt by their hash. A partition holds the count table of its n-grams and all
their occurrences, joins the two, and sends on the sums of the documents it met; those are added up by document. Occurrences
and sums travel packed: a row holds what one block of documents and one partition have in common. Documents are numbered within
their block; their ids and numbers of words travel once, with the first row of the block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import flat, hashes, mixed, pieces, words

#: Twice the words of a block of packed n-grams; hash partitions for each shuffle partition.
HELD, FINER = 1_200_000, 2
#: Sums travel as integers of this many steps per nat, so that their order doesn't matter.
STEPS = 1 << 20
#: Characters of text for a hash partition of ``score_whole``, beyond the least number of partitions.
PART_CHARS = 32_000_000


def narrow(x: np.ndarray) -> bytes:
    """Integers from 0 on, in as few bytes each as the largest takes."""
    return x.astype(np.min_scalar_type(int(x.max(initial=0)))).tobytes()


def widened(data: bytes, n: int) -> np.ndarray:
    """The ``n`` integers of :func:`narrow`."""
    return np.frombuffer(data, f"<u{max(1, len(data) // max(1, n))}").astype(np.int64)


def document_sums(partial: DataFrame) -> DataFrame:
    """``rid, score, n``: each block's documents with their sums over all partitions. A group has the parts of one block, which is bounded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [x for b in batches for x in zip(*(c.to_pylist() for c in b.columns[1:]))]
        ids, n = next((np.frombuffer(i, "<i8"), w) for *_, i, w in rows if i is not None)
        total = np.zeros(len(ids) + 1, np.int64)  # the last one is no document's: ends of texts
        for n_docs, gaps, score, _, _ in rows:
            total[np.cumsum(widened(gaps, n_docs))] += np.frombuffer(score, f"<i{len(score) // n_docs}")
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[:-1]), pa.array(widened(n, len(ids)))], names=["rid", "score", "n"])

    return partial.groupBy("block").applyInArrow(run, "rid long, score long, n long")


def _by_document(rows: DataFrame, sums: DataFrame, key: str) -> DataFrame:
    """``key, n_words, log_score, mean_log_score`` of all ``rows`` from the ``sums`` by ``rid``."""
    times = rows.groupBy("rid", "id").agg(F.count("*").alias("times"))
    out = times.join(sums, "rid", "left").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    n, total = F.coalesce(F.col("n") / F.col("times"), F.lit(0)), F.coalesce(F.col("score") / F.col("times"), F.lit(0))
    return out.select(F.col("id").alias(key), n.cast("long").alias("n_words"), (total / STEPS).alias("log_score"), F.when(F.col("n") > 0, F.col("score") / F.col("n") / STEPS).alias("mean_log_score"))


def _distinct(x: np.ndarray) -> np.ndarray:
    """Where a sorted array has a value for the first time."""
    fresh = np.ones(len(x), bool)
    fresh[1:] = x[1:] != x[:-1]
    return fresh


def part_begin(part: int, parts: int) -> int:
    """The least hash of a partition."""
    return -(-(part << 32) // parts) << 32


def stepped(x: np.ndarray, begin: int) -> bytes:
    """Sorted 64-bit hashes as steps from ``begin`` on: their width, then all first bytes, all second bytes and so on, as few as the largest takes."""
    step = np.diff(x, prepend=np.uint64(begin))
    width = max(1, (int(step.max()).bit_length() + 7) // 8)
    return bytes([width]) + step.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def summed(data: bytes, begin: int) -> np.ndarray:
    """The hashes of :func:`stepped`."""
    few = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], -1).T
    step = np.zeros((len(few), 8), np.uint8)
    step[:, : data[0]] = few
    return np.cumsum(step.view("<u8").ravel(), dtype=np.uint64) + np.uint64(begin)


def packed_trigrams(rows: DataFrame, parts: int) -> DataFrame:
    """A row for each block of texts and hash partition: 63-bit hashes of the trigrams (odd) and of their contexts (even), before a
    text two begin symbols, with their documents and how often each holds them. The bigram that ends a text counts as a context too; it belongs to no document, but to the number after the last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, docs, ends_, rids, n = [], [], [], [], 0
        number = TaskContext.get().partitionId() << 24
        one = np.uint64(1)

        def block() -> pa.RecordBatch:
            nonlocal number
            number += 1
            every, last, who = np.concatenate(rids), np.concatenate(ends_), np.concatenate(docs)
            gram = np.concatenate([*(x[0] for x in grams), *(x[1] for x in grams), last])
            doc = np.concatenate([who, who, np.full(len(last), len(every), np.int32)])
            order = np.argsort(gram, kind="stable")  # documents ascend within each kind
            gram, doc = gram[order], doc[order]
            at = np.flatnonzero(_distinct(gram) | _distinct(doc))
            times = np.diff(np.append(at, len(gram)))
            gram, doc = gram[at], doc[at]
            cuts = np.searchsorted(((gram >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32), np.arange(parts + 1, dtype=np.uint64))
            head = every.astype("<i8").tobytes(), narrow(np.bincount(who, minlength=len(every)))
            out: list[list] = [[] for _ in range(8)]
            for p in np.flatnonzero(np.diff(cuts)).tolist():
                a, b = cuts[p], cuts[p + 1]
                first = np.flatnonzero(_distinct(gram[a:b]))
                values = (p, number, stepped(gram[a:b][first], part_begin(p, parts)), narrow(np.diff(np.append(first, b - a))), narrow(doc[a:b]), narrow(times[a:b]), *head)
                head = None, None
                for column, value in zip(out, values):
                    column.append(value)
            return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.int64()), *(pa.array(x, pa.binary()) for x in out[2:])], names=["part", "block", "gram", "held", "doc", "times", "ids", "words"])

        seen = 0
        for batch in pieces(batches, "body"):
            starts, ends, of = words(*(found := flat(batch.column(1))))
            now = hashes(found[0], starts, ends)
            begins, stops = of[:-1][of[:-1] < of[1:]], of[1:][of[:-1] < of[1:]]
            before = np.empty((2, len(now)), np.uint64)
            before[0, 1:], before[1, 2:] = now[:-1], now[:-2]
            before[:, begins] = 0
            before[1, (begins + 1)[begins + 1 < stops]] = 0
            pair = lambda x, y: mixed(mixed(x + np.uint64(0x9E3779B97F4A7C15)) + y)
            context = pair(before[1], before[0])
            grams.append((mixed(mixed(context) + now) | one, context & ~one))
            ends_.append(pair(before[0][stops - 1], now[stops - 1]) & ~one)
            docs.append(seen + np.repeat(np.arange(batch.num_rows, dtype=np.int32), np.diff(of)))
            rids.append(batch.column(0).to_numpy())
            seen, n = seen + batch.num_rows, n + len(now)
            if n > HELD // 2:
                yield block()
                grams, docs, ends_, rids, n, seen = [], [], [], [], 0, 0
        if n:
            yield block()

    return rows.mapInArrow(run, "part int, block long, gram binary, held binary, doc binary, times binary, ids binary, words binary")


def partial_log_counts(packed: DataFrame, parts: int) -> DataFrame:
    """A row for each block and partition: its documents' sums of the log counts of trigrams less those of contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = []
        for row in (dict(zip(b.schema.names, x)) for b in batches for x in zip(*(c.to_pylist() for c in b.columns))):
            gram = summed(row["gram"], part_begin(row["part"], parts))
            blocks.append((gram, widened(row["held"], len(gram)), row["doc"], row["times"], (row["block"], row["ids"], row["words"])))
        counts = np.concatenate([np.add.reduceat(widened(times, held.sum()), np.concatenate([[0], np.cumsum(held)[:-1]])) for _, held, _, times, _ in blocks])
        table, place = np.unique(np.concatenate([x[0] for x in blocks]), return_inverse=True)
        steps = np.rint(np.log(np.bincount(place, counts)) * STEPS) * np.where(table & np.uint64(1), 1, -1)
        del counts, place
        for gram, held, doc, times, (block, ids, n_words) in blocks:
            doc, times = widened(doc, held.sum()), widened(times, held.sum())
            who, place = np.unique(doc, return_inverse=True)
            score = np.bincount(place, np.repeat(steps[np.searchsorted(table, gram)], held) * times)
            values = narrow(np.diff(who, prepend=0)), score.astype("<i4" if np.abs(score).max() < 1 << 31 else "<i8").tobytes(), ids, n_words
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([len(who)], pa.int32()), *(pa.array([x], pa.binary()) for x in values)], names=["block", "docs", "gaps", "score", "ids", "words"])

    return packed.groupBy("part").applyInArrow(run, "block long, docs int, gaps binary, score binary, ids binary, words binary")


def score_whole(docs: DataFrame, key: str = "doc_id", text: str = "text", parts: int | None = None) -> DataFrame:
    """Per row: ``key, n_words, log_score, mean_log_score``, natural logs: ``log(count(a b c) / count(a b))`` over all words and
    trigrams of the corpus, the first two words after begin symbols.

    Texts without words (null and empty ones) have 0, 0 and null. Repeated rows and null ids are scored like others and count like
    others; an empty table gives an empty result; other columns are ignored.
    """
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("body")).withColumn("rid", F.xxhash64("id", "body"))
    if parts is None:
        chars = rows.agg(F.coalesce(F.sum(F.length("body")), F.lit(0))).first()[0]
        parts = max(FINER * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-chars // PART_CHARS))
    sums = document_sums(partial_log_counts(packed_trigrams(rows.select("rid", "body"), parts), parts))
    return _by_document(rows, sums.groupBy("rid").agg(F.sum("score").alias("score"), F.sum("n").alias("n")), key)
