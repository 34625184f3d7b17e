"""Token counts of a sentencepiece BPE model, by a two-tier look-up inside the map task.

The model's pieces hold spaces at their start alone, so none spans the border between a character and a space after it: a
text falls into units, a run of spaces and the characters up to the next space, whose token counts add up. Equal units are
found by a dictionary over a slice of text. The first tier is a broadcast table of the counts of frequent units, of fixed size;
the second is a cache in each Python worker, filled by encoding the units that miss. Both only save work: what they hold
never changes a result. No unit is shuffled: for the table each task sends one row, a summary of fixed size.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored
from .text import coded, flat, pieces

#: Units in the broadcast table, units in a task's summary, units counted by a task or cached by a worker at once.
FREQUENT, PROPOSED, HELD = 1 << 16, 1 << 14, 300_000
#: Longest unit, in characters, that the table takes; summaries merged at once; bytes of text looked up at once.
TABLE_CHARS, MERGED, SLICE = 64, 16, 1 << 21

_caches: dict[bytes, UnitCounts] = {}


def separators(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a separator begins, and all bytes of separators: the space, and U+2581, which is how the model writes one."""
    begin = data == 32
    every = begin.copy()
    if len(data) > 2:
        low = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81))
        begin[low] = every[low] = every[low + 1] = every[low + 2] = True
    return begin, every


def unit_codes(column: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
    """Each unit's number, the distinct units, the offsets of rows, and the first units of rows that begin with a separator.

    All units but a row's first begin with a separator, which stands for the space that the model puts before a text.
    """
    data, offsets = flat(column)
    begin, every = separators(data)
    cut = begin.copy()
    cut[1:] &= ~every[:-1]
    codes, strings, rows = coded(data, offsets, cut)
    starts = offsets[:-1][np.diff(offsets) > 0]
    return codes, strings, rows, rows[:-1][np.diff(offsets) > 0][begin[starts]]


def plain(unit: str) -> str:
    """A unit without its first separator."""
    return unit[1:] if unit[0] in " \u2581" else unit


class UnitCounts:
    """Token counts by unit, without the first separator; those that miss are encoded and kept for some time: the cache has two
    generations, and what is found in the older one moves to the younger."""

    def __init__(self, contents: bytes) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_proto=contents)
        self.frequent: dict[str, int] = {}
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def look_up(self, units: list[str]) -> list[int]:
        """Tokens of each unit."""
        if len(self.young) > HELD // 2:
            self.old, self.young = self.young, {}
        missed = {u for u in units if u not in self.frequent and u not in self.young}
        self.young.update((u, self.old[u]) for u in missed if u in self.old)
        fresh = [u for u in missed if u not in self.young]
        if fresh:  # the model puts back the space that was taken, but not before an empty string
            self.young.update((u, len(ids) if u else 1) for u, ids in zip(fresh, self.model.encode(fresh, num_threads=1)))
        return [self.frequent[u] if u in self.frequent else self.young[u] for u in units]

    def of(self, column: pa.Array) -> np.ndarray:
        """Tokens of each text."""
        codes, strings, rows, first = unit_codes(column)
        each = np.array(self.look_up([plain(u) for u in strings]), np.int64)[codes]
        each[first] = self.look_up([strings[k] for k in codes[first].tolist()])
        upto = np.concatenate([[0], np.cumsum(each)])
        return upto[rows[1:]] - upto[rows[:-1]]


def counts(contents: bytes) -> UnitCounts:
    """The worker's cache for these file contents; it stays from task to task."""
    if contents not in _caches:
        _caches.clear()
        _caches[contents] = UnitCounts(contents)
    return _caches[contents]


def _summary(found: Counter[str], number: int) -> pa.RecordBatch:
    best = heapq.nlargest(PROPOSED, found.items(), key=lambda x: (x[1], x[0]))
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([[u for u, _ in best]], pa.list_(pa.string())), pa.array([[n for _, n in best]], pa.list_(pa.int64()))], names=["task", "units", "n"])


def frequent_units(docs: DataFrame, text: str = "text") -> list[str]:
    """The most frequent units over all texts, at most ``FREQUENT``.

    Each task counts the units of all its texts and sends one row, its most frequent ones. Such rows are merged sixteen at a
    time, again and again, so that neither a task nor the driver ever holds more than sixteen.
    """
    schema = "task long, units array<string>, n array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()
        for batch in pieces(batches, text, SLICE):
            codes, strings, _, _ = unit_codes(batch.column(0))
            for unit, n in zip(strings, np.bincount(codes, minlength=len(strings)).tolist()):
                if len(unit) <= TABLE_CHARS:
                    found[plain(unit)] += n
            if len(found) > HELD:
                found = Counter(dict(heapq.nlargest(HELD // 2, found.items(), key=lambda x: x[1])))
        yield _summary(found, TaskContext.get().partitionId())

    def added(batches: Iterator[pa.RecordBatch]) -> Counter[str]:
        total: Counter[str] = Counter()
        for batch in batches:
            for units, n in zip(batch.column("units").to_pylist(), batch.column("n").to_pylist()):
                for unit, k in zip(units, n):
                    total[unit] += k
        return total

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = list(batches)
        yield _summary(added(batches), batches[0].column("task")[0].as_py() // MERGED)

    summaries = stored(docs.select(text).mapInArrow(run, schema), "unit-summaries")
    while (most := summaries.agg(F.coalesce(F.max("task"), F.lit(0))).first()[0]) >= MERGED:
        summaries = stored(summaries.groupBy(F.expr(f"task div {MERGED}")).applyInArrow(lambda table: pa.Table.from_batches(list(merged(table.to_batches()))), schema), "unit-summaries")
    best = heapq.nlargest(FREQUENT, added(summaries.toArrow().to_batches()).items(), key=lambda x: (x[1], x[0]))
    return [u for u, _ in best]


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key, n_bytes, n_tokens, over_limit``, without begin and end tokens.

    A null or empty text has no bytes and no tokens. Repeated rows and null ids are rows like others; an empty table gives an
    empty result; other columns are ignored. Texts are counted whole, whatever their length.
    """
    spark = docs.sparkSession
    contents = Path(model_path).read_bytes()
    model = UnitCounts(contents)
    best = frequent_units(docs, text)
    held = spark.sparkContext.broadcast((contents, dict(zip(best, model.look_up(best)))))
    kept = docs.select(key, text)
    schema = kept.limit(0).selectExpr(f"`{key}`", "0L n_bytes", "0L n_tokens", "true over_limit").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contents, frequent = held.value
        known = counts(contents)
        known.frequent = frequent
        for batch in pieces(batches, text, SLICE):
            n = known.of(batch.column(1))
            size = np.diff(flat(batch.column(1))[1])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size), pa.array(n), pa.array(n > limit)], names=[key, "n_bytes", "n_tokens", "over_limit"])

    return kept.mapInArrow(run, schema)
