"""Phrases whose words go together more often than chance would have it.

Every run of words gets a Rabin-Karp fingerprint from prefix polynomials: a polynomial over a word's bytes, and another one over
the words' hashes, so a run of any length is the difference of two prefixes. Runs are counted by fingerprint alone; what
occurs often enough is known then, and only such phrases are ever written out as text. That pass keeps for each fingerprint
a pointer to its first occurrence in the slice, compares all others with the text there, and counts by text, so phrases
whose fingerprints are equal come apart again.

A phrase can't be more frequent than the phrases inside it. So pairs are counted where both words are frequent, and longer runs
where all their pairs are. What is frequent travels as a bitmap of bounded size: a bit too many costs a count, never a result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored
from .text import LOWER, _powers_of, coded, flat, hashes, mixed

#: Most words of a phrase; bytes of text worked on at once; least and most bits of a bitmap (16 MB), and bits for each entry.
LONGEST, SLICE = 5, 2 << 20
LEAST_BITS, MOST_BITS, BITS_EACH = 1 << 15, 1 << 27, 32
NO_LANG = "und"
#: Parts of a language that are ranked by themselves first.
PARTS = 64

_BREAK = np.zeros(256, bool)
_BREAK[[10, 11, 12, 13, *b".,;:!?"]] = True
_WORD = ~_BREAK
_WORD[[9, 32]] = False
_FACTOR = np.uint64(0xD6E8FEB86659FD93)
_BACK = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))


class Runs:
    """Words of a block of texts and the fingerprints of runs of them. ``langs`` has a hash for each row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: np.ndarray) -> None:
        self.data, self.offsets = LOWER[data], offsets
        word = _WORD[data]
        mark = _BREAK[data]
        first = offsets[:-1][offsets[:-1] < offsets[1:]]
        mark[first] = True  # a row begins a piece
        before = np.zeros(len(data), bool)
        before[1:] = word[:-1]
        before[first] = False
        self.starts = np.flatnonzero(word & ~before)
        after = np.zeros(len(data), bool)
        after[:-1] = word[1:]
        after[first[first > 0] - 1] = False
        self.ends = np.flatnonzero(word & ~after) + 1
        piece = np.cumsum(mark, dtype=np.int32)[self.starts]
        #: Whether a word and the next are in one piece.
        self.joined = piece[1:] == piece[:-1]
        self.row = np.searchsorted(offsets, self.starts, "right") - 1
        self.lang = langs[self.row]
        words = hashes(self.data, self.starts, self.ends)
        n = len(words)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(words * _powers_of(_FACTOR, n + 1)[:n], out=self.prefix[1:])
        self.back = _powers_of(_BACK, n + 1)

    def all_of(self, flags: np.ndarray, size: int) -> np.ndarray:
        """Where ``size`` neighbouring flags are all true."""
        out = flags
        for k in range(1, size):
            out = out[:-1] & flags[k:]
        return out

    def fingerprints(self, at: np.ndarray, size: int) -> np.ndarray:
        """Of the runs of ``size`` words that begin at the words ``at``."""
        return mixed((self.prefix[at + size] - self.prefix[at]) * self.back[at] + self.lang[at] + np.uint64(size))

    def inside(self, size: int) -> np.ndarray:
        """Words at which a run of ``size`` words within one piece begins."""
        if len(self.starts) < size:
            return np.zeros(0, np.int64)
        return np.arange(len(self.starts)) if size == 1 else np.flatnonzero(self.all_of(self.joined, size - 1))


def blocks(column: pa.Array, langs: pa.Array, limit: int = SLICE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes, offsets, hashes of languages and numbers of rows, of about ``limit`` bytes each. Texts beyond that are parted where a piece ends."""
    data, offsets = flat(column)
    names, name_offsets = flat(langs)
    hashed = hashes(names, name_offsets[:-1], name_offsets[1:])
    cuts, rows = [np.zeros(0, np.int64)], []
    for i in np.flatnonzero(np.diff(offsets) > limit).tolist():
        ends = offsets[i] + np.flatnonzero(_BREAK[data[offsets[i] : offsets[i + 1]]])
        wanted = np.arange(offsets[i] + limit, offsets[i + 1], limit)
        found = np.searchsorted(ends, wanted)
        cuts.append(ends[np.unique(found[found < len(ends)])] + 1)
    every = np.unique(np.concatenate([offsets, *cuts]))
    rows = np.searchsorted(offsets, every[:-1], "right") - 1
    group = every[:-1] // limit
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(every) - 1]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield data[every[a] : every[b]], every[a : b + 1] - every[a], hashed[rows[a:b]], rows[a:b]


def _held(bits: np.ndarray, prints: np.ndarray) -> np.ndarray:
    at = prints & np.uint64(len(bits) * 8 - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _candidates(runs: Runs, sizes: tuple[int, ...], bits: np.ndarray | None) -> Iterator[np.ndarray]:
    """Fingerprints of the runs of these sizes all of whose parts may be frequent: words for pairs, pairs for longer runs."""
    part = max(1, sizes[0] - 1)
    if bits is None:
        at = runs.inside(1)
        if len(at):
            yield runs.fingerprints(at, 1)
        return
    ok = np.zeros(max(0, len(runs.starts) - part + 1), bool)
    at = runs.inside(part)
    ok[at] = _held(bits, runs.fingerprints(at, part))
    for size in sizes:
        at = runs.inside(size)
        if len(at):
            at = at[runs.all_of(ok, size - part + 1)[at]]
        if len(at):
            yield runs.fingerprints(at, size)


def _texts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"), F.coalesce(F.col(lang), F.lit(NO_LANG)).alias("lang"))


def frequent_prints(texts: DataFrame, sizes: tuple[int, ...], least: int, bits) -> DataFrame:
    """``print, n`` of runs of these sizes that occur ``least`` times or more, by fingerprint. Slices are counted in the task, and
    Spark adds up within the task before it shuffles, so a frequent run is one row a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if bits is None else bits.value
        for batch in batches:
            for data, offsets, langs, _ in blocks(batch.column(0), batch.column(1)):
                found = list(_candidates(Runs(data, offsets, langs), sizes, known))
                if found:
                    prints, n = np.unique(np.concatenate(found), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(prints.view(np.int64)), pa.array(n.astype(np.int64))], names=["print", "n"])
        pa.default_memory_pool().release_unused()

    return texts.mapInArrow(run, "print long, n long").groupBy("print").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def bitmap(prints: DataFrame):
    """A broadcast bitmap of fingerprints. Its size follows their number up to a bound; beyond it more bits are set, and more is counted than need be."""
    n = prints.count()
    size = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_EACH * max(1, n)).bit_length()))
    place = F.col("print").bitwiseAND(F.lit(size - 1)) + 1
    parts = prints.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit")).groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
    out = np.zeros(size // 8, np.uint8)
    for row in parts.toLocalIterator():  # at most MOST_BITS in all
        at = (row.bucket - 1) * 4096
        out[at : at + 4096] = np.frombuffer(bytes(row.bits), np.uint8)
    return prints.sparkSession.sparkContext.broadcast(out)


def block_phrases(runs: Runs, known: np.ndarray) -> Iterator[tuple[int, list[int], list[str], np.ndarray]]:
    """``size, first words, texts, counts`` of the runs in a block whose fingerprints are in the bitmap.

    Runs with one fingerprint are compared word by word with the first of them, to which it points; what differs from it is counted by itself.
    """
    cut = np.zeros(len(runs.data) + 1, bool)
    cut[0] = cut[runs.starts] = cut[runs.ends] = True
    codes, parts, _ = coded(runs.data, np.array([0, len(runs.data)]), cut[:-1])
    word = codes[np.cumsum(cut)[runs.starts] - 1]  # numbers of words by their text
    for size in range(1, LONGEST + 1):
        at = runs.inside(size)
        prints = runs.fingerprints(at, size)
        held = _held(known, prints)
        at, prints = at[held], prints[held]
        while len(at):
            _, pointer, each = np.unique(prints, return_index=True, return_inverse=True)
            first = at[pointer][each]
            same = runs.lang[at] == runs.lang[first]
            for k in range(size):
                same &= word[at + k] == word[first + k]
            begin = at[pointer].tolist()
            yield size, begin, [" ".join([parts[word[i + k]] for k in range(size)]) for i in begin], np.bincount(each[same], minlength=len(pointer))
            at, prints = at[~same], prints[~same]


def phrase_counts(texts: DataFrame, bits) -> DataFrame:
    """``lang, size, phrase, n`` of the phrases whose fingerprints are in the bitmap, and rows of size 0 with the number of all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = bits.value
        for batch in batches:
            names = batch.column(1)
            for data, offsets, langs, rows in blocks(batch.column(0), names):
                runs = Runs(data, offsets, langs)
                if not len(runs.starts):
                    continue
                _, pointer, n = np.unique(runs.lang, return_index=True, return_counts=True)
                out = [(0, pointer.tolist(), [None] * len(n), n), *block_phrases(runs, known)]
                at = np.concatenate([np.array(x[1], np.int64) for x in out])
                sizes = np.repeat([x[0] for x in out], [len(x[1]) for x in out])
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(rows[runs.row[at]])), pa.array(sizes.astype(np.int32)), pa.array([p for x in out for p in x[2]], pa.string()), pa.array(np.concatenate([x[3] for x in out]).astype(np.int64))],
                    names=["lang", "size", "phrase", "n"],
                )
        pa.default_memory_pool().release_unused()

    return texts.mapInArrow(run, "lang string, size int, phrase string, n long").groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))


def scored_phrases(counts: DataFrame, least: int) -> DataFrame:
    """``lang, phrase, a, l, r, n, score`` of phrases of two words or more that no longer one with as many occurrences holds.

    The score is that of the weakest cut of a phrase in two, on a tie after the fewest words; arithmetic is in decimals of 38 digits.
    """
    words = F.split("phrase", " ")
    totals = counts.where("size = 0").select("lang", F.col("n").alias("all_n"))
    known = counts.where((F.col("size") > 0) & (F.col("n") >= least))
    phrases = known.where("size > 1")
    join = lambda a, n: F.array_join(F.slice("w", a, n), " ")
    cut = phrases.select("lang", "phrase", "size", F.col("n").alias("a"), words.alias("w")).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cut = cut.select("lang", "phrase", "a", "k", join(F.lit(1), F.col("k")).alias("head"), join(F.col("k") + 1, F.col("size") - F.col("k")).alias("tail"))
    part = known.select("lang", F.col("phrase"), F.col("n"))
    cut = cut.join(part.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l")), ["lang", "head"]).join(part.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r")), ["lang", "tail"])
    cut = cut.join(F.broadcast(totals), "lang")  # a row a language
    score = F.expr("cast(cast(cast(1000 as decimal(38,0)) * cast(a as decimal(38,0)) * cast(all_n as decimal(38,0)) as decimal(38,0)) div cast(cast(l as decimal(38,0)) * cast(r as decimal(38,0)) as decimal(38,0)) as long)")
    best = cut.withColumn("score", score).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a", "all_n")).alias("b"))
    # every part of a phrase of two words or more, with the phrase's own count
    inner = phrases.where("size > 2").select("lang", "n", "size", words.alias("w")).withColumn("m", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    inner = inner.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1))).select("lang", join(F.col("at"), F.col("m")).alias("phrase"), "n")
    longer = inner.groupBy("lang", "phrase").agg(F.max("n").alias("longest"))
    found = best.join(longer, ["lang", "phrase"], "left").where(F.col("longest").isNull() | (100 * F.col("longest") < 100 * F.col("b.a")))
    return found.select("lang", "phrase", "b.a", "b.l", "b.r", F.col("b.all_n").alias("n"), "b.score")


def top_phrases(docs: DataFrame, least: int = 100, top: int = 2000, text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's best ``top`` phrases of 2 to 5 words.

    Null and empty texts hold no words; a null language is ``und``; repeated rows count each; ties of scores go by count and then by the
    phrase's bytes; an empty table gives an empty result; other columns are ignored. A text of any length is worked on
    in slices that end where a piece does (a single piece beyond that is one slice).
    """
    texts = _texts(docs, text, lang)
    single = stored(frequent_prints(texts, (1,), least, None), "words")
    pairs = stored(frequent_prints(texts, (2,), least, bitmap(single)), "pairs")
    longer = stored(frequent_prints(texts, tuple(range(3, LONGEST + 1)), least, bitmap(pairs)), "longer")
    counts = phrase_counts(texts, bitmap(single.union(pairs).union(longer)))
    counts = stored(counts.where((F.col("size") == 0) | (F.col("n") >= least)), "phrases")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # the best of each part of a language first, so that its last task has at most ``top`` of each part
    salted = scored_phrases(counts, least).withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    best = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
