"""Mixing sources to target weights by weighted sampling without replacement.

A document's key is exponential with its quality weight as rate; the smallest keys come first (Efraimidis and Spirakis). Within
a source, documents in order of their keys are summed up to the source's budget of words. A budget above the source's size takes
whole epochs first, and the order decides only who is in the last, fractional one.

Sums along a source's order are taken in two steps, since one source may hold a third of all rows: over a fixed number of
ranges of the key, then inside the one range where the budget ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import fitted, stored
from .text import SEPARATOR, flat, per_row, pieces, words

#: Ranges of the key in which a source is summed.
RANGES = 1 << 14
#: Weights by rank of the source's name, repeated.
WEIGHTS = (5, 2, 1)
#: All targets together as a share of all sizes; the most that a source or document is taken.
SHARE, MOST = 1.5, 2.0

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``mix_size``, its words ``[^\\x20\\x09-\\x0D]+``, and ``mix_quality``, its share of letters among the bytes of words.

    The weight is at least 0.05, and 1 without words. Null texts have no words. No shuffle.
    """
    schema = docs.drop("mix_size", "mix_quality").limit(0).selectExpr("*", "0L mix_size", "0D mix_quality").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            data, offsets = flat(batch.column(text))
            size = np.diff(words(data, offsets)[2])
            inside, letters = per_row(~SEPARATOR[data], offsets), per_row(_LETTER[data], offsets)
            quality = np.where(inside > 0, np.maximum(0.05, letters / np.maximum(inside, 1)), 1.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(size.astype(np.int64)), pa.array(quality)], names=[*batch.schema.names, "mix_size", "mix_quality"])

    return docs.drop("mix_size", "mix_quality").mapInArrow(run, schema)


def _drawn(key: str, source: str, seed: int) -> tuple[Column, Column, Column]:
    """A row's exponential key, the range it falls in, and the value that breaks ties.

    The uniform number comes from a digest of id, source and seed, so every run draws the same, here and in SQL.
    """
    text = F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string"), F.col(source))
    tie = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")
    uniform = (tie + F.lit(0.5)) / F.lit(float(1 << 52))
    drawn = -F.log(uniform) / F.col("mix_quality")
    return drawn, F.least(F.lit(RANGES - 1), F.floor((1 - F.exp(-drawn)) * RANGES)).cast("int"), tie


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``source, source_size`` with ``target``.

    Sources in order of code points, null last, weigh ``weights`` in turn and share ``share`` of all sizes. A target stops at
    ``most`` times the source's size and the excess goes to the others by weight: all others are then one level times their
    weight. With sources in order of the level at which they stop, it is the words left over by the weight left over at the
    first source that doesn't stop below. One row a source, and their order is global by definition: a sort of names in one task,
    for up to millions of sources, not for a source to each document.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weighed = sizes.withColumn("weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (rank % len(weights) + 1).cast("int")))
    weighed = weighed.withColumn("stop", most * F.col("source_size") / F.col("weight")).withColumn("total", share * F.sum("source_size").over(everything))
    earlier = Window.orderBy("stop", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("total") - F.coalesce(F.sum(most * F.col("source_size")).over(earlier), F.lit(0.0))
    others = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))
    levels = weighed.withColumn("level", left / others)
    level = F.max(F.when(F.col("level") <= F.col("stop"), F.col("level"))).over(everything)  # it falls from there on
    return levels.withColumn("reached", level).select("source", "source_size", F.when(F.col("stop") <= F.col("reached"), most * F.col("source_size")).otherwise(F.coalesce(F.col("reached") * F.col("weight"), most * F.col("source_size"))).alias("target"))


def plan(sized: DataFrame, key: str = "doc_id", source: str = "source", seed: int = 7, **parameters) -> DataFrame:
    """One row a source: ``source, source_size, target, epochs``, and where its fractional epoch ends.

    ``cut_range, cut_key, cut_tie`` belong to the first document that isn't taken whole in it, and ``cut_words`` are the
    words taken of that one, so that a source's words come within one word of its target. Without such a document, they
    are null and the epoch takes nothing (the target is whole epochs).
    """
    drawn, part, tie = _drawn(key, source, seed)
    rows = sized.select(F.col(source).alias("source"), F.col("mix_size").alias("size"), drawn.alias("drawn"), part.alias("part"), tie.alias("tie"))
    parts = stored(rows.groupBy("source", "part").agg(F.sum("size").alias("part_size")), "mix-parts")
    aims = stored(targets(parts.groupBy("source").agg(F.sum("part_size").alias("source_size")), **parameters), "mix-targets")
    taken = F.round("target").cast("long")
    aims = aims.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(taken / F.col("source_size"))).otherwise(0).cast("long"))
    aims = aims.withColumn("budget", taken - F.col("epochs") * F.col("source_size"))
    before = F.coalesce(F.sum("part_size").over(Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    named = aims.select(F.col("source").alias("aim_source"), "budget")
    spans = parts.withColumn("before", before).join(fitted(named), F.col("source").eqNullSafe(F.col("aim_source")))
    edges = spans.where("before <= budget and budget < before + part_size").select("aim_source", F.col("part").alias("cut_range"), (F.col("budget") - F.col("before")).alias("room"))
    close = rows.join(fitted(edges), F.col("source").eqNullSafe(F.col("aim_source")) & (F.col("part") == F.col("cut_range")))
    inside = F.sum("size").over(Window.partitionBy("aim_source").orderBy("drawn", "tie").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    over = close.withColumn("upto", inside).where("upto > room")
    cuts = over.groupBy("aim_source").agg(F.min(F.struct("drawn", "tie", "upto", "room")).alias("cut"), F.min("cut_range").alias("cut_range"))
    # rows of one key and tie are one document written several times; they are cut alike
    alike = over.join(cuts.select(F.col("aim_source").alias("s"), "cut"), F.col("aim_source").eqNullSafe(F.col("s")) & (F.col("drawn") == F.col("cut.drawn")) & (F.col("tie") == F.col("cut.tie")))
    same = alike.groupBy("s").agg(F.sum("size").alias("same_size"))
    cuts = cuts.join(same, F.col("aim_source").eqNullSafe(F.col("s"))).select("aim_source", "cut_range", F.col("cut.drawn").alias("cut_key"), F.col("cut.tie").alias("cut_tie"), ((F.col("cut.room") - F.col("cut.upto") + F.col("same_size")) / F.col("same_size")).alias("cut_share"))
    aims = aims.withColumnRenamed("source", "name")
    return aims.join(cuts, F.col("name").eqNullSafe(F.col("aim_source")), "left").select(F.col("name").alias("mix_source"), "source_size", "target", "epochs", "cut_range", "cut_key", "cut_tie", "cut_share")


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", seed: int = 7, **parameters) -> DataFrame:
    """``docs`` with ``mix_size``, ``source_size``, ``target`` and ``taken``, the words taken of each row, repeats counted.

    A row is taken ``epochs`` times whole; in the fractional epoch it is taken whole if its key comes before its source's cut,
    in part if it is the cut, else not. So words taken come within rounding of the target, and no row exceeds twice its size.
    A null source is a source of its own, last in order. Null texts have size 0 and nothing is taken of them. Rows that
    repeat id and source draw the same key and are taken alike. An empty table gives an empty result. Columns of ``docs``
    stay, unless named like one of the added ones.
    """
    added = ["mix_size", "mix_quality", "source_size", "target", "taken", "mix_source", "epochs", "cut_range", "cut_key", "cut_tie", "cut_share", "mix_drawn", "mix_tie"]
    sized = measured(docs.drop(*added), text)
    cuts = stored(plan(stored(sized.select(key, source, "mix_size", "mix_quality"), "mix-sizes"), key, source, seed, **parameters), "mix-plan")
    drawn, _, tie = _drawn(key, source, seed)
    placed = sized.withColumn("mix_drawn", drawn).withColumn("mix_tie", tie).join(fitted(cuts), F.col(source).eqNullSafe(F.col("mix_source")))
    here, cut = F.struct("mix_drawn", "mix_tie"), F.struct(F.col("cut_key").alias("mix_drawn"), F.col("cut_tie").alias("mix_tie"))
    last = F.when(F.col("cut_key").isNull(), 0).when(here < cut, F.col("mix_size")).when(here == cut, F.floor(F.col("cut_share") * F.col("mix_size") + 1e-6)).otherwise(0)
    taken = (F.col("epochs") * F.col("mix_size") + last).cast("long")
    return placed.withColumn("taken", taken).drop("mix_quality", "mix_source", "epochs", "cut_range", "cut_key", "cut_tie", "cut_share", "mix_drawn", "mix_tie")


def mixture(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", seed: int = 7, **parameters) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with all their columns and values, whatever their names.

    A part counts as one more whole row; rows not taken go, and so do those without words. Null sources, repeated rows and
    empty tables as in :func:`mix`.
    """
    whole = docs.select(F.struct("*").alias("own"), F.col(key).alias("mix_id"), F.col(source).alias("mix_from"), F.col(text).alias("mix_text"))
    mixed = mix(whole, "mix_id", "mix_from", "mix_text", seed, **parameters)
    times = F.ceil(F.col("taken") / F.greatest(F.col("mix_size"), F.lit(1))).cast("int")
    return mixed.where("taken > 0").select("own", F.explode(F.sequence(F.lit(1), times)).alias("copy")).select("own.*")
