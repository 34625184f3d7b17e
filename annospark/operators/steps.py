"""Counters, gauges and histograms on a grid of steps, each looking back over a range of time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .serving import histogram_quantile

_MICROS = 1_000_000


def _usable(samples: DataFrame, ts: str, value: str) -> DataFrame:
    return samples.where(F.col(ts).isNotNull() & F.col(value).isNotNull())


def _at_or_after(at: Column, step: int) -> Column:
    """The first step at or after a time, in microseconds."""
    return at + F.pmod(-at, F.lit(step))


def _before(at: Column, step: int) -> Column:
    """The last step before a time, in microseconds."""
    return at - 1 - F.pmod(at - 1, F.lit(step))


def with_previous(samples: DataFrame, series: list[str], slab_s: int, value: str = "value", ts: str = "ts") -> DataFrame:
    """``samples`` with ``before_ts, before_value``, the sample before in the series (null for its first).

    Time is parted into slabs of ``slab_s`` seconds that are sorted by themselves. The last sample of each slab goes along to the next slab that has any,
    so a series of any length is spread over tasks; what is put in order for a whole series is one row a slab. Samples
    of one time are in order of value; those without a time or a value are left out.
    """
    rows = _usable(samples, ts, value).withColumn("slab", F.floor(F.unix_micros(ts) / (slab_s * _MICROS))).withColumn("carried", F.lit(False))
    last = rows.groupBy(*series, "slab").agg(F.max(F.struct(ts, value)).alias("last"))
    following = F.lead("slab").over(Window.partitionBy(*series).orderBy("slab"))
    carried = last.withColumn("slab", following).where("slab is not null").select(*series, "slab", F.col("last")[ts].alias(ts), F.col("last")[value].alias(value), F.lit(True).alias("carried"))
    order = Window.partitionBy(*series, "slab").orderBy(ts, value)
    both = rows.unionByName(carried, allowMissingColumns=True)
    return both.withColumn("before_ts", F.lag(ts).over(order)).withColumn("before_value", F.lag(value).over(order)).where(~F.col("carried")).drop("slab", "carried")


def _gain(now: Column, before: Column) -> Column:
    """What a counter gained since the sample before; one that fell has begun anew from 0."""
    return F.when(now < before, now).otherwise(now - before)


def _dealt(pairs: DataFrame, by: list[str], gains: dict[str, Column], step_s: int, range_s: int, ts: str) -> DataFrame:
    """``by, at`` and ``gains`` added up: those of samples (with ``before_ts``) that lie with the one before in the range up to the step ``at`` (microseconds)."""
    step = step_s * _MICROS
    spans = pairs.select(*by, _at_or_after(F.unix_micros(ts), step).alias("low"), _before(F.unix_micros("before_ts") + range_s * _MICROS, step).alias("high"), *(g.cast("double").alias(n) for n, g in gains.items()))
    sums = [F.sum(n).alias(n) for n in gains]
    spans = spans.where("low <= high").groupBy(*by, "low", "high").agg(*sums)
    return spans.select(*by, *gains, F.explode(F.sequence("low", "high", F.lit(step).cast("bigint"))).alias("at")).groupBy(*by, "at").agg(*sums)


def counter_steps(samples: DataFrame, series: list[str], step_s: int, range_s: int, slab_s: int = 86_400, value: str = "value", ts: str = "ts") -> DataFrame:
    """``series, step, increase, rate`` of counters: what each gained within ``range_s`` seconds up to each step, and that by the second.

    Steps are multiples of ``step_s`` seconds. An increase counts where both its samples are in the range (the range's begin left out); a counter that
    fell has begun anew from 0. A series with fewer than two samples in a range has no row. Nothing is carried on
    beyond the samples. Increases with the same first and last step are added up before they are dealt to their steps,
    so rows follow the steps and not how dense the samples are.
    """
    pairs = with_previous(samples, series, slab_s, value, ts).where("before_ts is not null")
    found = _dealt(pairs, series, {"increase": _gain(F.col(value), F.col("before_value"))}, step_s, range_s, ts)
    return found.select(*series, F.timestamp_micros("at").alias("step"), "increase", (F.col("increase") / range_s).alias("rate"))


def summed_rates(steps: DataFrame, by: list[str]) -> DataFrame:
    """``by, step, rate, series``: rates of :func:`counter_steps` added up, and of how many series."""
    return steps.groupBy(*by, "step").agg(F.sum("increase").alias("increase"), F.sum("rate").alias("rate"), F.count("*").alias("series"))


def histogram_steps(samples: DataFrame, series: list[str], by: list[str], q: float, step_s: int, range_s: int, slab_s: int = 86_400, bounds: list[float] | None = None) -> DataFrame:
    """``by, step, value``: the quantile, at each step, of what bucket counters (``series`` and ``le``) gained in the range.

    With ``bounds`` a sample is a whole histogram: ``value`` has the counts of all buckets in order of ``bounds``, there is no ``le``, and
    samples of one time are in order of their counts, from the first bucket on. Buckets of equal bound are added up by ``by``
    before they are dealt to steps, so rows follow groups and steps and not the series. Groups that gained nothing have no row.
    """
    own = [*dict.fromkeys([*series, *by])]
    if bounds is None:
        pairs = with_previous(samples, [*own, "le"], slab_s).where("before_ts is not null")
        found = _dealt(pairs, [*by, "le"], {"count": _gain(F.col("value"), F.col("before_value"))}, step_s, range_s, "ts")
    else:
        pairs = with_previous(samples, own, slab_s).where("before_ts is not null")
        sums = _dealt(pairs, by, {f"bucket_{i}": _gain(F.get("value", F.lit(i)), F.get("before_value", F.lit(i))) for i in range(len(bounds))}, step_s, range_s, "ts")
        buckets = F.array(*(F.struct(F.lit(float(le)).alias("le"), F.col(f"bucket_{i}").alias("count")) for i, le in enumerate(bounds)))
        found = sums.select(*by, "at", F.inline(buckets))
    return histogram_quantile(found.select(*by, F.timestamp_micros("at").alias("step"), "le", "count"), q, [*by, "step"])


def gauge_steps(samples: DataFrame, series: list[str], step_s: int, lookback_s: int, value: str = "value", ts: str = "ts") -> DataFrame:
    """``series, step, value``: each gauge's latest sample within ``lookback_s`` seconds up to each step (of one time, the largest).

    Of the samples between two steps the last is taken first; only that is dealt to the steps which it reaches.
    """
    step = step_s * _MICROS
    sample = F.struct(F.unix_micros(ts).alias("at"), F.col(value).alias("value"))
    cells = _usable(samples, ts, value).groupBy(*series, _at_or_after(F.unix_micros(ts), step).alias("low")).agg(F.max(sample).alias("s"))
    reach = _before(F.col("s.at") + lookback_s * _MICROS, step)
    dealt = cells.where(F.col("low") <= reach).select(*series, "s", F.explode(F.sequence("low", reach, F.lit(step).cast("bigint"))).alias("step_at"))
    found = dealt.groupBy(*series, "step_at").agg(F.max("s").alias("s"))
    return found.select(*series, F.timestamp_micros("step_at").alias("step"), F.col("s.value").alias("value"))


def gauge_totals(steps: DataFrame, by: list[str]) -> DataFrame:
    """``by, step, total, mean, up``: sum and mean of the gauges of :func:`gauge_steps`, and how many of them are above 0."""
    return steps.groupBy(*by, "step").agg(F.sum("value").alias("total"), F.avg("value").alias("mean"), F.count_if(F.col("value") > 0).alias("up"))


def step_grid(spark: SparkSession, first_s: int, last_s: int, step_s: int) -> DataFrame:
    """``step``: all steps between two times (in seconds), both included."""
    low, high = -(-first_s // step_s), last_s // step_s
    return spark.range(low, high + 1).select(F.timestamp_micros(F.col("id") * (step_s * _MICROS)).alias("step"))


def or_zero(found: DataFrame, groups: DataFrame, grid: DataFrame, by: list[str], values: list[str]) -> DataFrame:
    """``by, step, values``: a row for each of ``groups`` at each step of the grid, zeros where ``found`` has none. Rows elsewhere go.

    The product of two small tables is what is asked for here.
    """
    wanted = groups.select(*(F.col(b).alias(f"w_{b}") for b in by)).distinct().crossJoin(grid.select(F.col("step").alias("w_step")))
    same = F.col("w_step") == F.col("step")
    for b in by:
        same &= F.col(f"w_{b}").eqNullSafe(F.col(b))
    filled = wanted.join(found, same, "left")
    return filled.select(*(F.col(f"w_{b}").alias(b) for b in by), F.col("w_step").alias("step"), *(F.coalesce(v, F.lit(0).cast(found.schema[v].dataType)).alias(v) for v in values))
