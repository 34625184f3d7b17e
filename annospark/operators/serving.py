"""Analysis of serving: request metrics, summaries, sweeps, traces, counters and histograms."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ordered import largest_before, quantiles

QUANTILES = (0.25, 0.5, 0.75, 0.9, 0.99)


def request_metrics(log: DataFrame) -> DataFrame:
    """``log`` (times in s, ``n_tokens``, ``n_sequences``) with a request's metrics in ms; all null for requests of several sequences."""
    one = F.col("n_sequences") == 1
    ms = lambda x: F.when(one, x * 1000.0)
    generation = F.col("last_token_ts") - F.col("first_token_ts")
    return log.select(
        "*",
        ms(F.col("first_token_ts") - F.col("scheduled_ts")).alias("time_to_first_token_ms"),
        ms(generation).alias("generation_time_ms"),
        ms(F.col("scheduled_ts") - F.col("arrival_ts")).alias("queue_time_ms"),
        F.when(F.col("n_tokens") > 1, ms(generation / F.nullif(F.col("n_tokens") - 1, F.lit(0)))).alias("mean_itl_ms"),
        F.when(one, F.col("n_tokens") / F.nullif(F.col("last_token_ts") - F.col("scheduled_ts"), F.lit(0.0))).alias("tokens_per_second"),
    )


def summary(rows: DataFrame, metrics: list[str], exact: bool = True) -> DataFrame:
    """``metric, count, mean, std, min, p25, p50, p75, p90, p99, max``: over the rows turned to long form; exact quantiles by ranges."""
    stacked = rows.select(F.expr(f"stack({len(metrics)}, {', '.join(f"'{m}', cast(`{m}` as double)" for m in metrics)}) as (metric, v)")).where("v is not null")
    names = {f"p{int(q * 100)}": q for q in QUANTILES}
    plain = [F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max")]
    if exact:
        found = stacked.groupBy("metric").agg(*plain).join(quantiles(stacked, ["metric"], "v", names), "metric")
    else:
        found = stacked.groupBy("metric").agg(*plain, *(F.percentile_approx("v", F.lit(q)).alias(n) for n, q in names.items()))
    return found.select("metric", "count", "mean", "std", "min", *names, "max")


def sketches(rows: DataFrame, by: list[str], value: str, error: float = 0.01) -> DataFrame:
    """``by, bucket, n``: a mergeable sketch of ``value`` for each group, in buckets of logarithmic width.

    Any quantile comes out within the share ``error`` of the value at its place. ``bucket`` is a struct: sign (-1, 0, 1) and power, turned so
    that buckets sort as their values do. Nulls, NaNs and infinite values aren't counted. A group has at most some 150,000 buckets at
    an error of 0.01, whatever its size.
    """
    v = F.col(value).cast("double")
    power = F.ceil(F.log(F.abs(v)) / math.log((1 + error) / (1 - error))).cast("int")
    bucket = F.struct(F.signum(v).cast("int").alias("sign"), F.when(v > 0, power).when(v < 0, -power).otherwise(0).alias("power"))
    return rows.where(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < math.inf)).groupBy(*by, bucket.alias("bucket")).agg(F.count("*").alias("n"))


def merged_sketches(sketched: DataFrame, by: list[str]) -> DataFrame:
    """Sketches of coarser groups from those of finer ones: counts are added up, no row is read again."""
    return sketched.groupBy(*by, "bucket").agg(F.sum("n").alias("n"))


def sketched_quantiles(sketched: DataFrame, by: list[str], shares: dict[str, float], error: float = 0.01) -> DataFrame:
    """``by, count`` and a column for each of ``shares``: the value at place ``floor(share * (count - 1))``, within ``error`` of itself.

    ``error`` is the one that the sketches were made with. One window for each group over its buckets, which the sketch bounds.
    """
    width = (1 + error) / (1 - error)
    group = Window.partitionBy(*by)
    upto = F.sum("n").over(group.orderBy("bucket"))
    placed = sketched.withColumn("upto", upto).withColumn("count", F.sum("n").over(group))
    # powers of values below 1 are negative ones, so the sign says which way a power was turned
    middle = F.when(F.col("bucket.sign") == 0, 0.0).otherwise(F.col("bucket.sign") * 2 * F.pow(F.lit(width), F.col("bucket.sign") * F.col("bucket.power")) / (1 + width))
    at = {name: F.min(F.when(F.col("upto") > F.floor(F.lit(share) * (F.col("count") - 1)), F.struct("bucket", middle.alias("v"))))["v"] for name, share in shares.items()}
    return placed.groupBy(*by).agg(F.max("count").alias("count"), *(x.alias(name) for name, x in at.items()))


def sweep_grid(servers: DataFrame, benches: DataFrame, runs: int = 3) -> DataFrame:
    """Every server with every benchmark parameter set, ``runs`` times: small tables, and the product is what is asked for."""
    return servers.crossJoin(benches).withColumn("run", F.explode(F.sequence(F.lit(0), F.lit(runs - 1))))


def sweep_curves(results: DataFrame, x: str, y: str, curve: list[str], bin_width: float | None = None, keep: Column | None = None) -> DataFrame:
    """``curve..., x, y, n``: mean y for each (binned) x of each curve."""
    rows = results if keep is None else results.where(keep)
    place = F.floor(F.col(x) / bin_width) * bin_width if bin_width else F.col(x)
    return rows.groupBy(*curve, place.cast("double").alias("x")).agg(F.avg(y).alias("y"), F.count("*").alias("n"))


def best_under_limit(runs: DataFrame, limit_ms: float, throughput: str = "throughput", latency: str = "p99_ms", name: str = "run") -> DataFrame:
    """One row ``run, throughput, p99_ms``: the most throughput with a latency within the limit; zeros if there is none."""
    best = runs.where(F.col(latency) <= limit_ms).agg(F.max(F.struct(F.col(throughput).alias("t"), (-F.col(latency)).alias("l"), F.col(name).alias("r"))).alias("b"))
    return best.select(F.coalesce("b.r", F.lit("")).alias("run"), F.coalesce("b.t", F.lit(0.0)).alias("throughput"), F.coalesce(-F.col("b.l"), F.lit(0.0)).alias("p99_ms"))


def pareto_frontier(points: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """Rows that no other one matches or beats in both ``x`` and ``y`` (and beats in one).

    The best y of each x first; what lies ahead of it follows range by range of x.
    """
    top = points.groupBy(F.col(x).alias("px")).agg(F.max(y).alias("py"))
    front = largest_before(top, [F.desc("px")], "py", "ahead").where(F.col("ahead").isNull() | (F.col("py") > F.col("ahead"))).drop("ahead")
    return points.join(front, (F.col(x) == F.col("px")) & (F.col(y) == F.col("py"))).drop("px", "py")


def kernel_category(name: Column, rules: list[tuple[str, str]]) -> Column:
    """The category of the first rule (pattern, category) that is found in ``name``."""
    out = None
    for pattern, category in rules:
        out = F.when(name.rlike(pattern), category) if out is None else out.when(name.rlike(pattern), category)
    return out.otherwise("misc") if out is not None else F.lit("misc")


def kernel_seconds(trace: DataFrame, rules: list[tuple[str, str]], elapsed: DataFrame, by: str) -> DataFrame:
    """``by, category, seconds`` from ``kernel, seconds``, with a row ``non-gpu`` for what is left of ``elapsed`` (``by, elapsed``)."""
    gpu = trace.groupBy(by, kernel_category(F.col("kernel"), rules).alias("category")).agg(F.sum("seconds").alias("seconds"))
    used = gpu.groupBy(by).agg(F.sum("seconds").alias("used"))
    rest = elapsed.join(used, by, "left").select(by, F.lit("non-gpu").alias("category"), (F.col("elapsed") - F.coalesce("used", F.lit(0.0))).alias("seconds"))
    return gpu.union(rest)


def counter_increases(samples: DataFrame, series: list[str], value: str = "value", ts: str = "ts") -> DataFrame:
    """Samples with ``increase`` since the series' sample before; a counter that fell has begun anew from 0."""
    before = F.lag(value).over(Window.partitionBy(*series).orderBy(ts))
    return samples.withColumn("increase", F.when(before.isNull(), 0.0).when(F.col(value) < before, F.col(value)).otherwise(F.col(value) - before))


def counter_rates(samples: DataFrame, series: list[str], by: list[str], interval: str, seconds: float) -> DataFrame:
    """``by, bucket, rate``: increases a second within tumbling intervals."""
    rows = counter_increases(samples, series)
    return rows.groupBy(*by, F.window("ts", interval).alias("w")).agg((F.sum("increase") / seconds).alias("rate")).select(*by, F.col("w.start").alias("bucket"), "rate")


def histogram_quantile(buckets: DataFrame, q: float, by: list[str]) -> DataFrame:
    """``by, value``: the quantile of cumulative buckets (``le, count``), linear inside a bucket; the last bound below an infinite bucket."""
    order = Window.partitionBy(*by).orderBy("le")
    sums = buckets.groupBy(*by, "le").agg(F.sum("count").alias("count"))
    rows = sums.withColumn("total", F.max("count").over(Window.partitionBy(*by))).withColumn("low", F.coalesce(F.lag("le").over(order), F.lit(0.0))).withColumn("under", F.coalesce(F.lag("count").over(order), F.lit(0)))
    target = F.lit(q) * F.col("total")
    hit = rows.where((F.col("count") >= target) & (F.col("total") > 0)).groupBy(*by).agg(F.min_by(F.struct("le", "low", "count", "under", "total"), "le").alias("b"))
    inside = F.col("b.low") + (F.col("b.le") - F.col("b.low")) * (F.lit(q) * F.col("b.total") - F.col("b.under")) / F.nullif(F.col("b.count") - F.col("b.under"), F.lit(0))
    return hit.select(*by, F.when(F.col("b.le") == float("inf"), F.col("b.low")).otherwise(F.coalesce(inside, F.col("b.le"))).alias("value"))


def latest_gauges(samples: DataFrame, series: list[str], by: list[str]) -> DataFrame:
    """``by, total, mean`` over the latest sample of each series."""
    latest = samples.groupBy(*dict.fromkeys([*series, *by])).agg(F.max_by("value", "ts").alias("value"))
    return latest.groupBy(*by).agg(F.coalesce(F.sum("value"), F.lit(0.0)).alias("total"), F.coalesce(F.avg("value"), F.lit(0.0)).alias("mean"))
