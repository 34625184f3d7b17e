"""Order over a whole table without a single task: tables kept on shared storage, row numbers, running maxima, quantiles."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_local: list[str] = []


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below ``spark.checkpoint.dir`` and read back, so that nothing before it is computed again.

    Sessions on one machine may leave the setting out and get a temporary folder; elsewhere that is an error.
    """
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        if not _local:
            _local.append("file://" + tempfile.mkdtemp(prefix="annospark-"))
        base = _local[0]
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _ranged(rows: DataFrame, order: list[str | Column], ranges: int | None = None) -> DataFrame:
    """``rows`` in ranges of ``order``, sorted within, with ``range`` and ``at``, the place within the range; kept, so that ranges stay."""
    sorted_rows = rows.repartitionByRange(*([ranges] if ranges else []), *order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()
    return kept(sorted_rows.withColumn("range", F.shiftright(place, 33)).withColumn("at", place.bitwiseAND(F.lit((1 << 33) - 1))), "ranges")


def numbered(rows: DataFrame, order: list[str | Column], name: str = "line") -> DataFrame:
    """``rows`` with ``name``, their number from 1 in ``order`` over the whole table: by ranges, each with what lies before it."""
    placed = _ranged(rows, order)
    sizes = placed.groupBy("range").agg(F.count("*").alias("n"))  # one row a range
    before = sizes.select("range", F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return placed.join(F.broadcast(before), "range").withColumn(name, F.col("before") + F.col("at") + 1).drop("range", "at", "before")


def largest_before(rows: DataFrame, order: list[str | Column], value: str, name: str) -> DataFrame:
    """``rows`` with ``name``, the largest ``value`` of all rows before in ``order``, null for the first."""
    placed = _ranged(rows, order)
    tops = placed.groupBy("range").agg(F.max(value).alias("top"))
    before = tops.select("range", F.max("top").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)).alias("before"))
    own = F.max(value).over(Window.partitionBy("range").orderBy("at").rowsBetween(Window.unboundedPreceding, -1))
    return placed.join(F.broadcast(before), "range").withColumn(name, F.greatest(own, "before")).drop("range", "at", "before")


def sums_before(rows: DataFrame, by: list[str], order: list[str | Column], sums: dict[str, str], ranges: int | None = None) -> DataFrame:
    """``rows`` with columns named by ``sums``: what a column adds up to (nulls count 0) over the earlier rows of the group, 0 for the first.

    By ranges of (``by``, ``order``), so that a group of any size is spread over tasks. Of groups in several ranges the sums of the
    ranges before are joined: at most two rows a range. Null keys are a group.
    """
    keys = [f"k_{b}" for b in by]
    placed = _ranged(rows, [*by, *order], ranges)
    earlier = Window.partitionBy(*by).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    here = Window.partitionBy("range", *by).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    value = {name: F.coalesce(F.col(c), F.lit(0)).cast("bigint") for name, c in sums.items()}
    totals = placed.groupBy("range", *by).agg(*(F.sum(v).alias(f"s_{n}") for n, v in value.items())).withColumn("several", F.count("*").over(Window.partitionBy(*by)))
    totals = totals.select(F.col("range").alias("k_range"), *(F.col(b).alias(k) for b, k in zip(by, keys)), "several", *(F.sum(f"s_{n}").over(earlier).alias(f"b_{n}") for n in value))
    same = F.col("range") == F.col("k_range")
    for b, k in zip(by, keys):
        same = same & F.col(b).eqNullSafe(F.col(k))
    joined = placed.join(F.broadcast(totals.where("several > 1").drop("several")), same, "left")
    found = {n: F.coalesce(F.sum(v).over(here), F.lit(0)) + F.coalesce(f"b_{n}", F.lit(0)) for n, v in value.items()}
    return joined.select(*rows.columns, *(v.alias(n) for n, v in found.items()))


def islands_by_ranges(rows: DataFrame, by: list[str], order: list[str], start: str, end: str, label: Column, gap: int, ranges: int | None = None) -> DataFrame:
    """As ``intervals.islands``, for groups of any length, with ``label_before`` (the label of the row before, null for the first).

    Rows are sorted into ranges of (``by``, ``order``). What a range must know of its group's earlier ranges (largest end, last
    label, islands opened) comes from summaries, one row for each range and group, of which only groups in several ranges are
    joined back: at most two rows a range. Null keys are a group. An empty table gives an empty one.
    """
    keys = [f"k_{b}" for b in by]
    placed = _ranged(rows.withColumn("own_label", F.struct(label.alias("is"))), [*by, *order], ranges)
    earlier = Window.partitionBy(*by).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    here = Window.partitionBy("range", *by).orderBy("at")

    def joined(table: DataFrame, sums: DataFrame, names: list[str]) -> DataFrame:
        over = sums.withColumn("several", F.count("*").over(Window.partitionBy(*by))).where("several > 1")
        over = F.broadcast(over.select(F.col("range").alias("k_range"), *(F.col(b).alias(k) for b, k in zip(by, keys)), *names))  # two rows a range
        same = F.col("range") == F.col("k_range")
        for b, k in zip(by, keys):
            same = same & F.col(b).eqNullSafe(F.col(k))
        return table.join(over, same, "left").drop("k_range", *keys)

    tops = placed.groupBy("range", *by).agg(F.max(end).alias("top"), F.max_by("own_label", "at").alias("last_label"))
    tops = tops.withColumn("top_before", F.max("top").over(earlier)).withColumn("last_before", F.last("last_label").over(earlier))
    marked = joined(placed, tops, ["top_before", "last_before"])
    reach = F.greatest(F.max(end).over(here.rowsBetween(Window.unboundedPreceding, -1)), "top_before")
    marked = marked.withColumn("reach", reach).withColumn("label_before", F.coalesce(F.lag("own_label").over(here), "last_before"))
    marked = marked.withColumn("same_label", F.col("own_label").eqNullSafe(F.col("label_before")) & F.col("reach").isNotNull())
    marked = marked.withColumn("opens", (~F.col("same_label") | (F.col(start) - F.col("reach") > gap)).cast("bigint"))
    opened = marked.groupBy("range", *by).agg(F.sum("opens").alias("n")).withColumn("opened", F.sum("n").over(earlier))
    found = joined(marked, opened, ["opened"]).withColumn("island", F.sum("opens").over(here) + F.coalesce("opened", F.lit(0)))
    return found.withColumn("label_before", F.col("label_before")["is"]).drop("range", "at", "own_label", "top_before", "last_before", "opens", "opened")


def quantiles(rows: DataFrame, by: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """``by`` and a column for each of ``shares``: exact quantiles of ``value``, linear between neighbours; nulls don't count.

    Rows are numbered by ranges of (``by``, value), so that a group of any size is spread over tasks; of each group only
    the rows at the quantiles' places are looked at together.
    """
    placed = numbered(rows.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("v")), [*by, "v"], "nth")
    placed = kept(placed, "numbered")
    groups = placed.groupBy(*by).agg(F.min("nth").alias("first"), F.count("*").alias("n")).withColumnsRenamed({b: f"g_{b}" for b in by})
    near = placed
    if by:
        same = None
        for b in by:
            test = F.col(b).eqNullSafe(F.col(f"g_{b}"))
            same = test if same is None else same & test
        near = near.join(groups, same)
    else:
        near = near.crossJoin(F.broadcast(groups))  # one row
    at = {name: (F.col("n") - 1) * F.lit(share) for name, share in shares.items()}
    place = F.col("nth") - F.col("first")
    hit = None
    for x in at.values():
        test = (place == F.floor(x)) | (place == F.ceil(x))
        hit = test if hit is None else hit | test
    low = {name: F.max(F.when(place == F.floor(x), F.col("v"))) for name, x in at.items()}
    high = {name: F.max(F.when(place == F.ceil(x), F.col("v"))) for name, x in at.items()}
    part = {name: F.max(x - F.floor(x)) for name, x in at.items()}
    return near.where(hit).groupBy(*by).agg(*((low[name] + (high[name] - low[name]) * part[name]).alias(name) for name in shares))
