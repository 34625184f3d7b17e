"""Half-open intervals in order: islands of equal neighbours, and overlaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_end(end: str, by: list[str], order: list[str]) -> Column:
    """The largest end of all earlier rows of the group, null for the first."""
    return F.max(end).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))


def islands(rows: DataFrame, by: list[str], order: list[str], start: str, end: str, label: Column, gap: int) -> DataFrame:
    """``rows`` with ``island`` (counted from 1 within ``by``), ``reach`` (largest earlier end) and ``same_label``.

    A row opens an island when its label differs from the row before, or it starts more than ``gap`` after all earlier ends.
    An overlap is a negative gap. Labels compare null-safely. One shuffle by ``by``.
    """
    window = Window.partitionBy(*by).orderBy(*order)
    marked = rows.withColumn("reach", running_end(end, by, order)).withColumn("same_label", label.eqNullSafe(F.lag(label).over(window)) & F.col("reach").isNotNull())
    opens = ~F.col("same_label") | (F.col(start) - F.col("reach") > gap)
    return marked.withColumn("island", F.sum(opens.cast("int")).over(window))
