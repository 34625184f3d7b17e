"""Columns that are computed once a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(rows: DataFrame, **values: Column) -> DataFrame:
    """``rows`` with ``values``, each computed once a row however many later columns and filters name it.

    A plain column is copied into every expression and filter that uses it, and those into the next ones, so costly ones
    multiply; what a generator gives (here one row for each) is not. A value can't name another one of the same call.
    """
    return rows.select("*", F.inline(F.array(F.struct(*(v.alias(n) for n, v in values.items())))))
