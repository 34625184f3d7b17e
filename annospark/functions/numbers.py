"""Strict numbers from text and VARIANT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What counts as a decimal number in probe text: digits, a fraction, an exponent, or the words for infinity and not-a-number.
DECIMAL = r"(?i)^\s*[+-]?(\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?\s*$"


def finite(text: Column) -> Column:
    """A finite double written in ``text``, else null."""
    value = F.trim(text).try_cast("double")
    return F.when(text.rlike(DECIMAL) & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf"))), value)


def half_even(x: Column) -> Column:
    """Nearest integer, ties to the even one."""
    return F.rint(x).cast("bigint")


def is_integer(value: Column) -> Column:
    """Whether a VARIANT holds an integer as such: 1000, not 1000.0, 1e3 or "1000"."""
    return F.coalesce(F.schema_of_variant(value).isin("BIGINT", "INT", "SMALLINT", "TINYINT"), F.lit(False))
