"""Evaluation of model outputs against answers and thresholds."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def accuracy(predictions: DataFrame, answers: DataFrame, thresholds: DataFrame, by: str, key: str = "item_id") -> DataFrame:
    """``by, n, accuracy, threshold, passed``; an item without prediction is wrong, nulls never match."""
    joined = answers.select(key, by, "answer").join(predictions.select(key, "prediction"), key, "left")
    mean = joined.groupBy(by).agg(F.count("*").alias("n"), F.avg(F.coalesce((F.col("prediction") == F.col("answer")).cast("double"), F.lit(0.0))).alias("accuracy"))
    return mean.join(thresholds.select(by, "threshold"), by, "left").withColumn("passed", F.coalesce(F.col("accuracy") >= F.col("threshold"), F.lit(False)))


@F.pandas_udf(DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Share of matching characters of two texts, after difflib."""
    return pd.Series([SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b)])


def prefixed_match(rows: DataFrame, thresholds: DataFrame, by: str) -> DataFrame:
    """``by, n, match_ratio, threshold, passed`` from ``prefix, response, answer``: 0 unless the response begins with the prefix, else the ratio of the rest to the answer."""
    starts = F.coalesce(F.col("response").startswith(F.col("prefix")), F.lit(False))
    rest = F.substring("response", F.length("prefix") + 1, F.length("response"))
    right = rows.where(starts).select(by, sequence_ratio(rest, F.col("answer")).alias("ratio"))
    wrong = rows.where(~starts).select(by, F.lit(0.0).alias("ratio"))
    mean = right.union(wrong).groupBy(by).agg(F.count("*").alias("n"), F.avg("ratio").alias("match_ratio"))
    return mean.join(thresholds.select(by, "threshold"), by, "left").withColumn("passed", F.coalesce(F.col("match_ratio") >= F.col("threshold"), F.lit(False)))


def fits_prompt(n_chars: Column, max_prompt_tokens: int) -> Column:
    """Whether a sample is short enough, at the safe assumption of four tokens for a character."""
    return n_chars * 4 <= max_prompt_tokens
