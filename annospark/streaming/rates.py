"""Counter rates over a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def event_rates(stream: DataFrame, by: list[str], interval: str, seconds: float, late: str = "10 minutes", ts: str = "ts") -> DataFrame:
    """``by, bucket, n, rate``: events a second in tumbling intervals. An interval is final once the watermark has passed it;
    state holds open intervals alone."""
    counted = stream.withWatermark(ts, late).groupBy(F.window(ts, interval).alias("w"), *by).agg(F.count("*").alias("n"))
    return counted.select(*by, F.col("w.start").alias("bucket"), "n", (F.col("n") / F.lit(seconds)).alias("rate"))


def run_available(rates: DataFrame, path: str, checkpoint: str) -> None:
    """Works off what the source holds and stops; the next call goes on from there. Files are written exactly once."""
    rates.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
