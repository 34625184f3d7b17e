"""Increases of counters over a stream whose samples come in any order."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

_STATE = "last_at bigint, last_value double, waiting_at array<bigint>, waiting_value array<double>"


def _put_in_order(last: tuple[int, float] | None, waiting: list[tuple[int, float]], watermark: int) -> tuple[list[tuple[int, float, float]], tuple[int, float] | None, list[tuple[int, float]]]:
    """Samples (microseconds, value) that the watermark (milliseconds) has passed, in order and with their increase; the last of them; those that go on waiting."""
    out, later = [], []
    for at, value in sorted(waiting):
        if at > watermark * 1000:
            later.append((at, value))
            continue
        gained = 0.0 if last is None else value if value < last[1] else value - last[1]
        out.append((at, value, gained))
        last = (at, value)
    return out, last, later


def counter_increases(stream: DataFrame, series: list[str], late: str = "10 minutes", value: str = "value", ts: str = "ts") -> DataFrame:
    """``series, ts, value, increase`` of a stream of samples, as :func:`serving.counter_increases` gives them for a table.

    A sample waits in its series' state until the watermark passes it, so the order in which samples come makes no difference;
    one that comes later than that is dropped. A counter that fell has begun anew from 0. State holds a series' last sample and those
    that wait: it follows the samples of ``late`` and the number of series. Samples without a time or a value are left out; of one time, they go by value.
    """
    usable = stream.where(F.col(ts).isNotNull() & F.col(value).isNotNull())
    rows = usable.select(*series, F.col(ts).cast("timestamp").alias("ts"), F.col(value).cast("double").alias("value")).withColumn("at", F.unix_micros("ts")).withWatermark("ts", late)
    schema = StructType([*(rows.schema[s] for s in series), StructField("at", LongType()), StructField("value", DoubleType()), StructField("increase", DoubleType())])

    def run(key: tuple, tables: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, waiting = None, []
        if state.exists:
            last_at, last_value, times, values = state.get
            last = None if last_at is None else (last_at, last_value)
            waiting = list(zip(times, values))
        if not state.hasTimedOut:
            for table in tables:
                waiting += zip(table["at"].tolist(), table["value"].tolist())
        watermark = state.getCurrentWatermarkMs()
        out, last, waiting = _put_in_order(last, waiting, watermark)
        state.update((*(last or (None, None)), [t for t, _ in waiting], [v for _, v in waiting]))
        if waiting:
            state.setTimeoutTimestamp(max(watermark + 1, waiting[0][0] // 1000))
        if out:
            columns = {name: [k] * len(out) for name, k in zip(series, key)}
            yield pd.DataFrame(columns | {name: [row[i] for row in out] for i, name in enumerate(("at", "value", "increase"))})

    found = rows.groupBy(*series).applyInPandasWithState(run, schema, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return found.select(*series, F.timestamp_micros("at").alias("ts"), "value", "increase")
