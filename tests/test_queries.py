"""Every query with SQL against DuckDB on the smallest tables, and the streaming form of rates."""

from pathlib import Path

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from annospark.plans import catalog
from annospark.streaming import rates

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in Path(FOLDER).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def plain(df):
    df = df[sorted(df.columns)].astype(object)
    for c in df.columns:
        df[c] = pd.Series([None if x is None or x is pd.NA or x != x else (round(float(x), 5) if isinstance(x, (int, float, np.number)) and not isinstance(x, (bool, np.bool_)) else str(x)) for x in df[c]], dtype=object)
    return sorted(map(tuple, df.itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_its_sql(spark, duck, name):
    assert plain(catalog.QUERIES[name](spark, FOLDER).toPandas()) == plain(duck.execute(catalog.SQL[name]).df())


def test_every_query_without_sql_is_known():
    assert set(catalog.QUERIES) - set(catalog.SQL) == {"eval_prefixed_match"}


def test_stream_of_files_equals_the_batch(spark, tmp_path):
    events = spark.read.parquet(f"{FOLDER}/events.parquet").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    late = events.limit(1).withColumn("ts", F.lit("2030-01-01").cast("timestamp")).withColumn("event_type", F.lit("end"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    run = lambda: rates.run_available(rates.event_rates(stream, ["event_type"], "1 day", 86400.0), str(tmp_path / "out"), str(tmp_path / "cp"))
    run()
    late.write.mode("append").parquet(str(tmp_path / "in"))
    run()
    got = {(r.event_type, str(r.bucket), r.n) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {(r.event_type, str(r.bucket), r.n) for r in rates.event_rates(events, ["event_type"], "1 day", 86400.0).collect()}
    assert got == want
