"""The queries with SQL against DuckDB."""

from pathlib import Path

import duckdb
import pytest

from annospark.llm import queries

FOLDER = "/root/testdata/sf0.001"
KEYS = {"op12_conversation_repair": ["conv_id"], "op13_collocations": ["lang", "rank"]}


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for f in Path(FOLDER).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    want = con.execute(queries.SQL[name]).df()
    found = queries.QUERIES[name](spark, FOLDER).toPandas()
    assert sorted(found.columns) == sorted(want.columns) and len(found) == len(want)
    key = KEYS.get(name, ["doc_id"])
    want, found = (df.sort_values(key).reset_index(drop=True) for df in (want, found))
    for c in want.columns:
        assert found[c].equals(want[c].astype(found[c].dtype)), c
