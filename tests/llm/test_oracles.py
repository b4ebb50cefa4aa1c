"""The corpus queries that SQL can express, against their SQL twins over whole tables."""

from collections import Counter

import duckdb
import pytest

from quillfold.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
DUCK = {"bigint": "BIGINT", "boolean": "BOOLEAN", "int": "INTEGER"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    twin = con.sql(ORACLES[name])
    assert sorted(twin.columns) == columns
    assert {c: DUCK[k] for c, k in df.dtypes} == dict(zip(twin.columns, map(str, twin.types), strict=True))
    want = Counter(con.sql(f"SELECT {','.join(columns)} FROM ({ORACLES[name]}) t").fetchall())
    assert Counter(map(tuple, df.select(*columns).collect())) == want
