"""Every registered query against its SQL twin, over whole tables."""

import math
from collections import Counter
from decimal import Decimal

import duckdb
import pytest

from quillfold import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
DUCK = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "int": "INTEGER"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, (float, Decimal)):
        return "nan" if math.isnan(v) else round(float(v), 6)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


@pytest.mark.parametrize("name", sorted(registry.oracles()))
def test_query_equals_sql(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = Counter(tuple(plain(x) for x in r) for r in df.select(*columns).collect())
    twin = duck.sql(registry.oracles()[name])
    assert sorted(twin.columns) == columns
    kinds = dict(zip(twin.columns, map(str, twin.types), strict=True))
    assert {c: DUCK[k] for c, k in df.dtypes} == kinds
    quoted = ",".join(f'"{c}"' for c in columns)
    want = Counter(tuple(plain(x) for x in r) for r in duck.sql(f"SELECT {quoted} FROM ({registry.oracles()[name]}) t").fetchall())
    assert got == want


def test_queries_without_sql_give_rows(spark):
    for name in sorted(set(registry.queries()) - set(registry.oracles())):
        assert registry.queries()[name](spark, SF).count() > 0, name


def test_no_query_is_cartesian(spark):
    from quillfold.plans.inspect import has_cartesian

    for name, fn in registry.queries().items():
        assert not has_cartesian(fn(spark, SF)), name
