"""Every plan against its SQL in DuckDB, over whole small tables."""

import duckdb
import pytest

from cliploom import plans

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "float": "FLOAT"}
QUERIES, ORACLES = plans.queries(), plans.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = df.select(*[f"`{c}`" for c in columns]).collect()
    if name not in ORACLES:
        assert got
        return
    rel = duck.sql(ORACLES[name])
    assert sorted(rel.columns) == columns
    kinds = dict(zip(rel.columns, map(str, rel.types), strict=True))
    assert {c: KINDS[k] for c, k in df.dtypes} == kinds
    at = [rel.columns.index(c) for c in columns]
    assert ordered(got) == ordered([tuple(r[i] for i in at) for r in rel.fetchall()])
