"""Every registered query against its DuckDB oracle on the smallest driver tables (as the driver does)."""

import hashlib
import json
import math

import duckdb
import pytest

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256("\n".join(sorted(json.dumps([_norm(r[i]) for i in order], default=str) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _names():
    import __spark_entry__ as E

    return sorted(E.queries())


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    import __spark_entry__ as E

    sql = E.oracle_sql().get(name)
    if sql is None:
        pytest.skip("no SQL oracle; tested against brute force")
    df = E.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    rel = con.sql(sql)
    exp = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(got) == len(exp)
    assert _digest(got, df.columns) == _digest(exp, rel.columns)


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["location_id", "timestamp", "temperature_2m", "precipitation", "wind_speed_10m"]
