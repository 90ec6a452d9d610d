"""Every query that SQL can express, against DuckDB on the smallest tables."""

import datetime as dt
import decimal
import math
import os

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if v is None or isinstance(v, str):
        return v
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    if isinstance(v, (int, np.integer)):
        return float(v)
    if isinstance(v, (float, np.floating, decimal.Decimal)):
        return None if math.isnan(v) else float(f"{float(v) + 0.0:.8g}")
    if isinstance(v, (dt.date, dt.datetime)):
        return str(pd.Timestamp(v).tz_localize(None))
    return tuple(map(plain, v))


def rows(found):
    return sorted((tuple(map(plain, r)) for r in found), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    sql = duck.sql(SQL[name])
    assert sorted(sql.columns) == columns
    expected = duck.sql("SELECT " + ", ".join(f'"{c}"' for c in columns) + f" FROM ({SQL[name]})").fetchall()
    assert rows(df.select(*(f"`{c}`" for c in columns)).collect()) == rows(expected)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert not set(SQL) - set(QUERIES)


def test_math_functions_round_as_sql_at_ties_and_extremes(spark, tmp_path):
    values = [65.1414155, 32.4766255, 12.0000005, 115.1234565, 1234567.8900005, 0.05, 0.15, 0.25, 50.0, 0.0, -0.25, 4.53917591984304e46, 1.7e308, 5e-324, math.nan, math.inf, None]
    con = duckdb.connect()
    con.execute("CREATE TABLE events (event_id BIGINT, value DOUBLE)")
    con.executemany("INSERT INTO events VALUES (?, ?)", list(enumerate(values)))
    con.execute(f"COPY events TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    columns = "event_id, l, s, e, a, h, clip, sg"  # powers have other last digits in other libraries
    expected = con.sql(f"SELECT {columns} FROM ({SQL['math_functions']}) ORDER BY event_id").fetchall()
    got = QUERIES["math_functions"](spark, str(tmp_path)).orderBy("event_id").select(*columns.split(", ")).collect()
    assert [repr(tuple(g)) for g in got] == [repr(e) for e in expected]


def test_math_functions_powers_as_sql(spark, tmp_path):
    values = [134133.38, 146287.02, 369838.41, 488878.94, 560.21, 0.01, 0.0, -1.0, 1e-200, 1e160, math.inf, math.nan, None]
    con = duckdb.connect()
    con.execute("CREATE TABLE events (event_id BIGINT, value DOUBLE)")
    con.executemany("INSERT INTO events VALUES (?, ?)", list(enumerate(values)))
    con.execute(f"COPY events TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    expected = con.sql(f"SELECT event_id, p FROM ({SQL['math_functions']}) ORDER BY event_id").fetchall()
    got = QUERIES["math_functions"](spark, str(tmp_path)).orderBy("event_id").select("event_id", "p").collect()
    assert [repr(tuple(g)) for g in got] == [repr(e) for e in expected]
