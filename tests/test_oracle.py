"""Every catalogue query against its DuckDB SQL on sf0.001."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from cmdeval.plans import ORACLE_SQL, QUERIES
from sf_paths import SF001

TABLES = ["events", "documents", "conversations", "benchmark"]


def norm(df):
    cols = sorted(df.columns)

    def cell(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "NULL"
        if isinstance(v, float):
            return f"{round(v, 6):.6f}"
        if isinstance(v, pd.Timestamp):
            return v.isoformat()
        return str(v)
    return sorted(tuple(cell(v) for v in rec) for rec in df[cols].itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF001).toPandas()
    want = con.execute(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert norm(got) == norm(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF001).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 4
    assert df.columns[:3] == ["model", "suite", "num_samples"]


@pytest.mark.parametrize("name", ["stream_telemetry", "stream_loss_windows", "stream_log_tail", "loss_convergence", "log_tail"])
def test_time_queries_independent_of_session_zone(spark, con, name):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = QUERIES[name](spark, SF001).toPandas()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert norm(got) == norm(con.execute(ORACLE_SQL[name]).df())
