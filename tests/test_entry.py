"""Driver contract: entry smoke, and every twin agrees at sf0.001."""

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from helpers import SMALL
from jobtally.plans.catalog import ORACLE_SQL, SPARK_QUERIES


def test_entry(spark):
    df = entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 9
    assert df.columns == ["tag", "cluster", "completedJobs", "failedJobs", "totalSecs",
                          "jobCount", "ehpcSecs", "ehpcJobCount"]


def test_every_query_has_a_twin():
    assert set(oracle_sql()) <= set(queries())
    assert set(SPARK_QUERIES) == set(ORACLE_SQL)
    assert set(SPARK_QUERIES) <= set(queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("lineitem", "events"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def cell(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(round(v, 9))
        return repr(v)
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_twin(spark, con, name):
    df = queries()[name](spark, SMALL)
    res = con.execute(oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _norm([tuple(r) for r in df.collect()], df.columns) == _norm(res.fetchall(), dcols)


@pytest.mark.parametrize("name", ["event_extrema", "runlog_totals", "stage_merge", "fused_report"])
def test_results_do_not_depend_on_session_time_zone(spark, con, name):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = queries()[name](spark, SMALL)
        rows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    res = con.execute(oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert _norm(rows, df.columns) == _norm(res.fetchall(), dcols)
