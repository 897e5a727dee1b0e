"""round2_sql equals Python's round(x, 2), in Spark and in DuckDB."""

import random

import duckdb

from jobtally.functions.numbers import round2_sql


def _values():
    rng = random.Random(3)
    vals = [0.125, 0.375, -0.125, 2.675, 0.355, 291767.575, 1.005, 0.0, 12.345, -2106147.2835]
    for _ in range(1500):
        ms = rng.randrange(0, 10 ** rng.randint(1, 12))
        tie_ms = rng.randrange(0, 10 ** rng.randint(1, 11)) * 10 + 5   # decimal ties
        vals += [ms / 1000, -ms / 1000, tie_ms / 1000, -tie_ms / 1000,
                 rng.randrange(0, 2 ** rng.randint(1, 40)) / 1048576]
    inv25 = pow(25, -1, 2 ** 18)   # byte counts whose MB value is an exact binary tie
    for j in range(200):
        b = (2 ** 17 * inv25) % 2 ** 18 + j * 2 ** 18
        assert (b * 100) % 2 ** 20 == 2 ** 19
        vals.append(b / 1048576)
    return vals


def test_round2_matches_python(spark):
    vals = _values()
    want = {i: round(v, 2) for i, v in enumerate(vals)}
    df = spark.createDataFrame(list(enumerate(vals)), "i int, x double")
    got = {r["i"]: r["r"] for r in df.selectExpr("i", f"{round2_sql('x')} AS r").collect()}
    assert got == want
    con = duckdb.connect()
    con.execute("CREATE TABLE t(i INTEGER, x DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(vals)))
    assert dict(con.execute(f"SELECT i, {round2_sql('x')} FROM t").fetchall()) == want
    plan = df.selectExpr(f"{round2_sql('x')} AS r")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
