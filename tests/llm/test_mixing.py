import brute
import duckdb
import pytest
from odd_rows import ODD_ROWS, rows_of
from pyspark.sql import functions as F

from jobtally.llm import mixing as M


def mix_rows(df):
    return rows_of(M.mix(df).selectExpr("doc_id", "mix_size", "mix_source_size", "mix_target", "mix_size * mix_passes"))


def sql_rows(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    return sorted(con.execute(M.ORACLE).fetchall(), key=repr)


def uneven():
    sizes = {"a": 40, "b": 400, "c": 5, None: 100, "d": 1, "e": 300, "é": 60, "f": 3}
    return [(n * 1000 + i, "w " * (i % 23 + 1), s) for n, (s, k) in enumerate(sizes.items()) for i in range(k)]


@pytest.mark.parametrize("rows", [uneven(), [(r[0], r[1], r[3]) for r in ODD_ROWS], [(1, "a b", "s")], [(1, None, "s"), (2, "", None)]])
def test_equals_sql_and_targets(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mix_rows(df)
    assert got == sql_rows(rows)
    targets = brute.mix([(i, len(brute.WORD.findall(t or "")), s) for i, t, s in rows])
    of = rows_of(M.mix(df).selectExpr("source", "mix_source_size", "mix_target").distinct())
    assert of == sorted(((s, n, pytest.approx(t)) for s, (n, t) in targets.items()), key=lambda r: repr((r[0], r[1])))
    assert all(taken <= 2 * size for _, size, _, _, taken in got)


def test_taken_is_near_target(spark):
    rows = uneven()
    out = M.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    sums = out.groupBy("source").agg(F.max("mix_target").alias("target"), F.sum(F.expr("mix_size * mix_passes")).alias("taken"))
    for r in sums.collect():
        assert abs(r.target - r.taken) <= 24


def test_threshold_is_nested(spark):
    """The documents of a smaller budget are among those of a larger one."""
    rows = [(i, "w " * (i % 9 + 1), "s") for i in range(500)]
    sizes = spark.createDataFrame(rows, "doc_id long, text string, source string").select(
        "source", M.word_count(F.col("text")).alias("size"), M.hash32(F.col("doc_id")).alias("hash"))
    total = sum(i % 9 + 1 for i in range(500))
    last = -1
    for part in (0.1, 0.3, 0.31, 0.9):
        targets = spark.createDataFrame([("s", total, total * part)], "source string, source_size long, target double")
        now = M.thresholds(sizes, targets).first().threshold
        assert now >= last
        taken = sizes.where(sizes.hash < now).agg({"size": "sum"}).first()[0]
        assert abs(taken - total * part) <= 9
        last = now


def test_columns_and_empty_table(odd_wide, nothing):
    out = M.mixed(odd_wide)
    assert out.columns == odd_wide.columns
    assert {r["threshold"] for r in out.collect()} <= {"own"}
    assert out.count() == sum(r.mix_passes for r in M.mix(odd_wide).collect())
    assert M.mix(nothing).count() == 0 and M.mixed(nothing).count() == 0


def test_reruns_agree(small):
    assert mix_rows(small) == mix_rows(small.repartition(7))
