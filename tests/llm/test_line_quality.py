import brute
import duckdb
from odd_rows import ODD_ROWS, rows_of

from jobtally.llm import line_quality as Q

LINES = [
    "A plain sentence with enough words to stand on its own, as most lines do.",
    "Home | News | About | Contact | Shop", "WOW!! BUY!! NOW!! AND!! THEN!!", "a### b*** c&&& d%%% e$$$", "Read more",
    "All rights reserved.", "Please enable JavaScript to see this page.", "", "   ", "no mark here at all but it is quite a long line of words",
    "same same same same same same same same", "Ends... then more.... and on.... and on....",
]


def made_rows():
    rows = [(i, "\n".join(LINES[j % len(LINES)] for j in range(i, i + 1 + i % 7))) for i in range(60)]
    rows += [(100 + i, " ".join(["loop", "de", "loop", str(i % 3)] * i)) for i in range(12)]
    rows += [(200, "the cat sat on the mat. " * 3 + "and then something else happened that day, to everyone's great surprise and joy."),
             (201, "one\x0btwo\x0cthree\rfour\tfive six seven eight nine ten."), (202, "a b c d\n \n" + "word " * 4)]
    return rows


def judged(df):
    return rows_of(Q.judge(df).select(
        "doc_id", "lq_words", "lq_word_chars", "lq_symbols", "lq_dup_lines", "lq_repeat_words", "lq_base_failed", "lq_kept", "lq_text"))


def test_equals_brute_force(spark, small):
    rows = made_rows() + [tuple(r) for r in small.select("doc_id", "text").collect()]
    got = judged(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == sorted(((i, *brute.quality(t)) for i, t in rows), key=repr)
    assert {r[6] for r in got} == {True, False} and {r[7] for r in got} == {True, False}


def test_equals_sql(spark):
    rows = made_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    sql = con.execute(Q.ORACLE).fetchall()
    assert sorted(sql) == sorted(r[:8] for r in judged(df))


def test_odd_rows_and_columns(odd, odd_wide, nothing):
    assert judged(odd) == sorted(((r[0], *brute.quality(r[1])) for r in ODD_ROWS), key=repr)
    out = Q.cleaned(odd_wide)
    assert out.columns == odd_wide.columns
    for r in out.collect():
        assert r["kept"] == "own" and r["n_chars"] == len(r["text"])
    assert judged(nothing) == [] and Q.cleaned(nothing).count() == 0


def test_native_plan(small):
    from jobtally.llm.syncmers import fingerprints

    for df in (Q.cleaned(small), fingerprints(small)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_clean_prose_stays(small, spark):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    rows = Q.judge(small).join(labels, "doc_id").where("not lq_base_failed").select("quality", "lq_kept").collect()
    assert all(r.lq_kept for r in rows if r.quality == 1)
    assert sum(r.lq_kept for r in rows if r.quality == 0) <= 1
