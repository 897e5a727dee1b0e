import datetime as dt

import duckdb
import pytest
from odd_rows import rows_of
from pyspark.sql import functions as F

from jobtally.llm import revisits as R

SCHEMA = "record_id long, url string, date timestamp, kind string, status int, headers map<string,string>, digest string"


def at(hour):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=hour)


def record(i, url, hour, kind, status=200, digest=None, **headers):
    named = {k.replace("_", "-"): v for k, v in headers.items()}
    return (i, url, None if hour is None else at(hour), kind, status, named, digest)


RECORDS = [
    record(1, "http://A.org/x", 0, "response", etag='"1"', server="s", vary="a", digest="d1"),
    record(2, "https://www.a.org:443/x/#top", 30, "revisit", 304, etag='W/"1"', cache_control="c", set_cookie="no", vary="b"),
    record(3, "http://a.org/x", 40, "response", 200, etag='"2"', digest="d3"),
    record(4, "http://a.org/x", 40, "revisit", 304, etag='"2"'),
    record(5, "http://a.org/x", 50, "response", 404, etag='"2"', digest="d5"),
    record(6, "http://a.org/x", 60, "revisit", 304, etag='"1"'),
    record(7, "http://a.org/x", -5, "revisit", 304, etag='"1"'),
    record(8, "http://b.org", 1, "response", last_modified="m", digest="d8"),
    record(9, "http://b.org/?utm_source=q&sid=3", 900, "revisit", 304, last_modified="m"),
    record(10, "http://b.org/", 901, "revisit", 304),
    record(11, None, 3, "revisit", 304), record(12, "http://b.org/", None, "revisit", 304),
    record(13, "http://c.org/q?b=2&a=1", 5, "response", etag="x", digest="d13"),
    record(14, "http://c.org/q?a=1&b=2&", 5, "revisit", 304, etag="x"),
    record(3, "http://a.org/x", 40, "response", 200, etag='"2"', digest="d3"),
    record(9, "http://b.org/?utm_source=q&sid=3", 900, "revisit", 304, last_modified="m"),
    (15, "http://c.org/q?a=1&b=2", at(7), "revisit", 304, None, None),
]

WANT = {
    2: ("resolved", 1, "d1", {"etag": 'W/"1"', "server": "s", "vary": "b", "cache-control": "c"}),
    4: ("resolved", 3, "d3", {"etag": '"2"'}), 6: ("changed", 3, None, None), 7: ("no_response", None, None, None),
    9: ("resolved", 8, "d8", {"last-modified": "m"}), 10: ("unverified", 8, None, None),
    11: ("no_response", None, None, None), 12: ("no_response", None, None, None),
    14: ("resolved", 13, "d13", {"etag": "x"}), 15: ("unverified", 13, None, None),
}


@pytest.mark.parametrize("seconds", [R.SLICE_SECONDS, 3600, 10**9])
def test_cases(spark, seconds):
    out = R.resolve(spark.createDataFrame(RECORDS, SCHEMA), seconds).collect()
    assert sorted(r.record_id for r in out) == [2, 4, 6, 7, 9, 9, 10, 11, 12, 14, 15]
    for r in out:
        assert (r.outcome, r.response_id, r.response_digest, r.merged_headers) == WANT[r.record_id], r


def test_hot_address(spark):
    """One address with most of the captures, against a plain walk through time."""
    rows, last, want = [], None, {}
    for i in range(600):
        url = "http://hot.org/" if i % 3 else f"http://h{i % 7}.org/"
        if i % 5 == 0:
            rows.append(record(i, url, i, "response", etag=str(i), digest=str(i)))
        else:
            rows.append(record(i, url, i, "revisit", 304, etag="?"))
    latest = {}
    for r in rows:
        if r[3] == "response":
            latest[r[1]] = r[0]
        else:
            want[r[0]] = latest.get(r[1])
    out = R.resolve(spark.createDataFrame(rows, SCHEMA).repartition(4), 36_000).collect()
    assert {r.record_id: r.response_id for r in out} == want


def test_empty_table_and_other_columns(spark):
    df = spark.createDataFrame(RECORDS, SCHEMA)
    assert R.resolve(df.limit(0)).count() == 0
    out = R.resolve(df.withColumns({"slice": F.lit("own"), "of": F.lit("own"), "stored": F.lit("own")}))
    assert {(r.record_id, r.outcome) for r in out.collect()} == {(i, w[0]) for i, w in WANT.items()}
    assert {r.response_slice for r in out.collect()} == {"own", None}


def test_repeated_record_ids(spark):
    """Responses of one record_id: the matched one, by date and URL, lends its columns; of rows equal in these the first."""
    rows = [
        record(1, "http://a.org", 0, "response", etag="1", digest="a"), record(1, "http://b.org", 0, "response", etag="1", digest="b"),
        record(1, "http://a.org", 9, "response", etag="1", digest="late"), record(2, "http://a.org", 5, "revisit", 304, etag="1"),
        record(3, "http://b.org", 5, "revisit", 304, etag="1"), record(4, "http://a.org", 10, "revisit", 304, etag="1"),
        record(5, "http://c.org", 0, "response", etag="1", digest="x"), record(5, "http://c.org", 0, "response", etag="1", digest="y"),
        record(6, "http://c.org", 1, "revisit", 304, etag="1"), record(None, "http://d.org", 0, "response", etag="1"),
        record(7, "http://d.org", 1, "revisit", 304, etag="1"), record(None, "http://a.org", 6, "revisit", 304, etag="1", digest="own"),
    ]
    seen = set()
    for parts in (1, 5):
        for order in (rows, rows[::-1]):
            out = R.resolve(spark.createDataFrame(order, SCHEMA).repartition(parts)).collect()
            found = {r.record_id: r.response_digest for r in out}
            assert len(out) == 6 and (found[2], found[3], found[4], found[7], found[None]) == ("a", "b", "late", None, "a")
            seen.add(found[6])
    assert len(seen) == 1 and seen < {"x", "y"}


def test_taken_names(spark):
    df = spark.createDataFrame(RECORDS, SCHEMA).withColumns({c: F.lit(c) for c in ("id", "canonical_url", "row", "salt", "a.b")})
    out = R.resolve(df).where("record_id = 2").first()
    assert (out["response_id"], out["response_id_"], out["response_canonical_url"], out["response_row"]) == (1, "id", "canonical_url", "row")
    assert out["canonical_url"] == "a.org/x" and out["response_a.b"] == "a.b"


def test_hot_response_is_dealt(spark):
    """The revisits of one response meet it in many tasks, once per salt."""
    hot = spark.range(20_000).select(
        (F.col("id") + 10).alias("record_id"), F.lit("http://hot.org").alias("url"),
        F.timestamp_seconds(F.col("id") + 1_700_000_001).alias("date"), F.lit("revisit").alias("kind"), F.lit(304).alias("status"),
        F.create_map(F.lit("etag"), F.lit("1")).alias("headers"), F.lit(None).cast("string").alias("digest"))
    one = spark.createDataFrame([record(1, "http://hot.org", 0, "response", etag="1", digest="d")], SCHEMA)
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k, v in zip(old, ("16", "false", "-1")):
            spark.conf.set(k, v)
        out = R.resolve(hot.unionByName(one.withColumn("date", F.timestamp_seconds(F.lit(1_700_000_000)))))
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 20_000 and len(sizes) == 16 and max(sizes) < 4_000
        assert out.where("response_digest = 'd'").count() == 20_000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_captures_equal_sql(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    odd = [(900, None, "x"), (901, "", None), (902, "http://q.org/é?z=1&a", "ü"), (902, "http://q.org/é?z=1&a", "ü")]
    for df in (pages, spark.createDataFrame(odd[:3], pages.schema)):
        con = duckdb.connect()
        con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
        con.executemany("INSERT INTO pages VALUES (?, ?, ?)", [tuple(r) for r in df.collect()])
        out = R.resolve(R.captures(df)).select(
            "record_id", "url", "canonical_url", F.unix_seconds("date"), "outcome", "response_id",
            R.header_lines(F.col("merged_headers")), "response_digest")
        assert rows_of(out) == sorted(con.execute(R.ORACLE).fetchall(), key=repr)
    assert R.resolve(R.captures(spark.createDataFrame(odd, pages.schema))).count() == 4
