import re
import struct

import brute
import pytest
import xxhash
from odd_rows import ODD_ROWS
from pyspark.sql import functions as F

from jobtally.llm import syncmers as S


def long_hash(values):
    """The engine's hash of long values, one after the other."""
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest(struct.pack("<q", v), seed=h)
        v = h
    return struct.unpack("<q", struct.pack("<Q", h))[0]


def word_hash(word):
    return struct.unpack("<q", struct.pack("<Q", xxhash.xxh64_intdigest(word.encode(), seed=42)))[0]


def anchors(text, k=S.K, s=S.S):
    words = [word_hash(w) for w in re.findall(r"[^\x20\x09-\x0D]{1,%d}" % S.LONG_WORD, text)]
    whole = [long_hash(words) & 0xFFFFFFFF]
    if len(words) < k:
        return whole
    runs = [long_hash(words[i:i + s]) for i in range(len(words) - s + 1)]
    out = []
    for i in range(len(words) - k + 1):
        inner = runs[i:i + k - s + 1]
        if min(inner) in (inner[0], inner[-1]):
            out.append(long_hash(words[i:i + k]) & 0xFFFFFFFF)
    return out or whole


def dice(a, b):
    a, b = set(a), set(b)
    return 2 * len(a & b) / (len(a) + len(b))


def want(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0], r[1].encode()))
    out = []
    for n, (i, text) in enumerate(rows):
        follow = rows[(n + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + follow[:half]
        a, e = anchors(text), anchors(edited)
        out.append((i, len(text), brute.sha(edited.encode()), "".join(f"{x:08x}" for x in a), "".join(f"{x:08x}" for x in e),
                    dice(a, e), dice(a, anchors(follow))))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in S.fingerprints(df).collect()), key=repr)


def test_equals_brute_force(small, monkeypatch):
    rows = [tuple(r) for r in small.select("doc_id", "text").collect()]
    assert got(small) == want(rows)
    monkeypatch.setattr(S, "ROWS_PER_RANGE", 1)
    assert got(small) == want(rows)


def test_odd_rows(odd, odd_wide, nothing):
    expected = want([r[:2] for r in ODD_ROWS])
    assert got(odd) == expected and got(odd_wide) == expected
    assert got(nothing) == []


def test_single_row(spark):
    row = got(spark.createDataFrame([(5, "abcdef")], "doc_id long, text string"))
    assert row[0][2] == brute.sha(b"abcabc") and row[0][6] == 1.0


def test_uneven_ids(spark):
    rows = [(i, f"text {i} " * 5) for i in (0, 1, 2, 3, 4, 10**12, 10**15, -(10**14))]
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == want(rows)


def test_ranges_of_far_and_missing_ids(spark, monkeypatch):
    """Neither one far id nor missing ids gather the rows in one range."""
    near = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    far = spark.createDataFrame([(1 << 61, "far"), (-(1 << 61), "below")], near.schema)
    none = near.select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.md5(F.col("text")), F.lit(" x")).alias("text"))
    monkeypatch.setattr(S, "ROWS_PER_RANGE", 4)
    df = near.unionByName(far).unionByName(none)
    key = F.coalesce(F.col("doc_id"), F.lit(S._FIRST))
    number, _ = S._range(key, F.col("text"), df)
    sizes = df.groupBy((key == S._FIRST).alias("none"), number.alias("range")).count().collect()
    assert max(r["count"] for r in sizes) < 100 and min(sum(r.none for r in sizes), sum(not r.none for r in sizes)) > 200
    assert all((r.range < 0) == r.none for r in sizes)
    assert got(df) == want([tuple(r) for r in df.collect()])


def test_plan_without_hints(spark, small):
    """One shuffle of the texts for both uses of the ranges, and no broadcast that was asked for."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = S.with_next(small)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        final = plan.split("Initial Plan")[0]
        assert "BroadcastExchange" not in final and "Python" not in final and "ReusedExchange" in final, plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_anchor_survives_outside_edits(spark):
    """Every anchor whose words are untouched by an edit is found again."""
    words = [f"w{i * 7919 % 1009}" for i in range(200)]
    edited = words[:100] + ["new", "words"] + words[101:]
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(edited))], "doc_id long, text string")
    a, b = (r.a for r in df.orderBy("doc_id").select(S.anchors(df.text).alias("a")).collect())
    after = {(x.hash, x.position) for x in b}
    for x in a:
        if x.position + S.K <= 100:
            assert (x.hash, x.position) in after
        elif x.position > 100:
            assert (x.hash, x.position + 1) in after


def test_likeness_follows_share(spark, small):
    rows = S.fingerprints(small.where("n_chars > 400")).collect()
    assert sum(r.near_edited for r in rows) / len(rows) == pytest.approx(0.5, abs=0.08)
    assert sum(r.near_next > 0.2 for r in rows) <= 3
