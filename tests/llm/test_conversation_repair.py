"""Repairs against a brute-force search; the chunked runs against whole ones."""

import functools
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobtally.llm import conversation_repair as cr
from odd_rows import rows_of

SMALL = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
CHAR = re.compile(r"[^\x20\x09-\x0D]")


def spaced(v):
    return " " if v is None else v


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{spaced(conv)}:{spaced(turn)}".encode()) % 20
        role, text = spaced(role), spaced(text)
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv, turn, "user" if fault == 4 else role, text)] * {0: 0, 3: 2}.get(fault, 1)
    return out


def repair(rows, costs):
    rerole, delete, insert, cut = costs
    what = lambda r: hashlib.sha256(f"{len(r[2].encode())}:{r[2]}{r[3]}".encode()).digest()
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, what(r)))
    seen, faults = set(), []
    for _, _, role, text in rows:
        chars = CHAR.findall(text)
        faults.append("blank" if not chars else "again" if (role, text) in seen else "cut" if chars[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    after, to = {0: "su", 1: "u", 2: "a", 3: "u"}, {"s": 1, "u": 2, "a": 3}

    @functools.cache
    def best(i, state, inserts):
        ways = [(0, "")] if i == len(rows) and state in (0, 3) else []
        turn = after[state][-1]
        if i < len(rows):
            steps = [(delete, "D", state)]
            if faults[i] not in ("blank", "again"):
                more, initial = cut * (faults[i] == "cut"), rows[i][2][:1]
                steps.append((rerole + more, "R", to[turn]))
                if initial and initial in after[state]:
                    steps.append((more, "K", to[initial]))
            ways += [(c + best(i + 1, s, 0)[0], x + best(i + 1, s, 0)[1]) for c, x, s in steps]
        if inserts < 3:
            rest = best(i, to[turn], inserts + 1)
            ways.append((insert + rest[0], "I" + rest[1]))
        return min(ways, default=(10**9, "~"))

    for i in range(len(rows), -1, -1):  # keeps the recursion flat
        for s in range(4):
            best(i, s, 0)
    cost, audit = best(0, 0, 0)
    state, left, out = 0, iter(rows), []
    for x in audit:
        turn = after[state][-1]
        row = ("", "", "", "") if x == "I" else next(left)
        if x == "D":
            continue
        role = row[2] if x == "K" else {"u": "user", "a": "assistant"}[turn]
        state = to[role[:1]]
        out.append(f"{role}:{row[3]}")
    counts = tuple(faults.count(f) for f in ("blank", "again", "cut"))
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def brute(ids, rows, costs=(1, 2, 5, 5)):
    by = {i: [] for i in ids}
    for r in rows:
        by[r[0]].append((r[0], r[1], spaced(r[2]), spaced(r[3])))
    return sorted(((i, *repair(v, costs)) for i, v in by.items()), key=repr)


def odd_rows():
    rng = random.Random(3)
    roles = [None, "user", "assistant", "system", "", "uncle", "Assistant"]
    texts = [None, "", " \t", "a.", "b", "c! ", "d?\n", "e", "f…", *(f"{i}." for i in range(8))]
    rows = [(rng.choice([None, -3, 0, 1, 2, 5]), rng.choice([None, *range(30)]), rng.choice(roles), rng.choice(texts)) for _ in range(150)]
    rows += rows[:10]
    rows += [(77, i, rng.choice(["user", "assistant", "assistant", "system"]), f"t{i}" + rng.choice([".", ""])) for i in range(120)]
    rows += [(78, i, "user", f"t{i}") for i in range(60)]  # vectors that never meet
    rows += [(79, i, "assistant", "same.") for i in range(60)] + [(80, i, "", "x" * 100_000) for i in range(2)]
    return rows


# chunk 5 with 0 passes: maps; with 100: fix-up passes only. Low insert costs: audits with I
@pytest.mark.parametrize("costs, chunk, passes", [
    ((1, 2, 5, 5), cr.CHUNK, 4), ((1, 2, 5, 5), 5, 100), ((3, 4, 1, 2), 5, 1), ((1, 9, 1, 1), 7, 0), ((2, 5, 2, 1), cr.CHUNK, 4)])
def test_odd_rows(spark, costs, chunk, passes):
    rows = odd_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = rows_of(cr.repair(df, cr.Costs(*costs), chunk, passes))
    assert got == brute({r[0] for r in rows}, rows, costs)


def test_damaged(spark):
    df = spark.read.parquet(f"{SMALL}/conversations.parquet").unionByName(spark.createDataFrame(odd_rows(), SCHEMA))
    rows = [tuple(r) for r in df.collect()]
    assert rows_of(cr.repair(cr.damaged(df))) == brute({r[0] for r in rows}, damage(rows))


def test_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert rows_of(cr.repair(cr.damaged(empty))) == []
    none = spark.createDataFrame([(1, 2, "user", "a")], SCHEMA).withColumn("copies", F.lit(0))
    assert rows_of(cr.repair(none)) == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    ends = [((1 << 63) - 1, -(1 << 63), "user", "a."), ((1 << 63) - 1, (1 << 63) - 1, "assistant", "b."), (None, 3, None, None)]
    df = spark.createDataFrame(ends, SCHEMA).withColumns({c: F.lit("own") for c in ("conv", "kind", "part", "blank", "at", "state", "letters")})
    got = {r["conv_id"]: r for r in cr.repair(df).collect()}
    assert got[(1 << 63) - 1]["gaps"] is None and got[(1 << 63) - 1]["audit"] == "KK" and got[None]["audit"] == "D"


def test_long_conversation_in_many_ranges(spark):
    """One conversation over 16 ranges: adjacent roles across their borders, chunks that follow each other."""
    rng = random.Random(1)
    rows = [(5, t, rng.choice(["user", "assistant"]), f"t{t}{rng.choice('.. ')}") for t in range(3000)]
    wide = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in wide}
    for k, v in wide.items():
        spark.conf.set(k, v)
    try:
        got = rows_of(cr.repair(spark.createDataFrame(rows, SCHEMA), chunk=50))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == brute({5}, rows)


@pytest.mark.parametrize("seed", range(6))
def test_rerun_stops_where_vectors_differ_by_a_constant(seed):
    rng = np.random.default_rng(seed)
    costs = cr.Costs()
    kinds = [rng.integers(0, 8, int(n)) for n in rng.integers(1, 200, 20)]
    rows = cr._padded(kinds)
    used, end = np.tile(costs.end, (20, 1)), rng.integers(0, 9, (20, 4))
    start, took = cr.rerun(costs, kinds, used, cr.backward(costs, rows, used), end)
    whole = cr.backward(costs, rows, end)
    assert (start == whole).all() and (took <= [len(k) for k in kinds]).all()
    assert took.sum() < sum(map(len, kinds)) / 2  # most of the old runs hold


def test_sql_holds_for_more_conversations(spark):
    """The twin over a larger table: repeated rows beside their copies."""
    import duckdb

    path = "/root/testdata/sf0.01/conversations.parquet"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{path}')")
    rows = [tuple(r) for r in spark.read.parquet(path).collect()]
    assert sorted(con.execute(cr.ORACLE).fetchall(), key=repr) == brute({r[0] for r in rows}, damage(rows))
