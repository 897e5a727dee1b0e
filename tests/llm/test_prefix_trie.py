"""The prefix trie against a brute-force version; the decomposition against plain sums."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from jobtally.llm import prefix_trie
from odd_rows import rows_of

SMALL = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"


def decimal(c):
    return "" if c is None else str(c)


def brute(rows):
    def what(row):
        role, text = row[2] or "", row[3] or ""
        return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()

    own = {}
    for row in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, what(r))):
        own.setdefault(row[0], []).append((row[2] or "", row[3] or ""))
    place = lambda c: float("inf") if c is None else c
    rebuilt = {}
    for c, turns in own.items():
        h = 0 if c is None else zlib.crc32(decimal(c).encode()) % 6
        base = c if c is None else c - abs(c) % 100 * (1 if c >= 0 else -1)
        rebuilt[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    first = {n: min(m, key=place) for n, m in members.items()}
    children = dict.fromkeys(members, 0)
    for n in members:
        if n:
            children[n[:-1]] += 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for n, m in members.items():
        for d in range(len(n) + 1):
            leaves[n[:d]] += children[n] == 0
            saved[n[:d]] += (len(m) - 1) * len(n[-1][1]) if n else 0
    out = []
    for n, m in members.items():
        ends = ",".join(map(decimal, sorted((c for c in m if len(rebuilt[c]) == len(n)), key=place)))
        out.append((first[n], len(n), first[n[:-1]] if n else None, len(m), children[n], leaves[n], saved[n], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def mixed_rows():
    rng = random.Random(3)
    ids = [None, -103, -3, 0, 1, 2, 5, 7, 100, 101, 102, 103, 104, 203, 299, 307]
    rows = [(rng.choice(ids), rng.choice([None, *range(12)]), rng.choice([None, "user", "a"]), rng.choice([None, "", "x", "yö\U0001f600"]))
            for _ in range(300)]
    rows += rows[:5]
    # one long path with a branch at every depth, and many equal conversations
    rows += [(900 + i, t, "user", f"t{t if t < i else 0}") for i in range(30) for t in range(50)]
    rows += [(2000 + 100 * i, t, "user", "same") for i in range(60) for t in range(3)]
    return rows


# 40: the components are split by joins, in several rounds
@pytest.mark.parametrize("local", [prefix_trie.LOCAL, 40])
def test_mixed(spark, local):
    rows = mixed_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert rows_of(prefix_trie.prefix_trie(df, local)) == brute(rows)


def test_shuffled_joins(spark, monkeypatch):
    """Tables too large to broadcast give the same."""
    monkeypatch.setattr(prefix_trie, "BROADCAST_ROWS", 0)
    df = spark.read.parquet(f"{SMALL}/conversations.parquet")
    assert rows_of(prefix_trie.prefix_trie(df, 10)) == brute([tuple(r) for r in df.collect()])


def test_long_conversation_over_many_ranges(spark):
    """One conversation holds nearly all rows: its places and names come from several ranges."""
    rows = [(5, t, "user", f"t{t % 7}") for t in range(4000)] + [(105, t, "user", f"t{t % 7}" if t < 3000 else "z") for t in range(3500)]
    df = spark.createDataFrame(rows, SCHEMA)
    wide = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in wide}
    for k, v in wide.items():
        spark.conf.set(k, v)
    try:
        named = prefix_trie.paths(prefix_trie.with_shared_heads(prefix_trie.turns(df, None), None)).cache()
        got = rows_of(named.groupBy("x", "y", "depth").count().groupBy("count").count())
        h5, h105 = (zlib.crc32(c) % 6 for c in (b"5", b"105"))
        a = tuple(t % 7 for t in range(h5, 4000))
        b = tuple(t % 7 if t < 3000 else -1 for t in range(h105, 3500))
        both = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))) + 1
        assert got == sorted([(1, len(a) + len(b) + 2 - 2 * both), (2, both)], key=repr)
        assert rows_of(prefix_trie.prefix_trie(df, 1000))[0][0] == 105 and prefix_trie.prefix_trie(df, 1000).count() == len(a) + len(b) + 2 - both
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert rows_of(prefix_trie.prefix_trie(empty)) == []
    rows = [(None, None, None, None), (None, 0, "", ""), ((1 << 63) - 1, 1, "user", "x" * 200_000), (7, 0, "user", "a"), (7, 0, "user", "a")]
    df = spark.createDataFrame(rows, SCHEMA)
    from pyspark.sql import functions as F

    got = prefix_trie.prefix_trie(df.withColumns({c: F.lit("own") for c in ("conv", "depth", "part", "own", "c", "x", "chars")}))
    assert got.count() == prefix_trie.prefix_trie(df).count() > 0
    rows = rows[:2] + rows[3:]
    assert rows_of(prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    only = [(None, 1, "a", "b"), (None, 2, "a", "b")]
    assert rows_of(prefix_trie.prefix_trie(spark.createDataFrame(only, SCHEMA))) == brute(only)


@pytest.mark.parametrize("seed", range(8))
def test_decompose(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 400))
    parent = np.array([-1 if i == 0 or rng.random() < 0.02 else i - 1 if seed % 2 else int(rng.integers(0, i)) for i in range(n)])
    top, depth = np.arange(n), np.zeros(n, np.int64)
    for i in range(n):
        if parent[i] >= 0:
            top[i], depth[i] = top[parent[i]], depth[parent[i]] + 1
    weight, values = rng.integers(1, 9, n), rng.integers(-5, 50, (n, 2))
    want = values.copy()
    for i in range(n - 1, -1, -1):
        if parent[i] >= 0:
            weight[parent[i]] += weight[i]
            want[parent[i]] += want[i]
    assert (prefix_trie.decompose(top, parent, depth, weight, values) == want).all()


def test_pieces_of_ends(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 4)
    ends = spark.createDataFrame([(1, 2, i) for i in range(50)] + [(3, 0, 99)], "c long, depth long, conv long").repartition(4)
    want = {(1, 2, hashlib.sha256(",".join(map(str, range(50))).encode()).hexdigest()), (3, 0, hashlib.sha256(b"").hexdigest())}
    assert {tuple(r) for r in prefix_trie.joined_ids(ends, 99).collect()} == want
