import random

import brute
import numpy as np
import pytest
from odd_rows import ODD_ROWS, rows_of
from pyspark.sql import functions as F

from jobtally.llm import near_dedup as N


def found(docs, size, percent):
    out = N.near_duplicates(docs, size, percent)
    return rows_of(out.select("doc_id", "n_shingles", "component_id", "kept"))


def want(rows, size, percent):
    sets = {i: brute.shingle_set(t, size) for i, t in rows}
    labels = brute.components(sets, percent)
    return sorted(((i, len(sets[i]), labels[i], labels[i] == i) for i, _ in rows), key=repr)


def near_rows(n=150, seed=3):
    """Chains of edits, so that the ends of a component are far apart, and unrelated texts."""
    rng = random.Random(seed)
    rows, i = [], 0
    while len(rows) < n:
        words = [f"w{rng.randrange(4000)}" for _ in range(rng.choice((3, 12, 60, 200)))]
        for _ in range(rng.choice((1, 2, 8))):
            rows.append((i, " ".join(words)))
            i += rng.randrange(1, 4)
            for _ in range(max(1, len(words) // 60)):
                words[rng.randrange(len(words))] = f"w{rng.randrange(4000)}"
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_equals_brute_force(spark, small, size, percent):
    rows = [tuple(r) for r in small.select("doc_id", "text").collect()]
    assert found(small, size, percent) == want(rows, size, percent)
    made = near_rows()
    got = found(spark.createDataFrame(made, "doc_id long, text string"), size, percent)
    assert got == want(made, size, percent)
    assert any(not r[3] for r in got)


def test_bucket_that_one_star_leaves_open(spark):
    """Texts alike in pairs only: the smallest is linked to none, the others to each other."""
    base = [f"a{i}" for i in range(300)]
    first = base[:210] + [f"b{i}" for i in range(90)]
    rows = [(0, " ".join(first))]
    for k in range(1, 40):
        words = list(base)
        words[k * 7] = f"c{k}"
        rows.append((k, " ".join(words)))
    got = found(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85)
    assert got == want(rows, 3, 85)
    assert sum(r[3] for r in got) == 2


def test_odd_rows(odd, odd_wide):
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in N.near_duplicates(odd, 3, 85).collect()}
    long_text = len(brute.shingle_set(ODD_ROWS[4][1], 3))
    assert got[(3, 0)] == (3, True) and got[(1, 0)] == (1, True) and got[(2, 0)] == (2, True)
    assert got[(4, long_text)] == (4, True) and got[(7, long_text)] == (4, False)
    assert got[(None, 0)] == (None, True)
    kept = N.one_of_each(odd_wide)
    assert kept.columns == odd_wide.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [-4, 1, 2, 3, 4, 5, 7, 8, 9]
    assert ids.count(None) == 2


def test_no_unique_text_is_dropped(spark):
    """Rows that share an id are judged by their own texts; near copies without ids are linked."""
    words = [f"w{i}" for i in range(100)]
    text, near, other = " ".join(words), " ".join(words[:60] + ["x"] + words[61:]), " ".join(f"v{i}" for i in range(100))
    rows = [(1, text), (2, text), (2, other), (3, near)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, N.one_of_each(df).collect())) == sorted([(1, text), (2, other)])
    got = {(r.doc_id, r.component_id, r.kept) for r in N.near_duplicates(df).collect()}
    assert got == {(1, 1, True), (2, 1, False), (2, 2, True), (3, 1, False)}
    df = spark.createDataFrame([(None, text), (None, near), (None, near), (None, other)], "doc_id long, text string")
    left = [r.text for r in N.one_of_each(df).collect()]
    assert len(left) == 2 and other in left
    df = spark.createDataFrame([(None, text), (5, near), (9, other)], "doc_id long, text string")
    assert sorted(map(tuple, N.one_of_each(df).collect())) == [(5, near), (9, other)]
    df = spark.createDataFrame([(1, text), (1, other), (1, text)], "doc_id long, text string")
    assert sorted(map(tuple, N.one_of_each(df).collect())) == sorted([(1, text), (1, other)])


def test_empty_table(nothing):
    assert found(nothing, 5, 80) == []
    assert N.one_of_each(nothing).count() == 0


def test_sketch_keeps_linked_pairs(spark):
    """Sketches of pairs at the limit stay inside it; of pairs well below they do not."""
    rng = random.Random(1)
    signer = N.Signer(1, 4)

    def sketched(a, b):
        (n, _, _, x), (m, _, _, y) = (signer(" ".join(s).encode()) for s in (a, b))
        bits = sum((p ^ q).bit_count() for p, q in zip(*(np.array(v, np.int64).view(np.uint64).tolist() for v in (x, y))))
        return n, m, bits

    at_limit, below = [], []
    for n in (7, 20, 100, 600, 4000, 30_000):
        for _ in range(12):
            words = [f"w{rng.randrange(10**9)}" for _ in range(n)]
            # replacing r words of n leaves (n - r) / (n + r) in common
            for rows, share in ((at_limit, 0.85), (below, 0.65)):
                r = int(n * (1 - share) / (1 + share))
                rows.append(sketched(words, words[r:] + [f"v{rng.randrange(10**9)}" for _ in range(r)]))
    sizes = {x[:2] for x in at_limit + below}
    limits = {k: spark.range(1).select(N.sketch_limit(F.lit(k[0]), F.lit(k[1]), 85)).first()[0] for k in sizes}
    assert all(bits <= limits[n, m] for n, m, bits in at_limit)
    assert all(bits > limits[n, m] for n, m, bits in below if 100 <= n <= 4000)  # sketches of larger sets fill up


@pytest.mark.parametrize("percent", [80, 85])
def test_sketch_keeps_small_sets_at_the_limit(spark, percent):
    """Tens of thousands of pairs exactly at the limit, where few samples flip two bits."""
    rng, rows = np.random.default_rng(5), []
    for union in (20, 40, 60, 80, 100, 120):
        gap = union * (100 - percent) // 100
        assert gap * 100 == union * (100 - percent)
        for _ in range(12_000):
            h = rng.integers(0, 1 << 63, union).astype(np.uint64)
            own = rng.integers(0, gap + 1)  # elements of the first set alone, then of the second alone
            a, b = np.concatenate([h[:own], h[gap:]]), h[own:]
            if min(len(a), len(b)) * 100 >= max(len(a), len(b)) * percent:
                bits = int(np.bitwise_count((N.Signer.sketch(a) ^ N.Signer.sketch(b)).view(np.uint64)).sum())
                rows.append((len(a), len(b), bits))
    assert len(rows) > 50_000
    sizes = spark.createDataFrame(sorted({r[:2] for r in rows}), "a long, b long")
    limits = {(r.a, r.b): r.most for r in sizes.select("a", "b", N.sketch_limit(F.col("a"), F.col("b"), percent).alias("most")).collect()}
    lost = [r for r in rows if r[2] > limits[r[:2]]]
    assert not lost, f"{len(lost)} of {len(rows)}"


def test_open_buckets_in_pieces(spark, monkeypatch):
    """Rows of small buckets are moved once a side; large buckets are compared piece by piece, with the same links."""
    nodes = spark.range(60).selectExpr(
        "id AS node", "10L AS n", "transform(sequence(1, 32), x -> 0L) AS sketch", "array(7L + id % 20, 100L) AS bands")
    small_buckets = nodes.select((7 + F.col("node") % 20).alias("key"), "node")
    none = spark.createDataFrame([], "node long, label long")
    dealt = N._dealt(small_buckets, nodes, none).collect()
    assert len(dealt) == 60 + 40  # two of three nodes lie outside the largest component
    monkeypatch.setattr(N, "PIECE", 8)
    whole = nodes.select(F.lit(100).cast("long").alias("key"), "node")
    units = N._dealt(whole, nodes, none).groupBy("key", "i", "j", "side").count().collect()
    assert len({(r.i, r.j) for r in units}) == 64 and max(r["count"] for r in units) < 32
    got = {tuple(r) for r in N._remaining(whole.unionByName(small_buckets), nodes, none, 85).collect()}
    assert got == {(a, b) for a in range(60) for b in range(a + 1, 60)}
    made = near_rows(200, 8)
    assert found(spark.createDataFrame(made, "doc_id long, text string"), 3, 85) == want(made, 3, 85)


def test_limit_of_arrays_is_that_of_columns(spark):
    sizes = [(a, b) for a in (1, 5, 90, 3000, 40_000) for b in (1, 6, 100, 3100, 41_000)]
    df = spark.createDataFrame(sizes, "a long, b long")
    for percent in (80, 85, 100):
        here = N.sketch_limit(*np.array(sizes, np.int64).T, percent, N._ARRAYS)
        there = {(r.a, r.b): r.most for r in df.select("a", "b", N.sketch_limit(F.col("a"), F.col("b"), percent).alias("most")).collect()}
        assert here.tolist() == pytest.approx([there[s] for s in sizes])


def test_near_copies_leave_few_pairs(spark, monkeypatch):
    """A group whose members are linked to some of the others only: most of it is joined before pairs are listed."""
    rng = random.Random(4)
    base = [f"a{i}" for i in range(120)]
    rows = []
    for k in range(160):
        words = list(base)
        for at in rng.sample(range(120), rng.choice((2, 3, 4, 5))):
            words[at] = f"c{k}x{at}"
        rows.append((k, " ".join(words)))
    listed = []
    monkeypatch.setattr(N, "_remaining", lambda *a, real=N._remaining: (out := real(*a), listed.append(out.count()))[0])
    got = found(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85)
    assert got == want(rows, 3, 85)
    assert sum(not r[3] for r in got) > 20 and listed[0] < 10 * len(rows), listed
