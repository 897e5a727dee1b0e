"""SimHash groups against a brute-force version; the index against all pairs."""

import re

import numpy as np
import pytest
import xxhash

from jobtally.llm import gray_index
from jobtally.llm.queries import QUERIES
from odd_rows import rows_of

SMALL = "/root/testdata/sf0.001"


def fingerprint(text, size=4):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + size]), seed=42) for i in range(max(1, len(words) - size + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(codes, distance):
    """Smallest id reachable of each (id, code); ids may be null."""
    label = list(range(len(codes)))
    for i, (_, a) in enumerate(codes):
        for j in range(i):
            if (a ^ codes[j][1]).bit_count() <= distance and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {x: min((i for (i, _), y in zip(codes, label) if y == x and i is not None), default=None) for x in label}
    return sorted(((i, c, least[x]) for (i, c), x in zip(codes, label)), key=repr)


@pytest.mark.parametrize("seed", range(12))
def test_index_finds_all_pairs(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 600))
    codes = rng.integers(0, 2**63, 8, dtype=np.uint64)[rng.integers(0, 8, n)]
    for _ in range(int(rng.integers(1, 6))):
        codes = codes ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))
    codes, bucket = np.unique(codes), None
    bucket = np.sort(rng.integers(0, 4, len(codes)))
    for k in range(4):
        at = np.flatnonzero(bucket == k)
        codes[at] = codes[at][gray_index._gray_order(codes[at])]
    labels = rng.integers(0, 3, len(codes)) if seed % 2 else None
    got = [p for x, y in gray_index.linked_pairs(codes, bucket, 4, labels) for p in zip(x.tolist(), y.tolist())]
    want = {(i, j) for j in range(len(codes)) for i in range(j) if bucket[i] == bucket[j]
            and int(codes[i] ^ codes[j]).bit_count() <= 4 and (labels is None or labels[i] != labels[j])}
    assert len(got) == len(set(got)) and set(got) == want
    if labels is None:
        least, far = gray_index.stars(codes, gray_index.linked_pairs(codes, bucket, 4))
        label = {i: i for i in range(len(codes))} | dict(zip(far.tolist(), least.tolist()))
        assert all(label[i] == label[j] for i, j in want) and all(label[label[i]] == label[i] <= i for i in label)


def test_upper_nodes_hold_shared_bits():
    codes = np.unique(np.random.default_rng(0).integers(0, 256, 200, dtype=np.uint64))
    codes = codes[gray_index._gray_order(codes)]
    levels = gray_index.hierarchy(codes, np.zeros(len(codes), np.int64), np.full(len(codes), -1))
    # the 56 zero bits are kept once, at the top; over all levels each code has each bit once
    assert levels[-1].mask[0] & ~np.uint64(255) == ~np.uint64(255)
    node, bits = np.arange(len(codes)), np.zeros(len(codes), np.uint64)
    for low, high in zip(levels, levels[1:] + [None]):
        assert not (bits & low.pattern[node]).any()
        bits |= low.pattern[node]
        if high is not None:
            node = np.searchsorted(high.begin, node, side="right") - 1
    assert (bits == codes).all()


@pytest.mark.parametrize("text", ["", " ", "One two", "a b\tc\n\n d  E f ", "  lead and trail \r\n", "Ünï cöde \U0001f600 x y z", "a\0b c d e f"])
def test_shingles(text):
    got = gray_index.simhashes(iter([b"x y z w v", text.encode(), b""]), 4)
    assert got.tolist() == [fingerprint("x y z w v"), fingerprint(text), 0]


def test_long_text_in_parts(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(5000))
    monkeypatch.setattr(gray_index, "PART", 64)
    assert gray_index.simhashes(iter([b"a b c d", text.encode(), b"e"]), 4).tolist() == [fingerprint(t) for t in ("a b c d", text, "e")]


# small blocks and a wide distance: buckets lie in many blocks, which meet in pairs
@pytest.mark.parametrize("distance, block", [(4, 4096), (10, 3), (0, 2), (13, 16)])
def test_groups(spark, small, odd, distance, block):
    docs = small.select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    got = [(i, c % 2**64, r) for i, c, r in rows_of(gray_index.near_duplicates(docs, distance=distance, block=block))]
    assert sorted(got, key=repr) == groups([(r.doc_id, fingerprint(r.text)) for r in docs.collect()], distance)


def test_more_columns_and_no_rows(spark, odd, odd_wide, nothing):
    assert rows_of(gray_index.near_duplicates(odd)) == rows_of(gray_index.near_duplicates(odd_wide))
    assert rows_of(gray_index.near_duplicates(nothing)) == []


def test_large_group_leaves_stars_only(spark):
    """2,000 codes of one component: a link row per code and block at most, not one per pair."""
    rng = np.random.default_rng(5)
    codes = np.unique(sum((np.uint64(1) << rng.integers(0, 64, 4000).astype(np.uint64)) for _ in range(2)))[:2000]
    df = spark.createDataFrame([(int(c),) for c in codes.view(np.int64)], "code long").repartition(3)
    pieces = gray_index.blocks(df, 4, 256).cache()
    links = gray_index.links_inside(pieces, 4)
    assert links.count() <= 5 * len(codes)
    labels = gray_index.components(links)
    assert labels.select("label").distinct().count() == 1
    assert gray_index.links_between(pieces, labels, 4).count() == 0


def test_query(spark):
    out = QUERIES["op13_simhash"](spark, SMALL)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    want = groups([(r.doc_id, fingerprint(r.text)) for r in docs], 4)
    assert sorted(tuple(r) for r in out.collect()) == sorted((i, f"{c:016x}", r) for i, c, r in want)
