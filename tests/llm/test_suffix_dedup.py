import brute
import numpy as np
import pytest

from jobtally.llm import suffix_dedup as S
from odd_rows import ODD_ROWS, rows_of


def brute_force(rows):
    found = brute.remove_repeats(rows)
    sizes = [len((t or "").encode()) for _, t in brute.ordered(rows)]
    return sorted(((i, n, gone, spans, brute.sha(kept)) for (i, kept, gone, spans), n in zip(found, sizes)), key=repr)


def removed(docs, **more):
    out = S.remove_repeats(docs, **more)
    return rows_of(out.selectExpr("doc_id", "sd_bytes", "sd_removed", "bigint(size(sd_begin))", "sd_sha256"))


@pytest.mark.parametrize("more", [{}, {"block_bytes": 20_000}, {"block_bytes": 20_000, "hot": 3}])
def test_equals_brute_force(small, more):
    rows = [tuple(r) for r in small.select("doc_id", "text").collect()]
    got = removed(small.select("doc_id", "text"), **more)
    assert got == brute_force(rows)
    assert sum(r[2] for r in got) > 0


@pytest.mark.parametrize("more", [{}, {"block_bytes": 2_000, "hot": 2}])
def test_odd_rows(odd, more):
    assert removed(odd, **more) == brute_force([r[:2] for r in ODD_ROWS])


def test_shared_passages_many_groups(spark):
    rng = np.random.default_rng(5)
    passages = ["".join(rng.choice(list("abcdefgh "), size=n)) for n in (99, 100, 101, 163, 164, 400, 1500)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(4):
            parts.append(passages[rng.integers(len(passages))])
            parts.append("".join(rng.choice(list("xyz "), size=int(rng.integers(1, 130)))))
        rows.append((i, "".join(parts)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for more in ({}, {"block_bytes": 3_000}, {"block_bytes": 3_000, "hot": 4}):
        assert removed(docs, **more) == brute_force(rows)


def test_empty_table_and_clashing_columns(nothing, odd_wide):
    assert removed(nothing) == []
    names = odd_wide.columns
    out = S.deduplicated(odd_wide)
    assert out.columns == names
    got = out.collect()
    assert {r["block"] for r in got} == {"own"}
    assert all(r["n_chars"] == len(r["text"] or "") for r in got)


def test_cut_text_is_valid(spark):
    text = "é" * 200
    rows = S.deduplicated(spark.createDataFrame([(1, text), (2, "a" + text + "b")], "doc_id long, text string")).collect()
    by = {r.doc_id: r.text for r in rows}
    # inside the first text itself the string repeats from its second character on
    assert by[2] == "ab" and by[1].strip("é") == ""


def test_suffix_order_sorts_like_bytes():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 4000).astype(np.uint8)
    data[2000:3000] = data[:1000]
    start = rng.permutation(3800)[:700]
    length = np.full(len(start), 150)
    group = rng.integers(0, 5, len(start))
    hashes = S.Hashes(data)
    got = S.suffix_order(data, hashes, start, length, group)
    text = data.tobytes()
    want = sorted(range(len(start)), key=lambda i: (group[i], text[start[i]:start[i] + 150]))
    key = lambda i: (group[i], text[start[i]:start[i] + 150])
    assert [key(i) for i in got] == [key(i) for i in want]


def test_common_extension():
    data = np.frombuffer(b"abcabcabdabc", np.uint8)
    hashes = S.Hashes(data)
    got = S.common_extension(hashes, np.array([0, 0, 3]), np.array([3, 9, 6]), np.array([5, 3, 5]))
    assert got.tolist() == [5, 3, 2]
