import brute
import pytest
from odd_rows import ODD_ROWS

from jobtally.llm import ppm


def held(rows, docs, **more):
    model = brute.Ppm([(t or "").encode() for i, t in rows if brute.crc(i) % 7 != 2], ppm.ORDER)
    got = ppm.score(docs, ppm.learned_rows(), **more).collect()
    assert len(got) == len(rows)
    texts = {}
    for i, t in rows:
        texts.setdefault(i, []).append((t or "").encode())
    for r in got:
        expected = []
        for data in texts[r.doc_id]:
            n, known, total, base = model.base(data)
            expected.append((brute.crc(r.doc_id) % 7 == 2, n, known, total, pytest.approx(base), pytest.approx(model.score(data))))
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) in expected


@pytest.mark.parametrize("block_bytes", [ppm.BLOCK_BYTES, 40_000])
def test_equals_brute_force(small, block_bytes):
    docs = small.limit(60).cache()
    held([tuple(r) for r in docs.select("doc_id", "text").collect()], docs, block_bytes=block_bytes)
    docs.unpersist()


def test_answers_follow_questions(spark):
    """A share answers the blocks that asked it and no others; its totals go out once."""
    import zstandard

    def answers(n):
        rows = [(i, f"word{i} x") for i in range(n)]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        blocks, got, shares = ppm._exchange(df, ppm.learned_rows(), 12)
        got = got.collect()
        tokens = [int.from_bytes(zstandard.ZstdDecompressor().decompress(r.sent)[:8], "little") for r in got]
        held = {r.block for r in blocks.select("block").distinct().collect()}
        learned = sum(brute.crc(i) % 7 != 2 for i, _ in rows)
        assert {r.block for r in got} == held and sum(tokens) == 3 * learned
        assert len({(r.share, r.block) for r in got}) == len(got) and sum(t > 0 for t in tokens) <= shares
        return len(got) / n

    # about 30 distinct contexts and words a text: each text asks at most so many shares
    assert answers(400) < 45 and answers(1600) < 45


def test_rows_without_ids_are_dealt(spark):
    rows = [(None, f"text {i} " * 9) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert ppm._exchange(df, ppm.learned_rows(), 400)[0].select("block").distinct().count() > 5
    held(rows, df, block_bytes=400)


def test_odd_rows(spark):
    rows = [(r[0], (r[1] or "")[:3000] if r[1] else r[1]) for r in ODD_ROWS]
    held(rows, spark.createDataFrame(rows, "doc_id long, text string"), block_bytes=2_000)


def test_many_symbols_and_long_text(spark):
    text = "".join(chr(0x100 + i * 37 % 5000) for i in range(30_000)) + "\0\0nul"
    held([(1, text[:2000]), (2, text[:500])], spark.createDataFrame([(1, text[:2000]), (2, text[:500])], "doc_id long, text string"))
    assert ppm.score(spark.createDataFrame([(1, text)], "doc_id long, text string"), ppm.learned_rows()).count() == 1


def test_probabilities_sum_to_one():
    """Over all symbols after a seen, a partly seen and an unseen context."""
    import numpy as np

    block = ppm.Block([b"abracadabra", b"abra", b"cab"])
    counts = np.bincount(block.pair, minlength=len(block.codes)).astype(np.uint64)
    parts = [ppm._summed(ppm.at_order(block.codes, k), counts) for k in range(ppm.ORDER + 1)]
    trie = ppm.Trie(*(np.concatenate([p[i] for p in parts]) for i in (0, 1)))
    for context in (b"abrac", b"zzabr", b"zzzzz", b"\0\0\0\0\0"):
        code = np.uint64(int.from_bytes(context, "big") << 9)
        logs = trie.log10(np.arange(257, dtype=np.uint64) | code)
        assert (10 ** logs).sum() == pytest.approx(1)


def test_nothing_learned_and_empty_table(spark, nothing):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(1, "ab"), (2, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in ppm.score(docs, F.lit(None).cast("boolean")).collect()}
    assert rows[1].score == pytest.approx(-3 * 2.4099331) and rows[1].held_out and rows[1].train_tokens == 0
    assert rows[2].n_tokens == 1 and rows[2].n_known == 0
    assert ppm.score(nothing, ppm.learned_rows()).count() == 0


def test_block_numbers_words_and_pairs():
    """Each word and each context with its symbol has one number, also with many letters in a block."""
    import numpy as np
    import xxhash

    texts = ["Ab ab  c\n".encode(), b"", "".join(chr(0x100 + i * 37 % 3000) for i in range(4000)).encode(), b"c ab"]
    block = ppm.Block(texts)
    found = [w for t in texts for w in [*t.lower().split(), ppm.END_WORD]]
    assert block.word_keys[block.word].tolist() == [xxhash.xxh3_64_intdigest(w) for w in found]
    assert len(block.word_keys) == len(set(found)) and block.word_sizes.tolist() == [4, 1, 2, 3]
    want = []
    for t in texts:
        padded = [0] * ppm.ORDER + list(t.lower()) + [ppm.END]
        for i in range(ppm.ORDER, len(padded)):
            want.append(int.from_bytes(bytes(padded[i - ppm.ORDER:i]), "big") << 9 | padded[i])
    assert block.codes[block.pair].tolist() == want and len(block.codes) == len(set(want)) == len(np.unique(block.codes))


def test_lower_orders_see_only_what_is_left(monkeypatch):
    """A pair coded at one order is not looked up below it, and counts of an order are summed from the one above."""
    import numpy as np

    looked = []
    find = ppm.Trie.find
    monkeypatch.setattr(ppm.Trie, "find", lambda self, k, codes: looked.append(len(codes)) or find(self, k, codes))
    block = ppm.Block([b"the cat sat on the mat ", b"the rat ate the cat", b""] * 40)
    counts = np.bincount(block.pair, minlength=len(block.codes))
    parts = [ppm._summed(ppm.at_order(block.codes, k), counts) for k in range(ppm.ORDER + 1)]
    trie = ppm.Trie(*(np.concatenate([p[i] for p in parts]) for i in (0, 1)))
    logs = trie.log10(block.codes)
    assert sum(looked) == len(block.codes) and (logs < 0).all()
    for got, want in zip(ppm._by_order(block.codes, counts), zip(*parts)):
        assert got.tolist() == np.concatenate(want).tolist()


def test_wide_alphabet_is_numbered_in_order(monkeypatch):
    """Pairs have the same numbers whether or not all that could occur fit the table."""
    import random

    rng = random.Random(4)
    texts = [bytes(rng.randrange(256) for _ in range(3000)), b"\xff\x00" * 9, b"a b"]
    block = ppm.Block(texts)
    assert (block.codes[1:] > block.codes[:-1]).all()
    monkeypatch.setattr(ppm, "_DENSE", 10)
    again = ppm.Block(texts)
    assert again.codes.tolist() == block.codes.tolist() and again.pair.tolist() == block.pair.tolist()
