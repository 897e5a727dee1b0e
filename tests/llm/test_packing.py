import collections
import zlib

import numpy as np
import pytest
from odd_rows import ODD_ROWS
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from jobtally.llm import packing as P
from jobtally.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


def check(rows, pieces, tokenizer, window):
    """Every id of every row lies in exactly one piece, in order; sequences are full and gapless."""
    want = collections.Counter()
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        want[(doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))] += 1
    by_sequence = collections.defaultdict(list)
    for p in pieces:
        by_sequence[p.sequence_id].append(p)
        assert len(p.ids) == 4 * p.length > 0
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    got, open_ = collections.Counter(), None
    for number in sorted(by_sequence):
        at = 0
        for p in sorted(by_sequence[number], key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
            if p.start == 0:
                open_ = [p.doc_id, p.doc_tokens, b""]
            assert (open_[0], len(open_[2])) == (p.doc_id, 4 * p.start)
            open_[2] += bytes(p.ids)
            if p.start + p.length == p.doc_tokens:
                got[(open_[0], open_[1], zlib.crc32(open_[2]))] += 1
        assert at == window or number == len(by_sequence) - 1
    assert got == want


@pytest.mark.parametrize("window", [1024, 7])
def test_equals_tokenizer(small, tokenizer, window):
    docs = small.where("doc_id < 60").repartition(5)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    check(rows, P.pack(docs, tokenizer_path(), window).collect(), tokenizer, window)


def test_odd_rows(odd, odd_wide, nothing, tokenizer):
    rows = [r[:2] for r in ODD_ROWS]
    check(rows, P.pack(odd, tokenizer_path()).collect(), tokenizer, P.WINDOW)
    check(rows, P.pack(odd_wide, tokenizer_path()).collect(), tokenizer, P.WINDOW)
    assert P.pack(nothing, tokenizer_path()).count() == 0


def test_special_string_and_scripts(tokenizer):
    for text in ("a <|endoftext|> b", "日本語 ελληνικά עברית \U0001f469‍\U0001f467", "  tabs\t\tand\r\nlines \n\n", "\0\x7f", "it's we'll"):
        assert P.encode(text, tokenizer_path()) == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("blank", [" ", "\n", "\u3000"])
def test_very_long_white_space(tokenizer, blank):
    for text in ("a " + blank * 1_000_000 + "word", blank * 1_000_000, ("b" + blank * 99_999) * 3):
        assert P.encode(text, tokenizer_path()) == tokenizer.encode(text, add_special_tokens=False).ids


def test_padded_document_is_packed(spark, tokenizer):
    rows = [(1, "before"), (2, "padded" + " " * 1_000_000 + "document"), (3, "after")]
    check(rows, P.pack(spark.createDataFrame(rows, "doc_id long, text string"), tokenizer_path()).collect(), tokenizer, P.WINDOW)


def test_sequences_join_pieces(small):
    pieces = P.pack(small.limit(30), tokenizer_path(), 100).cache()
    whole = P.sequences(pieces).collect()
    assert all(r.length * 4 == len(r.ids) for r in whole)
    assert sum(r.length for r in whole) == pieces.agg(F.sum("length")).first()[0]
    pieces.unpersist()
