import duckdb
import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from jobtally.llm import chat as C
from jobtally.llm.queries import tokenizer_path

SCHEMA = "conv_id long, turn long, role string, text string"
ROWS = [
    (1, 0, "user", "hello"), (1, 1, "assistant", "  hi\n\n there  "), (1, 2, "assistant", ""), (1, 3, "assistant", "\n"),
    (2, 1, "assistant", None), (2, 0, None, "x<|im_end|>"), (2, 2, "assistant", "<\\|im_start|><|im_sep|>a<"),
    (3, 0, "assistant", "|im_end|>"), (3, 0, "assistant", "|im_end|>"), (3, None, "<|im_sep|>", "<|endoftext|>"),
    (None, 5, "assistant", "no id"), (None, 4, "user", "\U0001f600 é日本"), (4, 0, "assistant", "word " * 20_000 + "\U0001f469‍\U0001f467"),
    (5, 0, "user", "only asks"), (6, 7, "assistant", "<<\\\\|<|"),
]


def digests(df):
    return sorted((tuple(r) for r in C.digests(C.format_conversations(df, tokenizer_path())).collect()), key=repr)


def sql(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    return sorted((r for r in con.execute(C.ORACLE).fetchall()), key=repr)


def test_equals_sql(spark):
    rows = ROWS + [(-1, i, role, C.PROBE_TEXT) for i, role in enumerate(("user", "assistant"))]
    df = spark.createDataFrame(rows, SCHEMA)
    assert digests(df) == sql(ROWS)
    from pyspark.sql import functions as F

    assert digests(df.withColumns({c: F.lit("own") for c in ("turns", "formatted", "ids", "loss_mask")})) == sql(ROWS)


def test_empty_table(spark):
    assert digests(spark.createDataFrame([], SCHEMA)) == []


def test_mask_covers_exactly_the_learned_tokens(spark):
    for row in C.format_conversations(spark.createDataFrame(ROWS, SCHEMA), tokenizer_path()).collect():
        mask = np.frombuffer(row.loss_mask, np.uint8)
        assert len(mask) == len(row.token_ids) == len(row.token_begin) == len(row.token_end)
        inside = [any(b < high and e > low for low, high in zip(row.loss_begin, row.loss_end)) for b, e in zip(row.token_begin, row.token_end)]
        assert mask.astype(bool).tolist() == inside
        # no token reaches over the border of a learned text
        for b, e, m in zip(row.token_begin, row.token_end, mask):
            if m:
                assert any(low <= b and e <= high for low, high in zip(row.loss_begin, row.loss_end))


@given(st.text(alphabet="<|\\ab\n>im_end"))
def test_escape_round_trip(text):
    safe = C.escape(text)
    assert C.unescape(safe) == text
    assert "<|" not in safe


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "<|im_sep|>", ""]), st.text(alphabet="<|\\a im_end>"))))
def test_render_round_trip(turns):
    formatted, spans = C.render(turns)
    assert C.read_turns(formatted) == turns
    assert [C.unescape(formatted[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


@pytest.mark.parametrize("spans,want", [([(0, 3)], [1, 1, 0, 0]), ([(3, 4)], [0, 1, 0, 0]), ([(2, 2)], [0, 0, 0, 0]), ([(1, 2), (6, 9)], [1, 0, 0, 1])])
def test_mask_tokens(spans, want):
    begin, end = np.array([0, 2, 4, 6]), np.array([2, 4, 6, 8])
    assert C.mask_tokens(begin, end, spans).tolist() == want
