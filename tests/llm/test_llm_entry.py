"""The registered queries of the operators at the smallest scale, against their SQL."""

import math

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from jobtally.llm.queries import ORACLE_SQL, QUERIES

SMALL = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op3_near_dedup": "doc_id n_shingles component_id kept",
    "op4_ppm_score": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op5_line_quality": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op6_closed_syncmers": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op7_toxicity": "doc_id held_out score predicted",
    "op8_source_mix": "doc_id size source_size target taken",
    "op9_chat_format": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op10_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op11_conversation_repair": "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256",
    "op12_prefix_trie": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
    "op13_simhash": "doc_id fingerprint component_id",
}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


def _cells(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cell = lambda v: repr(round(v, 9)) if isinstance(v, float) and not math.isnan(v) else repr(v)
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def test_all_are_registered():
    assert set(QUERIES) <= set(queries()) and set(ORACLE_SQL) <= set(oracle_sql())
    assert {int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")} == set(range(1, 14))
    assert "pipeline" in QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_twin(spark, con, name):
    df = queries()[name](spark, SMALL)
    res = con.execute(oracle_sql()[name])
    columns = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(columns)
    assert _cells([tuple(r) for r in df.collect()], df.columns) == _cells(res.fetchall(), columns)


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, name):
    df = queries()[name](spark, SMALL)
    assert df.columns[:len(COLUMNS[name].split())] == COLUMNS[name].split()
    assert df.count() > 0
