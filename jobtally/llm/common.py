"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtally.session import scratch_dir

WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new folder of the shared checkpoint folder, and read again.

    Cuts the lineage: a lost executor costs nothing that was written.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Number of words, 0 for a null text."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def crc_of_id(doc_id: Column) -> Column:
    """crc32 of the id written as text (a null id as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def content_digest(role: Column, text: Column) -> Column:
    """16 bytes that tell turns apart by their role and text."""
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.unhex(F.sha2(whole, 256)), 1, 16)


def missing_id(rows: DataFrame, name: str) -> int | None:
    """A number that stands for the missing id, above all others; None if no id is missing."""
    most, least, missing = rows.agg(F.max(name), F.min(name), F.count_if(F.col(name).isNull())).first()
    if not missing:
        return None
    return 0 if most is None else most + 1 if most < (1 << 63) - 1 else least - 1


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, also when a lambda inside uses it."""
    return F.transform(F.array(value), body)[0]


def text_bytes(column: pa.ChunkedArray | pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each value of an Arrow string column; null is empty."""
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""


def block_count(spark: SparkSession, docs: DataFrame, block_bytes: int, text: str = "text") -> int:
    """How many blocks of about ``block_bytes`` of text ``docs`` makes."""
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(1, -(-total // block_bytes))


DEALT = pa.schema([("share", pa.int64()), ("block", pa.int64()), ("sent", pa.binary())])
DEALT_DDL = "share long, block long, sent binary"


def deal(key: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(share, its indices in order) of the elements dealt by ``key`` into ``n`` shares."""
    share = (key % np.uint64(n)).astype(np.uint16 if n <= 1 << 16 else np.int64)  # 16 bits are sorted by radix
    by = np.argsort(share, kind="stable")
    for part in np.split(by, np.flatnonzero(np.diff(share[by])) + 1):
        if len(part):
            yield int(share[part[0]]), part


def arrow_rows(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def crc32_sql(text: str) -> str:
    """DuckDB SQL for the unsigned crc32 of an ASCII text."""
    step = "lambda x, y: xor(x >> 1, 3988292384 * (x & 1))"
    byte = f"lambda a, b: list_reduce(list_prepend(xor(a, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])), {step})"
    codes = f"list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT))"
    return f"xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), {byte}))"
