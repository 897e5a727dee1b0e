"""Packing: concatenate all token sequences and cut fixed windows.

Pass 1 tokenises each partition once and writes ids with the running offset
inside the partition. The token totals of the partitions, one row each, give
by prefix sum the global offset of every document; pass 2 cuts the windows
from the written table, so a lost executor repeats neither the tokenising nor
the numbering. No text is shuffled and nothing is sorted.

Defined cases: a null or empty text is its end id alone; a text longer than a
window makes several pieces; repeated rows are packed as often as they occur;
an empty table gives no piece; columns other than the two named are not read.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobtally.llm.common import written

WINDOW = 1024
END_ID = 0

#: tiktoken's pattern engine keeps one entry a character of a run of white space, and panics near 1,000,000
_LONG_RUN = 100_000
_BLANKS = re.compile(rf"(?<!\s)\s{{{_LONG_RUN}}}")

_TOKENS = "part int, in_part long, doc_id {id}, doc_tokens long, ids binary"


@functools.cache
def _encoders(tokenizer_path: str):
    """Encoder of plain text, and the tokenizer itself with its special strings.

    The plain encoder reads the same vocabulary and merges (by rank) through
    tiktoken, which gives the same ids faster; texts that hold a special
    string of the tokenizer or a very long run of white space go to the
    tokenizer itself.
    """
    import json

    import tiktoken
    from public_tokenizers import PATTERN
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(tokenizer_path)
    with open(tokenizer_path, encoding="utf-8") as file:
        spec = json.load(file)
    special = {x["content"] for x in spec.get("added_tokens", [])}
    # byte-level vocabularies write each byte as a printable character
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    letters |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    ranks = {
        bytes(letters[c] for c in token): i
        for token, i in spec["model"]["vocab"].items()
        if token not in special
    }
    fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return fast, full, tuple(special)


def encode(text: str, tokenizer_path: str) -> list[int]:
    """Ids of ``text`` as the tokenizer file gives them, without added special tokens."""
    fast, full, special = _encoders(tokenizer_path)
    if any(s in text for s in special) or (len(text) >= _LONG_RUN and _BLANKS.search(text)):
        return full.encode(text, add_special_tokens=False).ids
    return fast.encode_ordinary(text)


def token_table(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """One row per document: ids (little-endian 32 bits, end id last) and its offset in the partition."""
    schema = _TOKENS.format(id=docs.schema["doc_id"].dataType.simpleString())

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                rows = batch.slice(lo, 256)
                ids, sizes, starts = [], [], []
                for text in rows.column(1):
                    one = encode(text.as_py() or "", tokenizer_path)
                    one.append(end_id)
                    ids.append(np.array(one, dtype="<u4").tobytes())
                    sizes.append(len(one))
                    starts.append(at)
                    at += len(one)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * len(ids), pa.int32()),
                        pa.array(starts, pa.int64()),
                        rows.column(0),
                        pa.array(sizes, pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    names=["part", "in_part", "doc_id", "doc_tokens", "ids"],
                )

    return docs.select("doc_id", "text").mapInArrow(tokenise, schema)


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Pieces of the documents in sequences of at most ``window`` ids.

    Returns doc_id, start, length, ids (binary, 32 bits each), doc_tokens,
    sequence_id, offset. Only the last sequence can be shorter than the window.
    """
    tokens = written(token_table(docs, tokenizer_path, end_id), "packing")
    totals = tokens.groupBy("part").agg(F.sum("doc_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition that wrote tokens: a few bytes each, whatever the corpus holds
    offsets = totals.select(F.col("part").alias("p"), F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    placed = tokens.join(F.broadcast(offsets), F.col("part") == F.col("p")).withColumn("at", F.col("base") + F.col("in_part"))
    last = F.col("at") + F.col("doc_tokens") - 1
    cut = placed.select(
        "doc_id", "doc_tokens", "ids", "at",
        F.explode(F.sequence(F.floor(F.col("at") / window), F.floor(last / window))).alias("sequence_id"),
    )
    begin = F.greatest(F.col("at"), F.col("sequence_id") * window)
    end = F.least(F.col("at") + F.col("doc_tokens"), (F.col("sequence_id") + 1) * window)
    return cut.select(
        "doc_id",
        (begin - F.col("at")).alias("start"),
        (end - begin).alias("length"),
        F.substring("ids", ((begin - F.col("at")) * 4 + 1).cast("int"), ((end - begin) * 4).cast("int")).alias("ids"),
        F.col("doc_tokens"),
        F.col("sequence_id").cast("long").alias("sequence_id"),
        (begin - F.col("sequence_id") * window).alias("offset"),
    )


def sequences(pieces: DataFrame) -> DataFrame:
    """The packed sequences: sequence_id, length, ids of the pieces joined in order."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    whole = F.aggregate(parts, F.lit(b""), lambda joined, p: F.concat(joined, p["ids"]))
    return pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"), whole.alias("ids"))
