"""SimHash near-duplicates through a Gray-order hierarchical index.

1. Every text becomes a 64-bit fingerprint: of the XXH64 of its word shingles
   (repeats included) each bit is the majority. Equal fingerprints are one code.
2. Two codes that differ in at most ``distance`` bits agree wholly in one of
   ``distance + 1`` segments, so every code goes to one bucket per segment.
   Buckets are sorted by the Gray rank of their codes, where neighbours share
   most bits, and cut into blocks of at most ``BLOCK`` codes (range partitions:
   a large bucket lies in many blocks and tasks).
3. A block gets an index from its sorted codes upwards: ``FAN`` neighbours make
   an upper node, which takes the bits that all of them share (mask and
   pattern), and leaves only the other bits to them. A code is looked up from
   the top; the differences at the masked bits add up on the way down, and a
   node with more than ``distance`` goes with all below it. At a code the sum
   is the full distance, so links are exact.
4. Links inside a block leave it as stars of its components. Blocks of the same
   bucket meet in pairs, unless their uppermost patterns differ too much or all
   their codes are in one component already; below, nodes whose codes are all in
   the component of the looked-up code are passed over. So a group of near
   copies is never listed pair by pair.

Defined cases: a null or empty text, or one without words, has the fingerprint
zero and is linked like any other; with fewer words than a shingle the whole
sequence is one shingle; rows without an id take part as all others do, but
name no component: ``component_id`` is the smallest id in it, null if it has
none; rows with the same id are fingerprinted one by one; an empty table gives an empty
result; columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtally.llm.common import SPACES, text_bytes, written
from jobtally.llm.near_dedup import components

SHINGLE = 4
DISTANCE = 4
SEED = 42
BLOCK = 4096
FAN = 8
#: shingles, queries and pairs held at a time in a task
PART, QUERIES, PAIRS = 1 << 16, 1024, 1 << 21

_U = np.uint64
_SPACE = np.isin(np.arange(256), np.frombuffer(SPACES.encode(), np.uint8))


def shingle_hashes(text: bytes, size: int) -> Iterator[np.ndarray]:
    """XXH64 of the space-joined shingles of ``size`` words, ``PART`` at a time."""
    data = np.frombuffer(text.lower(), np.uint8)
    space = _SPACE[data]
    # one space after each word, none elsewhere
    kept = ~space
    kept[1:] |= ~space[:-1]
    data, space = np.where(space, np.uint8(32), data)[kept], space[kept]
    if not len(data):
        return
    joined = data.tobytes()
    ends = np.flatnonzero(space)
    if not space[-1]:
        ends = np.append(ends, len(data))
    starts = np.concatenate([[0], ends[:-1] + 1])
    span = min(size, len(ends))
    starts, ends = starts[:len(starts) - span + 1], ends[span - 1:]
    of = xxhash.xxh64_intdigest
    for low in range(0, len(starts), PART):
        cuts = zip(starts[low:low + PART].tolist(), ends[low:low + PART].tolist())
        yield np.array([of(joined[s:e], SEED) for s, e in cuts], _U)


def simhashes(texts: Iterator[bytes], size: int) -> np.ndarray:
    """The fingerprints of the texts."""
    counts, totals, waiting, of = [], [], [], []

    def count():
        if waiting:
            bits = np.unpackbits(np.concatenate(waiting).astype("<u8").view(np.uint8), bitorder="little").reshape(-1, 64)
            starts = np.cumsum([0, *map(len, waiting[:-1])])
            for i, ones in zip(of, np.add.reduceat(bits, starts, axis=0, dtype=np.int64)):
                counts[i] += ones
            waiting.clear()
            of.clear()

    held = 0
    for text in texts:
        counts.append(np.zeros(64, np.int64))
        totals.append(0)
        for part in shingle_hashes(text, size):
            totals[-1] += len(part)
            waiting.append(part)
            of.append(len(counts) - 1)
            held += len(part)
            if held >= PART:
                count()
                held = 0
    count()
    if not counts:
        return np.zeros(0, _U)
    ones = 2 * np.array(counts) > np.array(totals)[:, None]
    return np.packbits(ones, axis=1, bitorder="little").view("<u8").ravel().astype(_U)


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, code (the fingerprint's bits as a long) of every row."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                codes = simhashes(text_bytes(part.column(1)), size)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(codes.view(np.int64))], names=["doc_id", "code"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(sign, "doc_id long, code long")


def gray_rank(code: Column) -> Column:
    """Place of a code in the Gray order, as a long whose signed order is that order."""
    for shift in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
    return code.bitwiseXOR(F.lit(-(1 << 63)))


def _segments(code: Column, distance: int) -> Column:
    """One bucket per segment: the segment's number above its bits."""
    cuts = [64 * s // (distance + 1) for s in range(distance + 2)]
    return F.array(*(
        F.shiftrightunsigned(F.shiftleft(code, 64 - high), 64 - high + low).bitwiseOR(F.lit(s << 56)) if distance
        else code for s, (low, high) in enumerate(zip(cuts, cuts[1:]))))


def _shared(mask: np.ndarray, pattern: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mask and pattern of the bits that the nodes from each ``first`` on share."""
    every, some = np.bitwise_and.reduceat(pattern, first), np.bitwise_or.reduceat(pattern, first)
    mask = np.bitwise_and.reduceat(mask, first) & ~(every ^ some)
    return mask, every & mask


class Level:
    """Nodes of one height: own masked bits, where their children begin, their last code, their common label (or -1)."""

    def __init__(self, mask, pattern, bucket, begin, last, label):
        self.mask, self.pattern, self.bucket, self.begin, self.last, self.label = mask, pattern, bucket, begin, last, label


def hierarchy(codes: np.ndarray, bucket: np.ndarray, labels: np.ndarray) -> list[Level]:
    """The index of codes sorted by bucket and Gray rank, codes first, one node per bucket last."""
    at = np.arange(len(codes))
    levels = [Level(np.full(len(codes), ~_U(0)), codes.copy(), bucket, at, at, labels)]
    while True:
        low = levels[-1]
        new = np.concatenate([[True], low.bucket[1:] != low.bucket[:-1]])
        if new.all():
            return levels
        place = np.arange(len(new))
        place -= np.maximum.accumulate(np.where(new, place, 0))
        top = place % FAN == 0
        first = np.flatnonzero(top)
        mask, pattern = _shared(low.mask, low.pattern, first)
        last = low.last[np.append(first[1:], len(new)) - 1]
        least, most = np.minimum.reduceat(low.label, first), np.maximum.reduceat(low.label, first)
        levels.append(Level(mask, pattern, low.bucket[first], first, last, np.where(least == most, least, -1)))
        # what the upper node holds is not kept below it
        up = np.cumsum(top) - 1
        low.mask &= ~mask[up]
        low.pattern &= low.mask


def linked_pairs(codes: np.ndarray, bucket: np.ndarray, distance: int, labels: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j) with i < j of the codes of a bucket that differ in at most ``distance`` bits.

    ``labels`` (0 and up): pairs with the same label are passed over.
    """
    skip = labels is not None
    levels = hierarchy(codes, bucket, labels if skip else np.full(len(codes), -1))
    root = np.cumsum(np.concatenate([[True], bucket[1:] != bucket[:-1]])) - 1
    for low in range(0, len(codes), QUERIES):
        i = np.arange(low, min(low + QUERIES, len(codes)))
        node = root[i]
        off = np.bitwise_count((codes[i] ^ levels[-1].pattern[node]) & levels[-1].mask[node])
        for upper, lower in zip(levels[:0:-1], levels[-2::-1]):
            begin, end = upper.begin[node], np.append(upper.begin[1:], len(lower.mask))[node]
            many = end - begin
            i, off = np.repeat(i, many), np.repeat(off, many)
            node = np.arange(len(i)) + np.repeat(begin - np.cumsum(many) + many, many)
            off = off + np.bitwise_count((codes[i] ^ lower.pattern[node]) & lower.mask[node])
            good = (off <= distance) & (lower.last[node] > i)
            if skip:
                good &= lower.label[node] != labels[i]
            i, node, off = i[good], node[good], off[good]
        good = node > i  # also where a bucket is one code
        yield i[good], node[good]


def stars(codes: np.ndarray, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs' components as (least place, place) of all others in them."""
    least = np.arange(len(codes))
    a, b, held = [], [], 0

    def settle():
        nonlocal least
        x, y = np.concatenate(a), np.concatenate(b)
        while True:
            low = np.minimum(least[x], least[y])
            if (least[x] == low).all() and (least[y] == low).all():
                break
            for side in (x, y):
                np.minimum.at(least, least[side], low)
                np.minimum.at(least, side, low)
            least = least[least]
        a.clear()
        b.clear()

    for x, y in pairs:
        a.append(x)
        b.append(y)
        held += len(x)
        if held >= PAIRS:
            settle()
            held = 0
    if held:
        settle()
    while (least[least] != least).any():
        least = least[least]
    far = np.flatnonzero(least != np.arange(len(codes)))
    return least[far], far


BLOCKS = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("mask", pa.int64()), ("pattern", pa.int64()),
                    ("codes", pa.list_(pa.int64()))])


def blocks(codes: DataFrame, distance: int, block: int = BLOCK) -> DataFrame:
    """bucket, block, mask, pattern, codes: pieces of the buckets of all ``codes`` in Gray order."""
    rows = codes.select("code", F.explode(_segments(F.col("code"), distance)).alias("bucket"))
    keys = [F.col("bucket"), gray_rank(F.col("code"))]
    rows = rows.select("bucket", "code").repartitionByRange(*keys).sortWithinPartitions(*keys)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held, of = np.zeros(0, np.int64), None

        def made(bucket, part):
            nonlocal number
            mask, pattern = _shared(np.full(len(part), ~_U(0)), part.view(_U), np.zeros(1, np.int64))
            number += 1
            return bucket, number, mask.view(np.int64)[0], pattern.view(np.int64)[0], part

        for batch in batches:
            bucket, code = (np.asarray(batch.column(i)) for i in range(2))
            if not len(bucket):
                continue
            out = []
            for part in np.split(np.arange(len(bucket)), np.flatnonzero(np.diff(bucket)) + 1):
                if of is not None and of != bucket[part[0]]:
                    out.append(made(of, held))
                    held = held[:0]
                of, held = int(bucket[part[0]]), np.concatenate([held, code[part]])
                while len(held) > block:
                    out.append(made(of, held[:block]))
                    held = held[block:]
            yield _batch(out)
        if of is not None:
            yield _batch([made(of, held)])

    return rows.mapInArrow(cut, "bucket long, block long, mask long, pattern long, codes array<long>")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(BLOCKS)], schema=BLOCKS)


def _gray_order(codes: np.ndarray) -> np.ndarray:
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> _U(shift)
    return np.argsort(rank, kind="stable")


def _edges(codes: np.ndarray, bucket: np.ndarray, distance: int, labels: np.ndarray | None = None) -> pa.RecordBatch:
    a, b = stars(codes, linked_pairs(codes, bucket, distance, labels))
    return pa.RecordBatch.from_arrays([pa.array(codes[x].view(np.int64)) for x in (a, b)], names=["a", "b"])


def links_inside(pieces: DataFrame, distance: int) -> DataFrame:
    """a, b: stars of the linked codes of each block."""
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 200):
                part = batch.column(0).slice(low, 200)
                codes = np.asarray(part.flatten()).view(_U)
                yield _edges(codes, np.repeat(np.arange(len(part)), np.asarray(part.value_lengths())), distance)

    return pieces.where(F.size("codes") > 1).select("codes").mapInArrow(join, "a long, b long").distinct()


def links_between(pieces: DataFrame, labels: DataFrame, distance: int) -> DataFrame:
    """a, b: stars of the linked codes of different components in blocks of the same bucket."""
    shared = pieces.groupBy("bucket").agg(F.count(F.lit(1)).alias("blocks")).where("blocks > 1")
    cut = pieces.join(shared, "bucket").drop("blocks")
    each = cut.select("block", F.explode("codes").alias("node"))
    each = each.join(labels, "node", "left").select("block", F.struct("node", F.coalesce("label", "node").alias("label")).alias("code"))
    of = F.transform(F.col("codes"), lambda x: x["label"])
    each = each.groupBy("block").agg(F.collect_list("code").alias("codes"))
    each = each.withColumn("only", F.when(F.array_min(of) == F.array_max(of), F.array_min(of)))
    cut = written(cut.drop("codes").join(each, "block"), "blocks")
    top = cut.select("bucket", "block", "mask", "pattern", "only")
    a, b = (top.select("bucket", *(F.col(c).alias(f"{c}_{s}") for c in top.columns[1:])) for s in "ab")
    apart = F.bit_count(F.col("pattern_a").bitwiseXOR(F.col("pattern_b")).bitwiseAND(F.col("mask_a")).bitwiseAND(F.col("mask_b")))
    met = a.join(b, "bucket").where(F.col("block_a") < F.col("block_b")).where(apart <= distance)
    met = met.where(~F.coalesce(F.col("only_a") == F.col("only_b"), F.lit(False))).select("block_a", "block_b")
    for s in "ab":
        met = met.join(cut.select(F.col("block").alias(f"block_{s}"), F.col("codes").alias(f"codes_{s}")), f"block_{s}")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                both = [batch.column(k).slice(i, 1).flatten().flatten() for k in range(2)]
                codes, label = (np.concatenate([np.asarray(x[k]) for x in both]) for k in range(2))
                codes = codes.view(_U)
                order = _gray_order(codes)
                label = np.unique(label, return_inverse=True)[1]
                yield _edges(codes[order], np.zeros(len(codes), np.int64), distance, label[order])

    return met.select("codes_a", "codes_b").mapInArrow(join, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, size: int = SHINGLE, distance: int = DISTANCE, block: int = BLOCK) -> DataFrame:
    """doc_id, code, component_id of every row of ``docs``.

    Links fingerprints that differ in at most ``distance`` (0 to 15) bits.
    """
    signed = written(fingerprints(docs, size), "fingerprints")
    codes = written(signed.groupBy("code").agg(F.min("doc_id").alias("least")), "codes")
    pieces = written(blocks(codes, distance, block), "blocks")
    links = written(links_inside(pieces, distance), "links")
    labels = written(components(links), "labels")
    more = written(links_between(pieces, labels, distance), "links")
    if more.limit(1).count():
        labels = written(components(links.unionByName(more)), "labels")
    found = codes.join(labels.withColumnRenamed("node", "code"), "code", "left")
    found = found.select("code", "least", F.coalesce("label", "code").alias("label"))
    least = found.groupBy("label").agg(F.min("least").alias("component_id"))
    found = found.join(least, "label").select("code", "component_id")
    return signed.join(found, "code").select("doc_id", "code", "component_id")


def code_text(code: Column) -> Column:
    """A fingerprint as 16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(code)), 16, "0")
