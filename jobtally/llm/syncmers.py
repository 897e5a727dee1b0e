"""Closed-syncmer fingerprints, native: DataFrame functions only.

A text is a sequence of words. A k-mer of ``K`` words is chosen when the least
hash among its inner runs of ``S`` words lies at its first or last run. The
choice depends on the k-mer alone, so an anchor survives any edit outside its
own words. A fingerprint is the list of the chosen k-mers' 32-bit hashes in
text order; the likeness of two is the Dice share of their distinct anchors.

Next documents are found without a global sort: ids are dealt into ranges, a
window finds the neighbour inside a range, and the last row of each range
takes the first document of the next range that has any. Ranges are parts of
the ``CUTS`` intervals between approximate quantiles, so that far or clustered
ids leave at most about one of ``CUTS`` parts of the rows in one range; rows
without an id are dealt alike by the first bytes of their texts.

Defined cases: a null text is empty; words longer than ``LONG_WORD`` code
points are cut into pieces, so that a text without spaces has anchors too; a
text without an anchor (fewer than ``K`` words) has one anchor, the hash of its
words; rows with the same id are ordered by text; a null id comes first; the
document after the last is the first, for a single row itself; an empty table
gives an empty result; columns other than doc_id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobtally.llm.common import let

K, S = 8, 2
LONG_WORD = 32
ROWS_PER_RANGE = 2000
CUTS = 256
_FIRST = -(1 << 63)


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """array<struct<position int, hash long>> of the closed syncmers of ``text``, in order."""
    inner = k - s

    def chosen(hashes: Column, runs: Column) -> Column:
        def closed(i: Column) -> Column:
            between = [F.get(runs, i + d) for d in range(1, inner)]
            edge = F.least(F.get(runs, i), F.get(runs, i + inner))
            return F.least(*between) >= edge

        places = F.filter(F.sequence(F.lit(0), F.size(hashes) - k), closed)
        return F.transform(places, lambda i: F.struct(
            i.alias("position"),
            F.xxhash64(*[F.get(hashes, i + d) for d in range(k)]).bitwiseAND(F.lit(0xFFFFFFFF)).alias("hash"),
        ))

    def of(hashes: Column) -> Column:
        whole = F.array(F.struct(F.lit(0).alias("position"), F.xxhash64(hashes).bitwiseAND(F.lit(0xFFFFFFFF)).alias("hash")))
        runs = F.transform(F.sequence(F.lit(0), F.size(hashes) - s),
                           lambda i: F.xxhash64(*[F.get(hashes, i + d) for d in range(s)]))
        found = let(let(runs, lambda r: chosen(hashes, r)), lambda a: F.when(F.size(a) > 0, a).otherwise(whole))
        return F.when(F.size(hashes) < k, whole).otherwise(found)

    pieces = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]{1,%d}" % LONG_WORD), F.lit(0))
    return let(F.transform(pieces, lambda w: F.xxhash64(w)), of)


def anchor_hashes(text: Column) -> Column:
    return let(anchors(text), lambda a: F.transform(a, lambda x: x["hash"]))


def likeness(a: Column, b: Column) -> Column:
    """Dice share of the distinct anchors of two fingerprints, 0 to 1."""
    both = F.size(F.array_intersect(a, b))
    return (2.0 * both) / (F.size(F.array_distinct(a)) + F.size(F.array_distinct(b)))


def as_string(hashes: Column) -> Column:
    """8 hexadecimal digits per anchor, in text order."""
    return F.lower(F.array_join(F.transform(hashes, lambda h: F.lpad(F.hex(h), 8, "0")), ""))


def _quantiles(value: Column) -> Column:
    return F.percentile_approx(value, [i / CUTS for i in range(1, CUTS)])


def _interval(value: Column, cuts: list[int]) -> Column:
    """How many of ``cuts`` (ascending) the value reaches."""
    return F.size(F.filter(F.lit(cuts).cast("array<bigint>"), lambda c: c <= value)).cast("long")


def _range(key: Column, text: Column, docs: DataFrame) -> tuple[Column, int]:
    """Number of the range of a row, rising with (key, text), and how many ranges an interval has.

    Rows without an id have the ranges below 0."""
    missing = key == _FIRST
    head = F.rpad(F.hex(F.substring(text.cast("binary"), 1, 7)), 14, "0")
    head = F.conv(head, 16, 10).cast("long")
    low, high, rows, cuts, heads = docs.agg(
        F.min(F.when(~missing, key)), F.max(F.when(~missing, key)), F.count(F.lit(1)),
        _quantiles(F.when(~missing, key)), _quantiles(F.when(missing, head)),
    ).first()
    low, high, cuts, heads = low or 0, high or 0, sorted(set(cuts or [])), sorted(set(heads or []))
    parts = max(1, -(-rows // (CUTS * ROWS_PER_RANGE)))
    interval = _interval(key, cuts)
    edges = F.lit([float(x) for x in (low, *cuts, high)])
    start, stop = F.get(edges, interval), F.get(edges, interval + 1)
    part = F.floor((key.cast("double") - start) / F.greatest(stop - start, F.lit(1.0)) * parts)
    part = F.least(part, F.lit(parts - 1))
    none = (_interval(head, heads) - (CUTS + 1)) * parts
    return F.when(missing, none).otherwise(interval * parts + part).cast("long"), parts


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, anchors, next_text, next_anchors; next by ascending id, cyclic."""
    kind = docs.schema["doc_id"].dataType
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(_FIRST))
    base = docs.select(key.alias("key"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    number, parts = _range(F.col("key"), F.col("text"), base)
    rows = base.withColumn("range", number).repartition("range").sortWithinPartitions("range", "key", "text")
    order = Window.partitionBy("range").orderBy("key", "text")
    dealt = rows.select("key", "text", "range", anchor_hashes(F.col("text")).alias("anchors"))
    dealt = dealt.withColumn("next", F.lead(F.struct("text", "anchors")).over(order))
    # the first text of each range, out of the same shuffle
    heads = rows.withColumn("place", F.row_number().over(order)).where("place = 1").select("range", F.col("text").alias("head"))
    # the range after each: inside its interval, else the first of the next interval that has any
    held = base.select(number.alias("range")).distinct().withColumn("interval", F.floor(F.col("range") / parts))
    firsts = held.groupBy("interval").agg(F.min("range").alias("first"))
    follow = Window.orderBy("interval")  # at most 2 * CUTS + 1 rows
    whole = follow.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = firsts.select("interval", F.coalesce(F.lead("first").over(follow), F.first("first").over(whole)).alias("first"))
    inside = F.lead("range").over(Window.partitionBy("interval").orderBy("range"))
    after = held.withColumn("inside", inside).join(firsts, "interval").select(
        F.col("range").alias("of"), F.coalesce("inside", "first").alias("range"))
    first = after.join(heads, "range").select("of", "head", anchor_hashes(F.col("head")).alias("head_anchors"))
    joined = dealt.join(first, F.col("range") == F.col("of"), "left")
    last = F.col("next").isNull()
    return joined.select(
        F.when(F.col("range") >= 0, F.col("key").cast(kind)).alias("doc_id"), "text", "anchors",
        F.when(last, F.col("head")).otherwise(F.col("next.text")).alias("next_text"),
        F.when(last, F.col("head_anchors")).otherwise(F.col("next.anchors")).alias("next_anchors"),
    )


def half_replaced(text: Column, other: Column) -> Column:
    """``text`` whose last half is replaced by as many first code points of ``other``."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(other, F.lit(1), half))


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and their likenesses."""
    pairs = with_next(docs).withColumn("edited", half_replaced(F.col("text"), F.col("next_text")))
    pairs = pairs.withColumn("edited_anchors", anchor_hashes(F.col("edited")))
    return pairs.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_string(F.col("anchors")).alias("fingerprint"),
        as_string(F.col("edited_anchors")).alias("edited_fingerprint"),
        likeness(F.col("anchors"), F.col("edited_anchors")).alias("near_edited"),
        likeness(F.col("anchors"), F.col("next_anchors")).alias("near_next"),
    )
