"""Mixing sources to target weights by hash thresholds.

Every document has a fixed 32-bit hash of its id. Tokens are summed by source
and the upper hash bits; the running sum finds, per source, the bucket in
which the budget ends. Only that bucket is split again by the next bits, twice,
until the threshold is exact on 32 bits. Documents are then taken by comparing
their hash with the threshold: nothing is sorted, a larger budget takes a
superset of a smaller one, and reruns agree.

Targets: sources in code point order (null last) weigh 5, 2, 1, repeating, and
share 150 % of all tokens; no source is taken more than twice, and what exceeds
that is shared again by weight.

Defined cases: a null text has size 0, is taken ``floor(target / source
size)`` times or once more like any other; a null source is a source of its
own; a null id hashes as ``null``; rows with the same id share their hash and
are taken together; an empty table gives an empty mix; columns other than the
named ones pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobtally.llm.common import word_count, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
#: bits of the hash resolved by each histogram
LEVELS = (12, 12, 8)
_SPLIT = 16


def hash32(doc_id: Column) -> Column:
    """32 bits of the digest of the id, as a non-negative long."""
    text = F.concat(F.lit("mix:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target from (source, size) rows.

    The capped sources are those with the least ``cap / weight``: in that
    order, each source is tested against the level that remains once those
    before it have taken their cap. One row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (place % len(WEIGHTS) + 1).cast("int"))
    per = per.select("source", "source_size", weight.cast("double").alias("weight"))
    everything = Window.partitionBy()
    turn = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = turn.rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(
        "*",
        F.sum("source_size").over(everything).cast("double").alias("total"),
        F.sum("weight").over(everything).alias("weights"),
        F.coalesce(F.sum("source_size").over(earlier), F.lit(0)).cast("double").alias("size_before"),
        F.coalesce(F.sum("weight").over(earlier), F.lit(0.0)).alias("weight_before"),
    )
    level = (SHARE * F.col("total") - MOST * F.col("size_before")) / (F.col("weights") - F.col("weight_before"))
    per = per.select("source", "source_size", "weight", level.alias("level"))
    free = F.when(F.col("level") * F.col("weight") <= MOST * F.col("source_size"), F.col("level"))
    # the level at the first source that stays below its cap holds for all after it
    per = per.withColumn("turn", F.row_number().over(turn))
    first = F.min(F.when(free.isNotNull(), F.struct("turn", free.alias("level")))).over(everything)
    per = per.withColumn("final", first["level"])
    cap = MOST * F.col("source_size").cast("double")
    target = F.when(F.col("final").isNull(), cap).otherwise(F.least(cap, F.col("final") * F.col("weight")))
    return per.select("source", "source_size", target.alias("target"))


def thresholds(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """source, source_size, target, passes, threshold: a document is taken
    ``passes`` times, and once more if its hash is below the threshold."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    goal = targets.withColumn("passes", whole.cast("long"))
    goal = goal.withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
    goal = goal.select("source", "source_size", "target", "passes", "rest",
                       F.lit(0).cast("long").alias("low"), F.lit(0).cast("long").alias("below"))
    shift = sum(LEVELS)
    for bits in LEVELS:
        width, shift = shift, shift - bits
        key = goal.select(F.col("source").alias("s"), F.shiftright("low", width).alias("within"), "rest", "below")
        bucket = (
            sizes.join(key, F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("hash", width) == F.col("within")))
            .groupBy("s", F.shiftright("hash", shift).alias("bucket"))
            .agg(F.sum("size").alias("words"), F.first("rest").alias("rest"), F.first("below").alias("below"))
        )
        run = F.col("below") + F.sum("words").over(Window.partitionBy("s").orderBy("bucket"))
        bucket = bucket.withColumn("run", run)
        # buckets wholly inside the budget; the next one holds its end
        edge = bucket.groupBy("s").agg(
            F.min(F.when(F.col("run") > F.col("rest"), F.struct("bucket", (F.col("run") - F.col("words")).alias("run")))).alias("edge"),
            F.max("bucket").alias("top"),
            F.max("run").alias("run"),
        )
        edge = edge.select(
            F.col("s").alias("s"),
            F.shiftleft(F.coalesce(F.col("edge.bucket"), F.col("top") + 1), shift).alias("new_low"),
            F.coalesce(F.col("edge.run"), F.col("run")).cast("long").alias("new_below"),
            *([F.col("edge.bucket").isNotNull().alias("open")]),
        )
        goal = goal.join(edge, F.col("source").eqNullSafe(F.col("s")), "left").select(
            "source", "source_size", "target", "passes", "rest",
            F.coalesce("new_low", "low").alias("low"), F.coalesce("new_below", "below").alias("below"),
        )
        goal = written(goal, "mixing")
    # one hash value further if that ends nearer to the target
    at = goal.select(F.col("source").alias("s"), F.col("low").alias("at"))
    step = (
        sizes.join(at, F.col("source").eqNullSafe(F.col("s")) & (F.col("hash") == F.col("at")))
        .groupBy("s").agg(F.sum("size").alias("step"))
    )
    goal = goal.join(step, F.col("source").eqNullSafe(F.col("s")), "left")
    over = F.col("below") + F.col("step") - F.col("rest")
    nearer = F.coalesce(over < F.col("rest") - F.col("below"), F.lit(False))
    return goal.select("source", "source_size", "target", "passes",
                       (F.col("low") + nearer.cast("long")).alias("threshold"))


def mix(docs: DataFrame) -> DataFrame:
    """``docs`` with mix_size, mix_source_size, mix_target and mix_passes (how often the mix takes the row)."""
    keyed = docs.withColumns({"mix_size": word_count(F.col("text")), "mix_hash": hash32(F.col("doc_id"))})
    sizes = written(keyed.select("source", F.col("mix_size").alias("size"), F.col("mix_hash").alias("hash")), "mixing")
    found = thresholds(sizes, source_targets(sizes))
    # a hot source meets its threshold in several partitions, by the upper hash bits
    piece = F.explode(F.sequence(F.lit(0), F.lit(_SPLIT - 1))).alias("mix_piece")
    found = found.select(
        F.col("source").alias("mix_source"), F.col("source_size").alias("mix_source_size"),
        F.col("target").alias("mix_target"), F.col("passes").alias("mix_whole"),
        F.col("threshold").alias("mix_threshold"), piece,
    )
    bits = sum(LEVELS) - _SPLIT.bit_length() + 1
    joined = keyed.join(
        found,
        F.col("source").eqNullSafe(F.col("mix_source")) & (F.shiftright("mix_hash", bits) == F.col("mix_piece")),
    )
    passes = F.col("mix_whole") + (F.col("mix_hash") < F.col("mix_threshold")).cast("long")
    return joined.withColumn("mix_passes", passes).drop("mix_hash", "mix_source", "mix_whole", "mix_threshold", "mix_piece")


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken."""
    names = docs.columns
    out = mix(docs).where(F.col("mix_passes") > 0)
    out = out.withColumn("mix_pass", F.explode(F.sequence(F.lit(1).cast("long"), F.col("mix_passes"))))
    return out.select(*[F.col(f"`{n}`") for n in names])


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT AS hash
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight FROM s),
l AS (
  SELECT *, row_number() OVER (ORDER BY source_size::DOUBLE / weight, source ASC NULLS LAST) AS turn,
         (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE - 2 * coalesce(sum(source_size) OVER before, 0)::DOUBLE)
            / ((sum(weight) OVER ()) - coalesce(sum(weight) OVER before, 0.0)) AS level
  FROM w WINDOW before AS (ORDER BY source_size::DOUBLE / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, first(CASE WHEN level * weight <= 2 * source_size THEN level END IGNORE NULLS)
              OVER (ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS final FROM l),
t AS (
  SELECT source, source_size,
         CASE WHEN final IS NULL THEN 2 * source_size::DOUBLE ELSE least(2 * source_size::DOUBLE, final * weight) END AS target
  FROM f),
g AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS passes FROM t),
r AS (SELECT *, target - passes * source_size AS rest FROM g),
h AS (SELECT source, hash, sum(size) AS words FROM d GROUP BY ALL),
c AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY hash) AS run FROM h),
k AS (
  SELECT r.source, coalesce(min(CASE WHEN run > rest THEN hash END), max(hash) + 1) AS low,
         coalesce(max(CASE WHEN run <= rest THEN run END), 0) AS below
  FROM r JOIN c ON r.source IS NOT DISTINCT FROM c.source GROUP BY r.source),
x AS (
  SELECT r.source, r.source_size, r.target, r.passes,
         k.low + CASE WHEN coalesce(k.below + h.words - r.rest < r.rest - k.below, FALSE) THEN 1 ELSE 0 END AS threshold
  FROM r JOIN k ON r.source IS NOT DISTINCT FROM k.source
  LEFT JOIN h ON h.source IS NOT DISTINCT FROM k.source AND h.hash = k.low)
SELECT d.doc_id, d.size, x.source_size, x.target,
       (d.size * (x.passes + CASE WHEN d.hash < x.threshold THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN x ON d.source IS NOT DISTINCT FROM x.source
"""
