"""The trie of the prefixes that conversations share, with subtree sums by centroid decomposition.

1. Turns become rows (digest, code points) in the order of their conversation.
   They are dealt by ranges of (conversation, order), so a long conversation
   lies in many tasks; a place in a conversation is the place in its range plus
   what the ranges before hold. Only conversations that a border cuts need that
   (at most two rows for each range: a table of proven size, broadcast).
2. A prefix is named by its length and the XOR of two 64-bit hashes of every
   (turn, place) in it, which adds up over ranges like the places do. Equal
   names are one node; a node is known by its smallest member and its depth.
3. ``n_convs`` of a node and of all nodes below it (its weight) come out of the
   same grouping. Subtree sums come from a centroid decomposition: the nodes of
   a component that hold more than half of its weight are a path from its top,
   whose lowest node is the centroid. The sum of what is below the centroid,
   itself included, is added to every node of that path; the path loses the
   centroid's weight, each child of the centroid heads a component of its own,
   and all go on with at most half of the weight, whatever the shape: one
   conversation of any length takes no more rounds than a broad tree.
   Components of more than ``LOCAL`` nodes are split by joins over all tasks,
   smaller ones by the same steps in numpy, many at a time.

Defined cases: rows are ordered by turn (null first), rows of one turn by the
digest of role and text; a null role or text is empty; rows without a conv_id
are one conversation, above all others in order, whose id is null and its
decimal form empty; ``c % 100`` has the sign of c; repeated rows count each; an
empty table has no nodes, not even the root; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobtally.llm.common import content_digest, crc32_sql, missing_id, written

#: larger components are split by Spark
LOCAL = 1 << 16
#: tables of more rows are joined by shuffle
BROADCAST_ROWS = 100_000
HEADS = 5
PIECE = 1 << 14


def turns(conversations: DataFrame, null_id: int | None) -> DataFrame:
    """conv, turn, what (digest of role and text), chars of every row."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    return conversations.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(null_id).cast("long")).alias("conv"), F.col("turn").cast("long").alias("turn"),
        content_digest(role, text).alias("what"), F.length(text).cast("long").alias("chars"))


def _id_text(conv: Column, null_id: int | None) -> Column:
    text = conv.cast("string")
    return text if null_id is None else F.when(conv != null_id, text).otherwise("")


def with_shared_heads(rows: DataFrame, null_id: int | None) -> DataFrame:
    """Rows (with ``own`` false) of the first turns that a conversation takes from the first of its hundred.

    ``skip``: how many of its own turns a conversation gives up for them.
    """
    conv = F.col("conv")
    base = conv - conv % 100
    skip = F.crc32(_id_text(conv, null_id).cast("binary")) % (HEADS + 1)
    own_base = conv == base
    if null_id is not None:
        own_base |= conv == null_id
    rows = rows.withColumn("skip", F.when(own_base, F.lit(0)).otherwise(skip).cast("long"))
    order = Window.partitionBy("conv").orderBy("turn", "what")
    first = rows.where(conv % 100 == 0) if null_id is None else rows.where((conv % 100 == 0) & (conv != null_id))
    first = first.withColumn("nth", F.row_number().over(order).cast("long")).where(F.col("nth") <= HEADS)
    first = first.select(F.col("conv").alias("base"), "nth", "what", "chars")
    takers = rows.where("skip > 0").select("conv", "skip", base.alias("base")).distinct()
    heads = takers.join(first, "base").where("nth <= skip")
    heads = heads.select("conv", F.lit(False).alias("own"), F.col("nth").alias("turn"), "what", "chars", "skip", F.lit(0).cast("long").alias("tie"))
    # equal rows are told apart by where they were read, so that ranges can part them
    own = rows.select("conv", F.lit(True).alias("own"), "turn", "what", "chars", "skip", F.monotonically_increasing_id().alias("tie"))
    return own.unionByName(heads)


def paths(rows: DataFrame) -> DataFrame:
    """conv, depth, x, y (name of the prefix), px, py (of its parent), chars, length.

    One row per turn of a conversation, and one of depth 0 for each conversation.
    """
    keys = ["conv", "own", "turn", "what", "tie"]
    rows = written(rows.repartitionByRange(*keys).withColumn("part", F.spark_partition_id()), "turns")
    parts = rows.groupBy("part", "conv").agg(F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("own")).alias("heads"))
    cut = parts.join(parts.groupBy("conv").agg(F.count(F.lit(1)).alias("parts")).where("parts > 1"), "conv")
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv")
    cut = written(cut.select(
        "part", "conv", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("rows").over(whole).alias("all_rows"), F.sum("heads").over(whole).alias("all_heads")), "cut")
    here = Window.partitionBy("part", "conv")
    rows = rows.withColumns({
        "at": F.row_number().over(here.orderBy("own", "turn", "what", "tie")), "n": F.count(F.lit(1)).over(here),
        "heads": F.count_if(~F.col("own")).over(here)})
    # at most two conversations cut by each border of a range
    rows = rows.join(F.broadcast(cut), ["part", "conv"], "left").select(
        "part", "conv", "own", "skip", "what", "chars", (F.col("at") + F.coalesce("rows_before", F.lit(0))).alias("at"),
        F.coalesce("all_rows", "n").alias("n"), F.coalesce("all_heads", "heads").alias("heads"))
    kept = ~F.col("own") | (F.col("at") - F.col("heads") > F.col("skip"))
    depth = F.when(kept, F.when(F.col("own"), F.col("at") - F.col("skip")).otherwise(F.col("at"))).otherwise(0)
    rows = rows.withColumn("depth", depth)
    hashed = {"hx": F.xxhash64("what", "depth"), "hy": F.xxhash64(F.lit("y"), "depth", "what")}
    rows = rows.withColumns({c: F.when(F.col("depth") > 0, h).otherwise(F.lit(0).cast("long")) for c, h in hashed.items()})
    along = here.orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({"x": F.bit_xor("hx").over(along), "y": F.bit_xor("hy").over(along)})
    length = F.col("heads") + F.greatest(F.col("n") - F.col("heads") - F.col("skip"), F.lit(0))
    rows = written(rows.select("part", "conv", "at", "depth", "chars", "hx", "hy", "x", "y", length.alias("length")), "prefixes")
    sums = rows.join(F.broadcast(cut.select("part", "conv")), ["part", "conv"], "left_semi").groupBy("part", "conv").agg(
        F.bit_xor("hx").alias("hx"), F.bit_xor("hy").alias("hy"))
    sums = sums.select("part", "conv", *(F.coalesce(F.bit_xor(f"h{c}").over(before), F.lit(0).cast("long")).alias(f"{c}_before") for c in "xy"))
    sums = F.broadcast(written(sums, "cut"))
    named = rows.join(sums, ["part", "conv"], "left")
    for c in "xy":
        named = named.withColumn(c, F.col(c).bitwiseXOR(F.coalesce(f"{c}_before", F.lit(0).cast("long"))))
    zero = F.lit(0).cast("long")
    turn = named.where("depth > 0").select(
        "conv", "depth", "x", "y", F.col("x").bitwiseXOR(F.col("hx")).alias("px"), F.col("y").bitwiseXOR(F.col("hy")).alias("py"), "chars", "length")
    root = rows.where("at = 1").select("conv", zero.alias("depth"), *(zero.alias(c) for c in ("x", "y", "px", "py", "chars")), "length")
    return turn.unionByName(root)


def _spread(rows: DataFrame, other: DataFrame, keys: list[str], count: int) -> DataFrame:
    """``rows`` joined with a table of ``count`` rows: broadcast if it is small, else by shuffle, where
    adaptive execution splits the rows of a large key."""
    return rows.join(F.broadcast(other) if count <= BROADCAST_ROWS else other, keys)


def decompose(top: np.ndarray, parent: np.ndarray, depth: np.ndarray, weight: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of ``values`` (nodes x columns) over the subtrees of a forest.

    ``top`` and ``parent`` are places of nodes (a topmost node's parent is not
    looked at), ``weight`` is that of a node's subtree.
    """
    label, weight, out = top.copy(), weight.copy(), np.zeros_like(values)
    height = depth - depth[top]
    centroid = np.full(len(top), -1)
    alive = np.argsort(height, kind="stable")
    while len(alive):
        heavy = alive[2 * weight[alive] > weight[label[alive]]]
        centroid[label[heavy]] = heavy  # the lowest one comes last
        mine = centroid[label]
        # who hangs below the centroid goes with that child of it
        new = label.copy()
        for level in np.split(alive, np.flatnonzero(np.diff(height[alive])) + 1):
            level = level[label[level] != level]
            new[level] = np.where(parent[level] == mine[level], level, new[parent[level]])
        below = alive[(new[alive] != label[alive]) | (alive == mine[alive])]
        sums = np.zeros_like(values)
        np.add.at(sums, label[below], values[below])
        out[heavy] += sums[label[heavy]]
        rest = heavy[heavy != mine[heavy]]
        weight[rest] -= weight[mine[rest]]
        alive = alive[alive != mine[alive]]
        label = new
    return out


NODE = "c long, depth long, leaves long, saved long"


def _sums_inside(state: DataFrame) -> DataFrame:
    """c, depth, leaves, saved (sums over subtrees) of the nodes of components that fit a task."""
    columns = ["tc", "td", "depth", "c", "pc", "w", "leaf", "own", "leaves", "saved"]
    rows = state.select(*columns).repartition("tc", "td").sortWithinPartitions("tc", "td", "depth")

    def solve(cols: list[np.ndarray]) -> pa.RecordBatch:
        tc, td, depth, c, pc, w, leaf, own, leaves, saved = cols
        new = np.concatenate([[True], (tc[1:] != tc[:-1]) | (td[1:] != td[:-1])])
        top = np.flatnonzero(new)[np.cumsum(new) - 1]
        # a parent is found by (conversation, depth)
        order = np.lexsort((depth, c))
        ids, at = np.unique(c, return_inverse=True)
        key = at * (depth.max() + 2) + depth
        place = np.minimum(np.searchsorted(ids, pc), len(ids) - 1)
        parent = order[np.minimum(np.searchsorted(key[order], place * (depth.max() + 2) + depth - 1), len(c) - 1)]
        sums = decompose(top, parent, depth, w, np.stack([leaf, own], axis=1))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (c, depth, leaves + sums[:, 0], saved + sums[:, 1])],
                                          names=["c", "depth", "leaves", "saved"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * len(columns)
        for batch in batches:
            held = [np.concatenate([h, np.asarray(batch.column(i))]) for i, h in enumerate(held)]
            if len(held[0]) < 2 * LOCAL:
                continue
            # the last component may go on in the next batch
            high = int(np.flatnonzero((held[0] != held[0][-1]) | (held[1] != held[1][-1]))[-1]) + 1
            yield solve([h[:high] for h in held])
            held = [h[high:] for h in held]
        if len(held[0]):
            yield solve(held)

    return rows.mapInArrow(run, NODE)


def subtree_sums(nodes: DataFrame, up: DataFrame, local: int = LOCAL) -> DataFrame:
    """c, depth, leaves, saved: sums of ``leaf`` and ``own`` over the subtree of every node.

    ``nodes``: c, depth, pc (the parent's c), tc, td (the top of its tree), w (weight of its subtree),
    leaf, own. ``up``: conv, depth, rep, prep: the node at that depth of a
    conversation and its parent, where the parent is not the conversation's own.
    """
    zero = F.lit(0).cast("long")
    state = nodes.withColumns({"leaves": zero, "saved": zero})
    done = []
    while True:
        sizes = state.groupBy("tc", "td").agg(F.count(F.lit(1)).alias("nodes"), F.max("w").alias("total"))
        large = written(sizes.where(F.col("nodes") > local), "components")
        count = large.count()
        if not count:
            done.append(_sums_inside(state))
            break
        at = ["tc", "td"]
        fits = state.join(F.broadcast(large.select(*at)) if count <= BROADCAST_ROWS else large.select(*at), at, "left_anti")
        done.append(_sums_inside(fits))
        state = written(_spread(state, large.select(*at, "total"), at, count).withColumn("heavy", 2 * F.col("w") > F.col("total")), "state")
        centroid = state.where("heavy").groupBy(*at).agg(
            F.max("depth").alias("dc"), F.max_by("c", "depth").alias("cc"), F.max_by("w", "depth").alias("wc"))
        state = _spread(state, written(centroid, "centroids"), at, count).withColumn("next", F.col("dc") + 1)
        # the node's ancestor just below the centroid's depth
        seen = up.select(F.col("conv").alias("c"), F.col("depth").alias("next"), "rep", "prep")
        state = state.join(seen, ["c", "next"], "left")
        hit = (F.col("c") == F.col("cc")) & (F.col("depth") == F.col("dc"))
        under = (F.col("depth") > F.col("dc")) & (F.coalesce("prep", "c") == F.col("cc"))
        state = written(state.withColumns({"hit": hit, "under": under}), "state")
        sums = state.where("hit or under").groupBy(*at).agg(F.sum("leaf").alias("more_leaves"), F.sum("own").alias("more_own"))
        state = _spread(state, written(sums, "sums"), at, count)
        state = state.select(
            "c", "depth", "pc", F.when(F.col("under"), F.coalesce("rep", "c")).otherwise(F.col("tc")).alias("tc"),
            F.when(F.col("under"), F.col("next")).otherwise(F.col("td")).alias("td"),
            F.when(F.col("heavy") & ~F.col("hit"), F.col("w") - F.col("wc")).otherwise(F.col("w")).alias("w"), "leaf", "own",
            (F.col("leaves") + F.when(F.col("heavy"), F.col("more_leaves")).otherwise(0)).alias("leaves"),
            (F.col("saved") + F.when(F.col("heavy"), F.col("more_own")).otherwise(0)).alias("saved"), "hit")
        state = written(state, "state")
        done.append(state.where("hit").select("c", "depth", "leaves", "saved"))
        state = state.where("not hit").drop("hit")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def joined_ids(ends: DataFrame, null_id: int | None) -> DataFrame:
    """c, depth, ends_sha256 of the comma-joined ids ``conv`` that end at a node, in order.

    Ranges of (node, id) make texts of at most ``PIECE`` ids first, so that a
    frequent end is a few rows where its pieces are hashed one after the other.
    """
    keys = ["c", "depth", "conv"]
    ranged = ends.select(*keys).repartitionByRange(*keys).sortWithinPartitions(*keys)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 32
        for batch in batches:
            c, depth, conv = (np.asarray(batch.column(i)) for i in range(3))
            rows = []
            for same in np.split(np.arange(len(c)), np.flatnonzero(np.diff(c) | np.diff(depth)) + 1):
                for low in range(0, len(same), PIECE):
                    part = same[low:low + PIECE]
                    at += 1
                    rows.append((c[part[0]], depth[part[0]], at, ",".join("" if x == null_id else str(x) for x in conv[part].tolist())))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)] if rows else [pa.array([], t) for t in (
                pa.int64(), pa.int64(), pa.int64(), pa.string())], names=["c", "depth", "at", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state, out = None, None, []
        for batch in batches:
            for c, depth, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                if (c, depth) == last:
                    state.update(b",")
                else:
                    if last is not None:
                        out.append((*last, state.hexdigest()))
                    last, state = (c, depth), hashlib.sha256()
                state.update(ids.encode())
            if out:
                yield _ends(out)
                out = []
        if last is not None:
            yield _ends([(*last, state.hexdigest())])

    texts = ranged.mapInArrow(pieces, "c long, depth long, at long, ids string")
    texts = texts.repartition("c", "depth").sortWithinPartitions("c", "depth", "at")
    return texts.mapInArrow(digest, "c long, depth long, ends_sha256 string")


def _ends(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], names=["c", "depth", "ends_sha256"])


def prefix_trie(conversations: DataFrame, local: int = LOCAL) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    null_id = missing_id(conversations, "conv_id")
    along = written(paths(with_shared_heads(turns(conversations, null_id), null_id)), "paths")
    name = ["x", "y", "depth"]
    weight = F.sum(F.col("length") - F.col("depth") + 1)
    nodes = along.groupBy(*name, "px", "py", "chars").agg(F.min("conv").alias("c"), F.count(F.lit(1)).alias("n_convs"), weight.alias("w"))
    nodes = written(nodes, "nodes")
    above = nodes.select(F.col("x").alias("px"), F.col("y").alias("py"), (F.col("depth") + 1).alias("depth"), F.col("c").alias("pc"))
    below = nodes.where("depth > 0").groupBy(F.col("px").alias("x"), F.col("py").alias("y"), (F.col("depth") - 1).alias("depth"))
    nodes = nodes.join(above, ["px", "py", "depth"], "left").join(below.agg(F.count(F.lit(1)).alias("n_children")), name, "left")
    nodes = written(nodes.select(*name, "c", "pc", "n_convs", "w", "chars", F.coalesce("n_children", F.lit(0)).alias("n_children")), "nodes")
    placed = along.select("conv", *name, "length").join(nodes.select(*name, F.col("c").alias("rep"), F.col("pc").alias("prep")), name)
    placed = written(placed.select("conv", "depth", "length", "rep", "prep"), "placed")
    root = nodes.agg(F.min("c")).first()[0]
    zero = F.lit(0).cast("long")
    state = nodes.select("c", "depth", "pc", F.lit(root).cast("long").alias("tc"), zero.alias("td"), "w",
                         (F.col("n_children") == 0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("chars")).alias("own"))
    state = written(state.withColumn("pc", F.coalesce("pc", "c")), "state")
    sums = subtree_sums(state, placed.where("prep != conv").select("conv", "depth", "rep", "prep"), local)
    ends = joined_ids(placed.where("depth = length").select(F.col("rep").alias("c"), "depth", "conv"), null_id)
    out = nodes.join(sums, ["c", "depth"]).join(ends, ["c", "depth"], "left")
    shown = lambda c: F.col(c) if null_id is None else F.when(F.col(c) != null_id, F.col(c))
    return out.select(
        shown("c").alias("conv_id"), "depth", shown("pc").alias("parent_conv_id"), "n_convs", "n_children",
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"))


#: rows without an id are not in the test tables; the SQL leaves them out
ORACLE = f"""
WITH ids AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, {crc32_sql("CAST(conv_id AS VARCHAR)")} % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM conversations)),
turns AS (
  SELECT conv_id, length(text) AS chars, sha256(strlen(role) || ':' || role || text) AS what,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(role) || ':' || role || text)) AS i
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations)),
rebuilt AS (
  SELECT ids.conv_id, i, what, chars FROM ids JOIN turns ON turns.conv_id = base AND i <= h
  UNION ALL SELECT conv_id, i, what, chars FROM turns JOIN ids USING (conv_id) WHERE i > h),
paths AS (
  SELECT conv_id, chars, row_number() OVER w AS depth, string_agg(what, '') OVER w AS prefix
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY i)
  UNION ALL SELECT conv_id, 0, 0, '' FROM ids),
ends AS (
  SELECT prefix, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS list
  FROM (SELECT conv_id, arg_max(prefix, depth) AS prefix FROM paths GROUP BY conv_id) GROUP BY prefix),
nodes AS (SELECT prefix, depth, chars, min(conv_id) AS conv_id, count(*) AS n_convs FROM paths GROUP BY ALL),
children AS (SELECT left(prefix, 64 * (depth - 1)) AS prefix, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
own AS (SELECT nodes.*, coalesce(n, 0) AS n_children, (n_convs - 1) * chars AS saved FROM nodes LEFT JOIN children USING (prefix)),
sums AS (
  SELECT left(prefix, 64 * d) AS prefix, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT *, unnest(range(depth + 1)) AS d FROM own) GROUP BY ALL)
SELECT own.conv_id, CAST(own.depth AS BIGINT) AS depth, above.conv_id AS parent_conv_id, own.n_convs, own.n_children, n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(list, '')) AS ends_sha256
FROM own JOIN sums USING (prefix) LEFT JOIN ends USING (prefix)
LEFT JOIN own above ON own.depth > 0 AND above.prefix = left(own.prefix, 64 * (own.depth - 1))
"""
