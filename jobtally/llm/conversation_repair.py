"""Cheapest repair of the role structure of conversations by rank-convergence parallel Viterbi.

A conversation is right when the initials of its roles read ``(s?(ua)+)?``.
Edits in order: Keep a row (costs 0), Rerole it to user or assistant (1),
Delete it (2; the only edit of a blank or repeated row), Insert a user or
assistant row without text (5); a truncated row that stays adds 5. Of the
cheapest audits (the edits' initials) the least by ASCII is taken. The initials
fix all states, so an audit says everything about its repair.

1. Rows with the same conversation, turn and content are one line with a count.
   The first line of a content in a conversation is live; all other rows can
   only be deleted and do not change the state, so only live lines are searched.
2. Lines are dealt by ranges of (conversation, turn, content), and the live ones
   of a conversation are cut into chunks of ``CHUNK``: a long conversation lies
   in many chunks and tasks.
3. Every chunk runs backwards through the four states, from the vector of costs
   that an end of a conversation has: right for a last chunk, speculation for
   others. In a fix-up pass a chunk whose true vector (the start of the next
   chunk) differs by more than a constant runs again, beside its old run, until
   the two vectors differ only by a constant: from there on the old run holds,
   moved by it. Passes go on until no chunk needs one. Chunks that still change
   after ``PASSES`` give their map of vectors instead (a run from each state),
   and the maps are applied one after the other.
4. With the true vectors each chunk is traced from all four states; the ends
   are put together along the conversation, and a last trace from the true
   state gives the letters. The stream of a conversation's rows then takes its
   letters, one after the other, for the audit and the repaired rows.

Defined cases: a null role or text is one space (a role that is neither s, u
nor a at its start, and a blank text); an empty role has no initial that could
be kept; rows without a conv_id are one conversation; rows of one turn (null
first) are ordered by the digest of role and text; repeated rows are
duplicates; a conversation without rows (``copies`` 0) has zeros, an empty audit
and the hash of the empty text; gaps that exceed a long are null; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobtally.llm.common import content_digest, crc32_sql, missing_id, word_count, written

CHUNK = 1 << 16
PASSES = 4
#: symbols held at a time in a task
SYMBOLS = 1 << 18
FAR = 1 << 40

LEGAL = ("su", "ua", "au")
START, SYSTEM, USER, ASSISTANT = range(4)
#: where a kept initial (s, u, a, other) leads from each state; -1: nowhere
KEPT = np.array([[SYSTEM, USER, -1, -1], [-1, USER, -1, -1], [-1, -1, ASSISTANT, -1], [-1, USER, -1, -1]])
#: where a user or assistant row leads from each state
TURN = np.array([USER, USER, ASSISTANT, USER])
ENDS = (START, ASSISTANT)


class Costs:
    """Costs of the edits and, from them, of the steps between states."""

    def __init__(self, rerole: int = 1, delete: int = 2, insert: int = 5, truncated: int = 5):
        self.rerole, self.delete, self.insert, self.truncated = rerole, delete, insert, truncated
        free = np.full((4, 4), FAR)
        np.fill_diagonal(free, 0)
        step = free.copy()
        step[np.arange(4), TURN] = insert
        #: least cost of inserts from state to state
        self.inserts = self.then(step, self.then(step, step))
        #: what an end leaves to pay in each state
        end = np.full(4, FAR)
        end[list(ENDS)] = 0
        self.end = (self.inserts + end).min(axis=1)
        #: cost of a row (initial + 4 if truncated) from state to state: deleted, kept, reroled
        self.delete_to, self.keep_to, self.rerole_to = (np.full((8, 4, 4), FAR) for _ in range(3))
        for kind in range(8):
            initial, more = kind % 4, truncated * (kind // 4)
            for state in range(4):
                self.delete_to[kind, state, state] = delete
                self.rerole_to[kind, state, TURN[state]] = rerole + more
                if KEPT[state, initial] >= 0:
                    self.keep_to[kind, state, KEPT[state, initial]] = more
        row = np.minimum(np.minimum(self.delete_to, self.keep_to), self.rerole_to)
        self.steps = np.stack([self.then(self.inserts, m) for m in row])

    @staticmethod
    def then(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), FAR)


def _padded(kinds: list[np.ndarray]) -> np.ndarray:
    """Chunks as rows, aligned at their ends; 8 where a chunk has not begun."""
    width = max(map(len, kinds), default=0)
    out = np.full((len(kinds), width), 8, np.int8)
    for row, k in zip(out, kinds):
        row[width - len(k):] = k
    return out


def backward(costs: Costs, kinds: np.ndarray, end: np.ndarray, keep: bool = False):
    """Cost vectors at the starts of padded chunks, from those at their ends; with ``keep`` at every place."""
    steps = np.concatenate([costs.steps, np.where(np.eye(4, dtype=bool), 0, FAR)[None]])
    now = end.astype(np.int64)
    seen = [now] if keep else None
    for place in range(kinds.shape[1] - 1, -1, -1):
        now = (steps[kinds[:, place]] + now[:, None, :]).min(axis=2)
        if keep:
            seen.append(now)
    return np.stack(seen[::-1], axis=1) if keep else now


def rerun(costs: Costs, kinds: list[np.ndarray], used: np.ndarray, out: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start vectors for the new ``end`` vectors and how many rows it took to get them.

    ``out`` are the start vectors for the ends ``used``; both runs go on until they differ by a constant.
    """
    rows = _padded(kinds)
    steps = np.concatenate([costs.steps, np.where(np.eye(4, dtype=bool), 0, FAR)[None]])
    old, new, result, took = used.astype(np.int64), end.astype(np.int64), out.copy(), np.zeros(len(kinds), np.int64)
    open_ = np.arange(len(kinds))
    for place in range(rows.shape[1] - 1, -2, -1):
        by = new[open_] - old[open_]
        same = (by == by[:, :1]).all(axis=1)
        result[open_[same]] = out[open_[same]] + by[same, :1]
        open_ = open_[~same]
        if not len(open_) or place < 0:
            break
        took[open_] += rows[open_, place] < 8
        step = steps[rows[open_, place]]
        old[open_] = (step + old[open_][:, None, :]).min(axis=2)
        new[open_] = (step + new[open_][:, None, :]).min(axis=2)
    result[open_] = new[open_]
    return result, took


def trace(costs: Costs, kinds: np.ndarray, vectors: np.ndarray, state: np.ndarray, last: np.ndarray) -> tuple[list[list[str]], np.ndarray, list[str]]:
    """Letters of each row, the state after the chunk, and the letters at the end (where ``last``) of padded chunks."""
    state = state.copy()
    letters = [[] for _ in state]
    every = np.arange(len(state))

    def inserted(at: np.ndarray, place: int, which: np.ndarray) -> np.ndarray:
        return which & (costs.insert + vectors[every, place, TURN[state]] == at)

    for place in range(kinds.shape[1]):
        kind = kinds[:, place]
        todo = kind < 8
        row = np.where(todo, kind, 0)
        before = [""] * len(state)
        while todo.any():
            at = vectors[every, place, state]
            after = vectors[:, place + 1]
            gone = todo & (costs.delete + after[every, state] == at)
            insert = inserted(at, place, todo & ~gone)
            kept = KEPT[state, row % 4]
            more = costs.truncated * (row // 4)
            keep = todo & ~gone & ~insert & (kept >= 0) & (more + after[every, np.maximum(kept, 0)] == at)
            rerole = todo & ~gone & ~insert & ~keep
            for i in np.flatnonzero(insert):
                before[i] += "I"
            for letter, which in (("D", gone), ("K", keep), ("R", rerole)):
                for i in np.flatnonzero(which):
                    letters[i].append(before[i] + letter)
            state = np.where(insert | rerole, TURN[state], np.where(keep, kept, state))
            todo = insert
    tails = [""] * len(state)
    place = kinds.shape[1]
    while True:
        at = vectors[every, place, state]
        insert = inserted(at, place, last & (at > 0))
        if not insert.any():
            break
        for i in np.flatnonzero(insert):
            tails[i] += "I"
        state = np.where(insert, TURN[state], state)
    return letters, state, tails


def _groups(kinds: pa.ListArray) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """Slices of a column of chunks with at most about ``SYMBOLS`` places when padded."""
    lengths = np.asarray(kinds.value_lengths())
    low = 0
    while low < len(lengths):
        high, width = low + 1, lengths[low]
        while high < len(lengths) and max(width, lengths[high]) * (high + 1 - low) <= SYMBOLS:
            width = max(width, lengths[high])
            high += 1
        part = kinds.slice(low, high - low)
        yield low, high, np.split(np.asarray(part.flatten()), np.cumsum(lengths[low:high])[:-1])
        low = high


def _vectors(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, 4)


def _longs(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tolist() for r in rows], pa.list_(pa.int64()))


def _level(vectors: np.ndarray) -> np.ndarray:
    """Vectors that differ by a constant become equal."""
    return vectors - vectors[:, :1]


def _mapped(rows: DataFrame, columns: list[str], ddl: str, body) -> DataFrame:
    """``body`` over groups of chunks (first column: kinds): arrays in, arrays out; conv and at are kept."""
    names = [x.split()[0] for x in ddl.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, kinds in _groups(batch.column(2)):
                made = body(kinds, *(batch.column(i).slice(low, high - low) for i in range(3, batch.num_columns)))
                arrays = [batch.column(i).slice(low, high - low) for i in range(2)] + list(made)
                yield pa.RecordBatch.from_arrays(arrays, names=["conv", "at", *names])

    return rows.select("conv", "at", "kinds", *columns).mapInArrow(run, f"conv long, at long, {ddl}")


def _chain(rows: DataFrame, order: Column, ddl: str, columns: list[str], begin, body) -> DataFrame:
    """One value per chunk, from chunk to chunk along a conversation: few bytes for ``CHUNK`` rows."""
    rows = rows.select("conv", "at", *columns).repartition("conv").sortWithinPartitions("conv", order)
    kind = pa.list_(pa.int64()) if "array" in ddl else pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, now = object(), None
        for batch in batches:
            out = []
            for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
                if row[0] != last:
                    last, now = row[0], begin
                out.append((row[0], row[1], now))
                now = body(now, *row[2:])
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()),
                                              pa.array([r[2] for r in out], kind)], names=["conv", "at", ddl.split()[0]])

    return rows.mapInArrow(run, f"conv long, at long, {ddl}")


def true_ends(chunks: DataFrame, costs: Costs, passes: int = PASSES) -> DataFrame:
    """conv, at, end: the vector (up to a constant) at the end of each chunk of conversations of several.

    ``chunks``: conv, at, next (null for the last one), kinds.
    """
    plain = costs.end
    first = F.array(*(F.lit(int(x)) for x in plain))

    def speculate(kinds):
        start = backward(costs, _padded(kinds), np.tile(plain, (len(kinds), 1)))
        return [_longs(_level(start))]

    def fix(kinds, used, out, end):
        start, _ = rerun(costs, kinds, _vectors(used), _vectors(out), _vectors(end))
        return [_longs(_level(start))]

    def unit_runs(kinds):
        runs = [backward(costs, _padded(kinds), np.tile(np.where(np.arange(4) == s, 0, FAR), (len(kinds), 1))) for s in range(4)]
        return [_longs(np.stack(runs, axis=2).reshape(len(kinds), 16))]

    state = _mapped(chunks, [], "out array<long>", speculate).join(chunks.select("conv", "at", "next"), ["conv", "at"])
    state = written(state.select("conv", "at", "next", first.alias("used"), "out"), "vectors")
    while True:
        after = state.select("conv", F.col("at").alias("next"), F.col("out").alias("end"))
        state = state.join(after, ["conv", "next"], "left").withColumn("end", F.coalesce("end", "used"))
        open_ = state.where(F.col("end") != F.col("used"))
        if not open_.limit(1).count():
            return state.select("conv", "at", "end")
        if passes <= 0:
            break
        passes -= 1
        again = chunks.select("conv", "at", "kinds").join(open_, ["conv", "at"])
        again = _mapped(again, ["used", "out", "end"], "fixed array<long>", fix)
        state = state.join(again, ["conv", "at"], "left").select(
            "conv", "at", "next", F.when(F.col("fixed").isNull(), F.col("used")).otherwise(F.col("end")).alias("used"),
            F.coalesce("fixed", "out").alias("out"))
        state = written(state, "vectors")
    maps = _mapped(chunks, [], "map array<long>", unit_runs)

    def apply(end: list[int], by: list[int]) -> list[int]:
        start = (np.array(by).reshape(4, 4) + np.array(end)).min(axis=1)
        return (start - start[0]).tolist()

    return _chain(maps, F.col("at").desc(), "end array<long>", ["map"], (plain - plain[0]).tolist(), apply)


def true_states(chunks: DataFrame, costs: Costs) -> DataFrame:
    """conv, at, state at the start of each chunk; ``chunks`` with ``end``."""
    def ends(kinds, end):
        rows, end = _padded(kinds), _vectors(end)
        vectors = backward(costs, rows, end, keep=True)
        no = np.zeros(len(kinds), bool)
        to = [trace(costs, rows, vectors, np.full(len(kinds), s), no)[1] for s in range(4)]
        return [_longs(np.stack(to, axis=1))]

    return _chain(_mapped(chunks, ["end"], "to array<long>", ends), F.col("at"), "state long", ["to"], START, lambda now, to: to[now])


def letters(chunks: DataFrame, costs: Costs) -> DataFrame:
    """conv, at, letters (of each live line), tail, gain (cost over that at the end); ``chunks``: kinds, end, state, last."""
    def run(kinds, end, state, last):
        rows = _padded(kinds)
        vectors = backward(costs, rows, _vectors(end), keep=True)
        made, _, tails = trace(costs, rows, vectors, np.asarray(state), last.to_numpy(zero_copy_only=False))
        return [pa.array(made, pa.list_(pa.string())), pa.array(tails, pa.string()), pa.array(vectors[:, 0, START])]

    return _mapped(chunks, ["end", "state", "last"], "letters array<string>, tail string, gain long", run)


def _lines(rows: DataFrame) -> DataFrame:
    """part, conv, turn, what, kind, blank, copies, live: rows of equal turn and content, in ranges."""
    one = ["conv", "turn", "what", "kind", "blank"]
    here = rows.where("copies > 0")
    first = here.where("not blank").groupBy("conv", "what", "kind", "blank").agg(
        F.min("turn").alias("turn"), F.max(F.col("turn").isNull()).alias("none"))
    first = first.select("conv", F.when(~F.col("none"), F.col("turn")).alias("turn"), "what", "kind", "blank",
                         F.lit(0).cast("long").alias("copies"), F.lit(1).alias("live"))
    lines = here.select(*one, "copies", F.lit(0).alias("live")).unionByName(first)
    lines = lines.groupBy(*one).agg(F.sum("copies").alias("copies"), F.max("live").alias("live"))
    return written(lines.repartitionByRange("conv", "turn", "what").withColumn("part", F.spark_partition_id()), "lines")


def _initial(kind: Column) -> Column:
    return F.substring(F.lit("sua?"), kind % 4 + 1, F.lit(1))


def _counts(rows: DataFrame, lines: DataFrame) -> DataFrame:
    """conv, gaps, blank, duplicate, truncated, illegal, forced (rows that can only be deleted)."""
    here = Window.partitionBy("part", "conv").orderBy("turn", "what")
    initial = _initial(F.col("kind"))
    bad = lambda a, b: ~F.concat(a, b).isin(*LEGAL)
    told = lines.withColumn("illegal", F.col("copies") - 1 + F.coalesce(
        bad(F.lag(initial).over(here), initial), F.lit(False)).cast("long"))
    # over the borders of ranges
    parts = lines.groupBy("part", "conv").agg(
        F.min_by(initial, F.struct(F.col("turn").isNotNull(), "turn", "what")).alias("first"),
        F.max_by(initial, F.struct(F.col("turn").isNotNull(), "turn", "what")).alias("last"))
    along = Window.partitionBy("conv").orderBy("part")
    parts = parts.withColumn("over", F.coalesce(bad(F.lag("last").over(along), F.col("first")), F.lit(False)).cast("long"))
    over = parts.groupBy("conv").agg(F.sum("over").alias("over"))
    live, blank = F.col("live") == 1, F.col("blank")
    wide = lambda c: c.cast("decimal(38,0)")
    gaps = wide(F.max("turn")) - wide(F.min("turn")) + 1 - F.count_distinct("turn")
    sums = told.groupBy("conv").agg(
        F.coalesce(gaps, F.lit(0).cast("decimal(38,0)")).alias("gaps"), F.sum("illegal").alias("illegal"),
        F.sum(F.when(blank, F.col("copies")).otherwise(0)).alias("blank"),
        F.sum(F.when(~blank, F.col("copies") - F.col("live")).otherwise(0)).alias("duplicate"),
        F.count_if(live & (F.col("kind") >= 4)).alias("truncated"))
    out = rows.select("conv").distinct().join(sums, "conv", "left").join(over, "conv", "left")
    zero = F.lit(0).cast("long")
    count = {c: F.coalesce(c, zero) for c in ("blank", "duplicate", "truncated")}
    return out.select(
        "conv", F.when(F.col("gaps").isNull(), zero).otherwise(F.col("gaps").try_cast("bigint")).alias("gaps"), *(v.alias(k) for k, v in count.items()),
        (F.coalesce("illegal", zero) + F.coalesce("over", zero)).alias("illegal"), (count["blank"] + count["duplicate"]).alias("forced"))


def _stories(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """conv, audit, repaired_sha256: a conversation's rows in order beside the letters of its live lines."""
    names = ["conv", "tail", "turn", "what", "mark", "letters", "copies", "role", "text"]
    none = F.lit(None).cast("string")
    texts = rows.where("copies > 0").select(
        "conv", F.lit(False).alias("tail"), "turn", "what", F.lit(False).alias("mark"), none.alias("letters"), "copies", "role", "text")
    marks = marks.select("conv", "tail", "turn", "what", F.lit(True).alias("mark"), "letters", F.lit(0).cast("long").alias("copies"),
                         none.alias("role"), none.alias("text"))
    rows = texts.unionByName(marks).repartition("conv").sortWithinPartitions("conv", "tail", "turn", "what", F.col("mark").desc())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, told = None, False
        audit, state, hashed, some, waiting = [], START, hashlib.sha256(), False, ""

        def say(role: str, text: str):
            nonlocal some
            hashed.update((b"\n" if some else b"") + role.encode() + b":" + text.encode())
            some = True

        def insert(letters: str):
            nonlocal state
            for _ in letters:
                state = int(TURN[state])
                say("user" if state == USER else "assistant", "")

        for batch in batches:
            out = []
            for row in zip(*(batch.column(names.index(n)).to_pylist() for n in ("conv", "tail", "mark", "letters", "copies", "role", "text"))):
                if not told or row[0] != conv:
                    if told:
                        out.append((conv, "".join(audit), hashed.hexdigest()))
                    conv, told = row[0], True
                    audit, state, hashed, some, waiting = [], START, hashlib.sha256(), False, ""
                _, tail, mark, marked, copies, role, text = row
                if tail:
                    audit.append(marked)
                    insert(marked)
                elif mark:
                    waiting = marked
                else:
                    if waiting:
                        audit.append(waiting)
                        insert(waiting[:-1])
                        if waiting[-1] == "K":
                            state = int(KEPT[state, "sua".find(role[:1])])
                            say(role, text)
                        elif waiting[-1] == "R":
                            state = int(TURN[state])
                            say("user" if state == USER else "assistant", text)
                        waiting = ""
                        copies -= 1
                    audit.append("D" * copies)
            if out:
                yield _story(out)
        if told:
            yield _story([(conv, "".join(audit), hashed.hexdigest())])

    return rows.mapInArrow(run, "conv long, audit string, repaired_sha256 string")


def _story(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], names=["conv", "audit", "repaired_sha256"])


def repair(conversations: DataFrame, costs: Costs | None = None, chunk: int = CHUNK, passes: int = PASSES) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation.

    ``conversations``: conv_id, turn, role, text, and ``copies`` where a row
    stands for several equal ones (0: only its conversation's id counts).
    """
    costs = costs or Costs()
    null_id = missing_id(conversations, "conv_id")
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    copies = F.col("copies").cast("long") if "copies" in conversations.columns else F.lit(1).cast("long")
    initial = F.substring(role, 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    cut_off = ~text.rlike(r"[.!?][\x20\x09-\x0D]*\z")
    rows = conversations.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(null_id).cast("long")).alias("conv"), F.col("turn").cast("long").alias("turn"),
        role.alias("role"), text.alias("text"), copies.alias("copies"), content_digest(role, text).alias("what"),
        (kind + F.when(cut_off, 4).otherwise(0)).alias("kind"), (word_count(text) == 0).alias("blank"))
    lines = _lines(rows)
    here = Window.partitionBy("part", "conv").orderBy("turn", "what")
    live = lines.where("live = 1").withColumn("piece", F.floor((F.row_number().over(here) - 1) / chunk))
    chunks = live.groupBy("part", "conv", "piece").agg(F.array_sort(F.collect_list(F.struct(
        F.col("turn").isNotNull().alias("some"), "turn", "what", F.col("kind").cast("long").alias("kind")))).alias("lines"))
    chunks = chunks.select("conv", (F.shiftleft(F.col("part").cast("long"), 32) + F.col("piece")).alias("at"),
                           F.col("lines.kind").alias("kinds"), F.transform("lines", lambda x: F.struct(x["turn"], x["what"])).alias("keys"))
    along = Window.partitionBy("conv").orderBy("at")
    chunks = written(chunks.withColumns({"next": F.lead("at").over(along), "before": F.lag("at").over(along)}), "chunks")
    long = chunks.where("next is not null or before is not null").select("conv", "at", "next", "kinds")
    plain = F.array(*(F.lit(int(x)) for x in costs.end))
    if long.limit(1).count():
        ends = written(true_ends(long, costs, passes), "ends")
        states = written(true_states(long.join(ends, ["conv", "at"]), costs), "states")
        whole = chunks.join(ends.join(states, ["conv", "at"]), ["conv", "at"], "left")
    else:
        whole = chunks.withColumns({"end": plain, "state": F.lit(START).cast("long")})
    whole = whole.withColumns({"end": F.coalesce("end", plain), "state": F.coalesce("state", F.lit(START).cast("long")), "last": F.col("next").isNull()})
    told = written(letters(whole, costs), "letters")
    with_keys = told.join(chunks.select("conv", "at", "keys"), ["conv", "at"])
    each = with_keys.select("conv", F.explode(F.arrays_zip("keys", "letters")).alias("x"))
    marks = each.select("conv", F.lit(False).alias("tail"), F.col("x.keys.turn").alias("turn"), F.col("x.keys.what").alias("what"),
                        F.col("x.letters").alias("letters"))
    tails = told.where("tail != ''").select("conv", F.lit(True).alias("tail"), F.lit(None).cast("long").alias("turn"),
                                            F.lit(None).cast("binary").alias("what"), F.col("tail").alias("letters"))
    stories = _stories(rows.select("conv", "turn", "what", "copies", "role", "text"), marks.unionByName(tails))
    gains = told.groupBy("conv").agg(F.sum("gain").alias("gain"))
    out = _counts(rows, lines).join(gains, "conv", "left").join(stories, "conv", "left")
    shown = F.col("conv") if null_id is None else F.when(F.col("conv") != null_id, F.col("conv"))
    cost = F.coalesce("gain", F.lit(0).cast("long")) + costs.delete * F.col("forced")
    return out.select(shown.alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", cost.alias("cost"),
                      F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults by the crc32 of ``conv_id:turn``: dropped rows (copies 0), empty or unended
    texts, rows that stand for two, wrong roles. Nulls are one space."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(part("text"), "[.!?]", "")).otherwise(part("text"))
    role = F.when(fault == 4, "user").otherwise(part("role"))
    copies = F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).cast("long")
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copies"))


def _edit(state: str, cost: str, letter: str, line: str | None = None) -> str:
    """SQL: a state's entry (padded cost and audit, repaired text) after one more edit."""
    text = f"{state}.t" if line is None else f"CASE WHEN {state}.t = '' THEN {line} ELSE {state}.t || chr(10) || {line} END"
    return f"struct_pack(k := lpad(CAST(CAST(left({state}.k, 10) AS BIGINT) + {cost} AS VARCHAR), 10, '0') || substr({state}.k, 11) || '{letter}', t := {text})"


def _least(*entries: str) -> str:
    return f"list_sort([{', '.join(entries)}])[1]"


def _row_edits(state: str, initial: str, before: list[str]) -> str:
    """SQL: the entry of ``state`` after a row, from the entries ``before`` that lead to it."""
    full = {"u": "'user'", "a": "'assistant'"}.get(initial)
    ways = [f"CASE WHEN initial = '{initial}' AND NOT forced THEN {_edit(b, 'more', 'K', 'line')} ELSE {_FAR_SQL} END" for b in before]
    if full:
        ways += [f"CASE WHEN NOT forced THEN {_edit(b, '1 + more', 'R', full + chr(124) * 2 + chr(39) + ':' + chr(39) + chr(124) * 2 + 'text')} ELSE {_FAR_SQL} END"
                 for b in before]
    return f"{_least(_edit(state, '2', 'D'), *ways)} AS {state}"


_FAR_SQL = "struct_pack(k := '5000000000', t := '')"

#: the search as a recursive query over the rows; rows without an id are not in the test tables
ORACLE = fr"""
WITH RECURSIVE
raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32_sql("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS fault
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM raw),
placed AS (
  SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(role) || ':' || role || text)) AS i,
         left(role, 1) AS initial, role || ':' || text AS line, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank
  FROM damaged),
seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again FROM placed),
faulty AS (
  SELECT *, blank OR again AS forced, NOT blank AND NOT again AND NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS truncated,
         coalesce(lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au'), false) AS illegal
  FROM seen),
costed AS (SELECT *, CASE WHEN truncated THEN 5 ELSE 0 END AS more FROM faulty),
ids AS (SELECT DISTINCT conv_id FROM conversations),
search AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, struct_pack(k := '0000000000', t := '') AS v0, {_FAR_SQL} AS v1,
         struct_pack(k := '0000000005I', t := 'user:') AS v2,
         struct_pack(k := '0000000010II', t := 'user:' || chr(10) || 'assistant:') AS v3
  FROM ids
  UNION ALL
  SELECT conv_id, i, v0, v1, v2, {_least("v3", _edit("v2", "5", "I", "'assistant:'"))} AS v3
  FROM (
    SELECT conv_id, i, v0, v1, {_least("v2", *(_edit(s, "5", "I", "'user:'") for s in ("v0", "v1", "v3")))} AS v2, v3
    FROM (
      SELECT search.conv_id, costed.i, {_least(_edit("v0", "2", "D"))} AS v0, {_row_edits("v1", "s", ["v0"])},
             {_row_edits("v2", "u", ["v0", "v1", "v3"])}, {_row_edits("v3", "a", ["v2"])}
      FROM search JOIN costed ON costed.conv_id = search.conv_id AND costed.i = search.i + 1))),
ended AS (SELECT conv_id, arg_max({_least("v0", "v3")}, i) AS best FROM search GROUP BY conv_id),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (again AND NOT blank) AS duplicate, count(*) FILTER (truncated) AS truncated, count(*) FILTER (illegal) AS illegal
  FROM costed GROUP BY conv_id)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(left(best.k, 10) AS BIGINT) AS cost, substr(best.k, 11) AS audit, sha256(best.t) AS repaired_sha256
FROM ended LEFT JOIN counts USING (conv_id)
"""
