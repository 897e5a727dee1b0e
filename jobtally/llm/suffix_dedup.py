"""Removal of repeated byte strings by hash-compared suffix sorting.

A byte is removed when a string of ``SPAN`` bytes that covers it also starts
earlier (smaller doc_id, or earlier in the same document). Strings never cross
documents and are judged on the input.

1. Every start of a ``SPAN``-byte string belongs to one anchor: the leftmost
   ``K``-byte substring of least hash inside the string. Neighbouring starts
   mostly share theirs, so an anchor stands for a run of up to 64 starts, and
   equal strings have equal anchors. Documents are dealt into blocks; each
   block sends the distinct anchor hashes it holds, and learns which of them
   occur elsewhere or twice.
2. For repeated anchors a block sends the bytes its run covers, each distinct
   piece once (copies inside the block are resolved there). Where the same
   anchor meets, the pieces are sorted as suffixes: a mergesort that compares
   by binary search on prefix polynomial hashes for the common extension, so a
   comparison takes a logarithmic number of steps. Neighbours that agree over
   the whole piece are checked byte by byte and resolved to the earliest.
   Pieces that agree in part are resolved per string, by the hash of its
   ``SPAN`` bytes, checked byte by byte against the earliest.
3. The marks return to the blocks, which cut the bytes.

Hot anchors (``HOT`` occurrences) are sent string by string under the hash of
the whole string instead, so that what is equal is merged in the blocks and the
rest is spread; no key then receives more rows than there are blocks. Text is
shuffled once, and that exchange serves all three steps.

Defined cases: a null text is empty; texts shorter than ``SPAN`` lose nothing;
a null id comes after all others; rows with the same id are ordered by text,
equal rows one after the other, so the second of two equal rows loses what the
first keeps; an empty table gives an empty result; other columns pass through
(result names begin with ``sd_``).
"""

from __future__ import annotations

import hashlib
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtally.llm.common import DEALT, DEALT_DDL, arrow_rows, block_count, deal, text_bytes

SPAN = 100
K = 37
RUN = SPAN - K + 1
BLOCK_BYTES = 2_000_000
HOT = 100_000
_CHUNK = 1 << 19
_SLICE = 4096
_LONGEST = RUN + SPAN - 1
_PLACES = np.arange(_LONGEST, dtype=np.uint8)

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_MIX = _U(0xD6E8FEB86659FD93)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _MIX
    return x ^ (x >> _U(29))


def _powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n, base, _U)
    out[0] = 1
    return np.cumprod(out, dtype=_U)


_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))
_LETTER = _mixed(np.arange(1, 257, dtype=_U) * _BASE)
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(8, (n - 1).bit_length())
    if size not in _tables:
        _tables[size] = _powers(size, _BASE), _powers(size, _INVERSE)
    return _tables[size]


class Hashes:
    """Prefix polynomial hashes of ``data`` modulo 2**64; ``place`` is the exponent of each byte."""

    def __init__(self, data: np.ndarray, place: np.ndarray | None = None):
        power, self.inverse = _power_tables(len(data) + 1 if place is None else _LONGEST + 1)
        self.place = place
        self.prefix = np.zeros(len(data) + 1, _U)
        for low in range(0, len(data), _CHUNK):
            part = slice(low, low + _CHUNK)
            terms = _LETTER[data[part]]
            terms *= power[part][:len(terms)] if place is None else power[place[part]]
            np.cumsum(terms, out=terms)
            np.add(terms, self.prefix[low], out=self.prefix[low + 1:low + 1 + len(terms)])

    def of(self, start: np.ndarray, length) -> np.ndarray:
        """Hash of ``length`` bytes from ``start``; equal strings have equal hashes."""
        shift = start if self.place is None else self.place[start]
        return (self.prefix[start + length] - self.prefix[start]) * self.inverse[shift]


def anchor_runs(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """start, starts in the run, anchor minus start, anchor hash; of one text of at most ``_CHUNK`` bytes."""
    if len(data) < SPAN:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, _U)
    hashes = Hashes(data)
    n = len(data) - K + 1
    grams = _mixed((hashes.prefix[K:] - hashes.prefix[:n]) * hashes.inverse[:n])
    low = _U(_CHUNK - 1)
    least = (grams & ~low) | np.arange(n, dtype=_U)
    reach = 1
    while reach < RUN:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    anchor = (least & low).astype(np.int64)
    start = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    count = np.diff(np.append(start, len(anchor)))
    return start, count, anchor[start] - start, grams[anchor[start]]


class Block:
    """The texts of a block in order, joined, and the anchor runs of all of them."""

    def __init__(self, ids: list[int | None], texts: list[bytes]):
        self.order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i], texts[i]))
        self.sizes = np.array([len(texts[i]) for i in self.order], np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.sizes)])
        self.data = np.frombuffer(b"".join(texts[i] for i in self.order), np.uint8)
        top = np.iinfo(np.int64).max
        self.ids = np.array([top if ids[i] is None else ids[i] for i in self.order], np.int64)

    def runs(self) -> tuple[np.ndarray, ...]:
        """start in the joined bytes, starts, anchor minus start, hash of each run.

        Texts are hashed together up to a chunk; a run whose strings would
        reach over the end of a text is cut there.
        """
        parts, row = [], 0
        while row < len(self.sizes):
            low = self.begin[row]
            end = max(np.searchsorted(self.begin, low + _CHUNK - 1, "right") - 1, row + 1)
            if end == row + 1:
                for at in range(int(low), int(self.begin[end]), _CHUNK - SPAN + 1):
                    parts.append((at, anchor_runs(self.data[at:min(at + _CHUNK, int(self.begin[end]))])))
            else:
                found = anchor_runs(self.data[low:self.begin[end]])
                parts.append((low, self._within(found, self.begin[row:end + 1] - low)))
            row = end
        if not parts:
            return anchor_runs(self.data[:0])
        return (np.concatenate([p[0] + low for low, p in parts]), *(np.concatenate([p[i] for _, p in parts]) for i in (1, 2, 3)))

    @staticmethod
    def _within(found, borders):
        """Runs cut to the starts whose string ends inside its text.

        A run has at most 64 starts, so one that leaves a text by more than a
        string's length is empty there; its part in the next text, if any, is
        added for each text it reaches.
        """
        start, count, off, grams = found
        texts = np.searchsorted(borders, start, "right") - 1
        out = []
        last = np.searchsorted(borders, start + count - 1, "right") - 1
        step = 0
        while len(start):
            own = np.minimum(texts + step, last)
            low = np.maximum(start, borders[own])
            high = np.minimum(start + count, borders[own + 1] - SPAN + 1)
            good = (high > low) & (texts + step <= last)
            out.append((low[good], (high - low)[good], (off + start - low)[good], grams[good]))
            step += 1
            if not (texts + step <= last).any():
                break
        if not out:
            return found
        joined = [np.concatenate([o[i] for o in out]) for i in range(4)]
        by = np.argsort(joined[0], kind="stable")
        return tuple(j[by] for j in joined)


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the strings of ``length`` at ``a`` and ``b`` agree, byte by byte."""
    out = np.ones(len(a), bool)
    top = len(data) - 1
    for low in range(0, len(a), _SLICE):
        part = slice(low, low + _SLICE)
        reach = np.arange(int(length[part].max()))
        same = data[np.minimum(a[part, None] + reach, top)] == data[np.minimum(b[part, None] + reach, top)]
        out[part] = (same | (reach >= length[part, None])).all(axis=1)
    return out


def common_extension(hashes: Hashes, a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Length of the common prefix at ``a`` and ``b``, up to ``limit``, by binary search on hashes."""
    low, high = np.zeros(len(a), np.int64), limit.astype(np.int64)
    for _ in range(int(limit.max()).bit_length() if len(limit) else 0):
        middle = (low + high + 1) >> 1
        equal = hashes.of(a, middle) == hashes.of(b, middle)
        low = np.where(equal, middle, low)
        high = np.where(equal, high, middle - 1)
    return low


def suffix_order(data: np.ndarray, hashes: Hashes, start: np.ndarray, length: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Permutation that sorts the suffixes of each group, groups ascending; stable.

    Bottom-up mergesort of all groups at once: an element's place in a merged
    run is its place in its own run plus its rank in the sibling run, found by
    binary search. ``length`` is the same within a group.
    """
    order = np.argsort(group, kind="stable")
    sorted_group = group[order]
    heads = np.flatnonzero(np.concatenate([[True], sorted_group[1:] != sorted_group[:-1]])) if len(order) else order
    sizes = np.diff(np.append(heads, len(order)))
    base, size = np.repeat(heads, sizes), np.repeat(sizes, sizes)
    width = 1
    while len(sizes) and width < sizes.max():
        at = np.flatnonzero(size > width)
        first, local, total = base[at], at - base[at], size[at]
        pair = local // (2 * width) * (2 * width)
        right = local - pair >= width
        low = np.where(right, pair, pair + width)
        high = np.minimum(np.where(right, pair + width, pair + 2 * width), total)
        low = np.minimum(low, high)
        begin = low.copy()
        mine = order[at]
        for _ in range(width.bit_length()):
            live = np.flatnonzero(low < high)
            if not len(live):
                break
            middle = (low[live] + high[live]) >> 1
            other = order[first[live] + middle]
            own = mine[live]
            x, y = start[other], start[own]
            ext = common_extension(hashes, x, y, length[own])
            inside = ext < length[own]
            edge = np.where(inside, ext, 0)
            less = inside & (data[x + edge] < data[y + edge])
            less |= ~inside & right[live]
            low[live] = np.where(less, middle + 1, low[live])
            high[live] = np.where(less, high[live], middle)
        place = first + pair + (local - pair) % width + (low - begin)
        merged = order.copy()
        merged[place] = mine
        order = merged
        width *= 2
    return order


def resolve(data, place, start, count, off, doc, row, pos) -> np.ndarray:
    """For each piece the mask of its strings that also start earlier; bit 0 is its first start."""
    n = len(start)
    hashes = Hashes(data, place)
    age = np.empty(n, np.int64)
    age[np.lexsort((pos, row, doc))] = np.arange(n)
    length = count + SPAN - 1
    anchor = _mixed(hashes.of(start + off, K))
    first8 = np.zeros(n, _U)
    for i in range(8):
        first8 = (first8 << _U(8)) | data[start + i].astype(_U)
    # pieces that can be equal: same anchor, place, length, first bytes
    by = np.lexsort((first8, count, off, anchor))
    change = np.zeros(n, bool)
    for part in (first8, count, off, anchor):
        change[1:] |= part[by][1:] != part[by][:-1]
    group = np.empty(n, np.int64)
    group[by] = np.cumsum(change)
    order = suffix_order(data, hashes, start, length, group)
    a, b = order[:-1], order[1:]
    near = np.flatnonzero(group[a] == group[b])
    a, b = a[near], b[near]
    equal = common_extension(hashes, start[a], start[b], length[a]) == length[a]
    a, b, near = a[equal], b[equal], near[equal]
    good = same_bytes(data, start[a], start[b], length[a])
    run_of = np.ones(n, np.int64)
    run_of[near[good] + 1] = 0
    run_of = np.cumsum(run_of) - 1
    oldest = np.full(run_of[-1] + 1 if n else 0, n, np.int64)
    np.minimum.at(oldest, run_of, age[order])
    mask = np.zeros(n, _U)
    covered = age[order] != oldest[run_of]
    full = ~_U(0) >> (_U(64) - count.astype(_U))
    mask[order[covered]] = full[order[covered]]
    _resolve_strings(data, hashes, start, count, anchor, age, order[~covered], mask)
    return mask


def _resolve_strings(data, hashes, start, count, anchor, age, left, mask):
    """String by string, among the distinct pieces that share an anchor."""
    left = left[np.argsort(anchor[left], kind="stable")]
    of = anchor[left]
    heads = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(left) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(heads, len(left)))
    left = left[np.repeat(sizes > 1, sizes)]
    sizes = sizes[sizes > 1]
    at = 0
    ends = np.cumsum(sizes)
    while at < len(left):
        # whole anchors, about a slice of pieces at a time
        stop = int(ends[min(np.searchsorted(ends, at + _SLICE), len(ends) - 1)])
        pieces = left[at:stop]
        at = stop
        many = count[pieces]
        piece = np.repeat(pieces, many)
        step = np.arange(len(piece)) - np.repeat(np.cumsum(many) - many, many)
        where = start[piece] + step
        gram = hashes.of(where, SPAN)
        by = np.lexsort((age[piece], gram))
        same = np.concatenate([[False], gram[by][1:] == gram[by][:-1]])
        head = np.maximum.accumulate(np.where(same, 0, np.arange(len(by))))
        later, earliest = by[same], by[head[same]]
        good = same_bytes(data, where[later], where[earliest], np.full(len(later), SPAN))
        later = later[good]
        np.bitwise_or.at(mask, piece[later], _U(1) << step[later].astype(_U))


# ---- the three steps in Spark -------------------------------------------------

_HEADER = np.dtype([("doc", "<i8"), ("row", "<u4"), ("pos", "<u4"), ("off", "u1"), ("count", "u1"), ("bit", "u1")])
_MARK = np.dtype([("row", "<u4"), ("pos", "<u4"), ("mask", "<u8")])


def _block(table: pa.Table) -> Block:
    return Block(table.column("doc_id").to_pylist(), list(text_bytes(table.column("text"))))


def _distinct(check: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.unique(check, return_inverse=True, return_counts=True)


def _ask(shares: int):
    def ask(table: pa.Table) -> pa.Table:
        block = table.column("sd_block")[0].as_py()
        grams = _block(table).runs()[3]
        rows = []
        for share, part in deal(grams, shares):
            check, _, times = _distinct((grams[part] >> _U(32)).astype(np.uint32))
            rows.append((share, block, check.tobytes() + np.minimum(times, 255).astype(np.uint8).tobytes()))
        return arrow_rows(DEALT, rows)

    return ask


def _answer(hot: int):
    """0: the anchor occurs once, 1: repeatedly, 2: more than ``hot`` times."""

    def answer(table: pa.Table) -> pa.Table:
        sent = [x.as_py() for x in table.column("sent")]
        checks = [np.frombuffer(x, np.uint32, len(x) // 5) for x in sent]
        times = np.concatenate([np.frombuffer(x, np.uint8, offset=len(x) // 5 * 4) for x in sent])
        _, of, _ = _distinct(np.concatenate(checks))
        total = np.bincount(of, weights=times)
        flag = ((total >= 2).astype(np.uint8) + (total >= hot).astype(np.uint8))[of]
        rows, at = [], 0
        for share, block, check in zip(table.column("share"), table.column("block"), checks):
            rows.append((share.as_py(), block.as_py(), flag[at:at + len(check)].tobytes()))
            at += len(check)
        return arrow_rows(DEALT, rows)

    return answer


def _send(shares: int, pools: int):
    """Pieces of repeated anchors; copies inside the block become marks at once."""

    def send(docs: pa.Table, flags: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if not docs.num_rows:
            return arrow_rows(DEALT, rows)
        number = docs.column("sd_block")[0].as_py()
        block = _block(docs)
        start, count, off, grams = block.runs()
        known = dict(zip(flags.column("share").to_pylist(), flags.column("sent").to_pylist()))
        state = np.zeros(len(start), np.uint8)
        for share, part in deal(grams, shares):
            _, of, _ = _distinct((grams[part] >> _U(32)).astype(np.uint32))
            state[part] = np.frombuffer(known[share], np.uint8)[of]
        hot = np.flatnonzero(state == 2)
        state = np.flatnonzero(state == 1)
        many = count[hot]
        step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        spread = np.repeat(hot, many)
        bit = np.concatenate([np.zeros(len(state), np.int64), step])
        start = np.concatenate([start[state], start[spread] + step])
        off = np.concatenate([off[state], off[spread] - step])
        count = np.concatenate([count[state], np.ones(len(step), np.int64)])
        if not len(start):
            return arrow_rows(DEALT, rows)
        length = count + SPAN - 1
        whole = _mixed(Hashes(block.data).of(start, length) + (off * 256 + count).astype(_U))
        key = np.concatenate([grams[state], whole[len(state):]])
        row = np.searchsorted(block.begin, start, "right") - 1
        pos = start - block.begin[row]
        # equal pieces of this block, all but the first
        by = np.lexsort((start, whole))
        same = np.concatenate([[False], whole[by][1:] == whole[by][:-1]])
        head = by[np.maximum.accumulate(np.where(same, 0, np.arange(len(by))))][same]
        later = by[same]
        good = (count[head] == count[later]) & (off[head] == off[later])
        good &= same_bytes(block.data, start[head], start[later], length[later])
        later = later[good]
        marks = np.zeros(len(later), _MARK)
        marks["row"], marks["pos"] = row[later], pos[later]
        marks["mask"] = ~_U(0) >> (_U(64) - count[later].astype(_U))
        if len(later):
            rows.append((-1 - number, number, marks.tobytes()))
        keep = np.ones(len(start), bool)
        keep[later] = False
        keep = np.flatnonzero(keep)
        for share, part in deal(key[keep], pools):
            part = keep[part]
            head = np.zeros(len(part), _HEADER)
            head["doc"], head["row"], head["pos"] = block.ids[row[part]], row[part], pos[part]
            head["off"], head["count"] = off[part], count[part]
            size = length[part]
            inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            pieces = block.data[np.repeat(start[part], size) + inner]
            rows.append((share, number, len(part).to_bytes(8, "little") + head.tobytes() + pieces.tobytes()))
        return arrow_rows(DEALT, rows)

    return send


def _meet(table: pa.Table) -> pa.Table:
    share = table.column("share")[0].as_py()
    if share < 0:
        return table.select(["block", "sent"])
    sent = [x.as_py() for x in table.column("sent")]
    sizes = [int.from_bytes(x[:8], "little") for x in sent]
    heads = np.concatenate([np.frombuffer(x, _HEADER, n, 8) for x, n in zip(sent, sizes)])
    data = np.concatenate([np.frombuffer(x, np.uint8, offset=8 + n * _HEADER.itemsize) for x, n in zip(sent, sizes)])
    count, off = heads["count"].astype(np.int64), heads["off"].astype(np.int64)
    length = count + SPAN - 1
    start = np.cumsum(length) - length
    place = np.concatenate([_PLACES[:k] for k in length.tolist()])
    mask = resolve(data, place, start, count, off, heads["doc"], heads["row"], heads["pos"])
    rows, at = [], 0
    for block, n in zip(table.column("block"), sizes):
        hit = np.flatnonzero(mask[at:at + n])
        if len(hit):
            marks = np.zeros(len(hit), _MARK)
            marks["row"], marks["pos"], marks["mask"] = heads["row"][at + hit], heads["pos"][at + hit], mask[at + hit]
            rows.append((block.as_py(), marks.tobytes()))
        at += n
    return arrow_rows(pa.schema([DEALT.field("block"), DEALT.field("sent")]), rows)


def _cut(columns: list[str], schema: pa.Schema, as_text: bool):
    def cut(docs: pa.Table, marked: pa.Table) -> pa.Table:
        block = _block(docs)
        marks = np.concatenate([np.frombuffer(x.as_py(), _MARK) for x in marked.column("sent")] or [np.zeros(0, _MARK)])
        change = np.zeros(len(block.data) + 1, np.int32)
        begin = block.begin[marks["row"]] + marks["pos"]
        for bit in range(RUN):
            at = begin[(marks["mask"] >> _U(bit)) & _U(1) == 1] + bit
            np.add.at(change, at, 1)
            np.add.at(change, at + SPAN, -1)
        gone = np.cumsum(change[:-1]) > 0
        rows = []
        for low, high in zip(block.begin[:-1], block.begin[1:]):
            own, text = gone[low:high], block.data[low:high]
            if own.any():
                edge = np.flatnonzero(np.diff(np.concatenate([[0], own.view(np.int8), [0]])))
                rows.append((int(own.sum()), edge[::2].tolist(), edge[1::2].tolist(), text[~own].tobytes()))
            else:
                rows.append((0, [], [], text.tobytes()))
        kept = docs.take(pa.array(block.order, pa.int64())).select(columns)
        more = [
            block.sizes, [r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows],
            [r[3].decode("utf-8", "ignore") if as_text else r[3] for r in rows],
            [hashlib.sha256(r[3]).hexdigest() for r in rows],
        ]
        fields = [schema.field(i) for i in range(len(columns), len(schema))]
        return pa.Table.from_arrays([*kept.columns, *(pa.array(m, f.type) for m, f in zip(more, fields))], schema=schema)

    return cut


def remove_repeats(docs: DataFrame, block_bytes: int = BLOCK_BYTES, hot: int = HOT, as_text: bool = False) -> DataFrame:
    """``docs`` (doc_id an integer, text, any others) with sd_bytes, sd_removed, sd_begin, sd_end
    (the removed spans), sd_kept (the remaining bytes) and sd_sha256 of them.

    ``as_text``: sd_kept is a string; a code point that is cut in two goes whole.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    columns = docs.columns
    n = block_count(spark, docs, block_bytes)
    shares, pools = max(16, n // 16), max(16, n // 2)
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    blocks = docs.withColumn("sd_block", F.pmod(F.xxhash64("doc_id"), F.lit(n)).cast("long"))
    flags = (
        blocks.groupBy("sd_block").applyInArrow(_ask(shares), DEALT_DDL)
        .groupBy("share").applyInArrow(_answer(hot), DEALT_DDL)
    )
    pieces = blocks.groupBy("sd_block").cogroup(flags.groupBy("block")).applyInArrow(_send(shares, pools), DEALT_DDL)
    marks = pieces.groupBy("share").applyInArrow(_meet, "block long, sent binary")
    out = T.StructType(docs.schema.fields + T._parse_datatype_string(
        "sd_bytes long, sd_removed long, sd_begin array<long>, sd_end array<long>, "
        f"sd_kept {'string' if as_text else 'binary'}, sd_sha256 string").fields)
    cut = _cut(columns, to_arrow_schema(out), as_text)
    return blocks.groupBy("sd_block").cogroup(marks.groupBy("block")).applyInArrow(cut, out)


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` without the repeated strings, in its columns; texts of which nothing is left go."""
    names = docs.columns
    out = remove_repeats(docs, as_text=True).where((F.col("sd_kept") != "") | (F.col("sd_bytes") == 0))
    out = out.withColumn("text", F.when(F.col("sd_removed") == 0, F.col("text")).otherwise(F.col("sd_kept")))
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast("long"))
    return out.select(*[F.col(f"`{n}`") for n in names])
