"""Language-model scores by prediction by partial matching.

The model is a byte-context trie of order ``ORDER``: for every context of up
to ``ORDER`` bytes, how often each symbol followed it in the training texts (A-Z in
lower case; the end of a text is a symbol, and contexts before its start are
filled with zero bytes). A symbol is coded at the longest context seen in
training; where that context never had it, an escape is coded (method D: of a
context with n occurrences of d distinct symbols, a symbol seen c times has
(2c - 1) / 2n and the escape d / 2n), the symbols of that context are excluded,
and the next shorter context tries. After the empty context the remaining
symbols are alike.

The trie is never held whole. Documents are dealt into blocks; a block counts
its own contexts and words, sends them to the shares their keys belong to, and
gets back the corpus totals of the contexts and words it holds; shares answer
only the blocks that asked them. The scores are then computed per distinct
context and symbol of the block and summed per text. The training tokens and
distinct training tokens of a share go along with one of its answers, are summed
over the written scores, and complete the base scores.

Defined cases: a null or empty text is its end alone; a null id is hashed as
the empty text; repeated rows are counted and scored each; without training
texts every symbol is coded at 1/257; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtally.llm.common import DEALT, DEALT_DDL, arrow_rows, block_count, crc_of_id, deal, text_bytes, written

ORDER = 5
END = 256
SYMBOLS = 257
END_WORD = b"\n"  # the end as a token; no word holds a line break
BLOCK_BYTES = 4 << 20
_DENSE = 1 << 25
_STEP = 1 << 15
_BLANKS = b" \t\n\x0b\x0c\r"
_IN_WORD = bytes(b not in _BLANKS for b in range(256))

_U = np.uint64
_MIX = _U(0x9E3779B97F4A7C15)
_SYM_BITS = _U(9)
_LEVEL = _U(60)


class Block:
    """Symbols of the texts of a block, and the distinct (context, symbol) pairs and words in them."""

    def __init__(self, texts: list[bytes]):
        self.size = np.array([len(t) + 1 for t in texts], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.size)[:-1]])
        self._pairs(texts)
        self._words(texts)

    def _pairs(self, texts: list[bytes]) -> None:
        """``pair``: number of the distinct pair at each place; ``codes``: its context and symbol, ascending."""
        pad = bytes(ORDER)
        # each text: its padding, its bytes, the end
        data = b"".join([pad + t + b"\0" for t in texts]).lower()
        stop = np.cumsum(self.size + ORDER)
        raw = np.frombuffer(data, np.uint8)
        seen = np.zeros(256, bool)
        for part in _steps(len(raw)):
            seen[raw[part]] = True
        letters = np.flatnonzero(seen)
        table = (np.cumsum(seen) - seen).astype(np.uint8).tobytes()
        dense = np.frombuffer(data.translate(table), np.uint8).astype(np.int32)
        dense[stop - 1] = len(letters)
        letters = np.append(letters, END).astype(_U)

        # contexts end before each place; those that reach over a border are numbered, never used
        size = len(dense) - ORDER
        two, codes2 = _numbered(dense[:-1], dense[1:], letters, letters, _U(8))
        number, codes = _numbered(two[:size], two[2:size + 2], codes2, codes2, _U(16))
        for j in range(4, ORDER):
            number, codes = _numbered(number, dense[j:size + j], codes, letters, _U(8))
        place = np.ones(len(dense), bool)
        for k in range(ORDER):
            place[stop - self.size - 1 - k] = False
        place = place[ORDER:]
        self.pair, self.codes = _numbered(number[place], dense[ORDER:][place], codes, letters, _SYM_BITS)

    def _words(self, texts: list[bytes]) -> None:
        data = b"\n".join([b"", *texts, b""]).lower()
        flags = np.frombuffer(data.translate(_IN_WORD), np.uint8)
        edges = np.flatnonzero(flags[1:] != flags[:-1])
        begin, end = edges[::2], edges[1::2]
        offsets = np.concatenate([[0], np.cumsum(end - begin)])
        letters = data.translate(None, _BLANKS)
        found = pa.Array.from_buffers(
            pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]).dictionary_encode()
        until = np.searchsorted(begin, np.cumsum(self.size))
        _, offsets, letters = found.dictionary.buffers()
        offsets = np.frombuffer(offsets, np.int64, len(found.dictionary) + 1).tolist()
        letters = letters.to_pybytes()
        words = [letters[a:b] for a, b in pairwise(offsets)]
        of = np.insert(found.indices.to_numpy(), until, len(words))
        words.append(END_WORD)
        keys = np.fromiter(map(xxhash.xxh3_64_intdigest, words), _U, len(words))
        by = np.argsort(keys)  # the same order however the rows of the block arrive
        rank = np.empty(len(keys), np.int64)
        rank[by] = np.arange(len(keys))
        self.word_keys = keys[by]
        self.word = rank[of]
        self.word_sizes = np.diff(until, prepend=0) + 1


def _steps(n: int) -> Iterator[slice]:
    """Slices of ``n`` places that are small enough for what is made of one to stay in the processor's cache."""
    return (slice(at, at + _STEP) for at in range(0, n, _STEP))


def _numbered(
    left: np.ndarray, right: np.ndarray, left_codes: np.ndarray, right_codes: np.ndarray, bits: np.uint64
) -> tuple[np.ndarray, np.ndarray]:
    """Number of the distinct (left, right) at each place, in their order, and the code of each: the left
    one's, shifted by ``bits``, and the right one's."""
    many = len(right_codes)
    size = len(left_codes) * many
    if size > _DENSE:
        kinds, number = np.unique(left.astype(np.int64) * many + right, return_inverse=True)
        number = number.astype(np.int32)
    else:
        seen = np.zeros(size, bool)
        number = np.empty(len(left), np.int32)
        for part in _steps(len(left)):
            joint = left[part] * np.int64(many) + right[part]
            number[part] = joint
            seen[joint] = True
        kinds = np.flatnonzero(seen)
        rank = np.empty(size, np.int32)  # filled and read at the distinct values only
        rank[kinds] = np.arange(len(kinds), dtype=np.int32)
        for part in _steps(len(left)):
            np.take(rank, number[part], out=number[part], mode="clip")
    return number, (left_codes[kinds // many] << bits) | right_codes[kinds % many]


def at_order(codes: np.ndarray, k: int) -> np.ndarray:
    """Codes of pairs with only the last ``k`` bytes of the context, marked with the order."""
    return (codes & ((_U(1) << _U(8 * k + 9)) - _U(1))) | (_U(k + 1) << _LEVEL)


def share_key(codes: np.ndarray) -> np.ndarray:
    """Key of the context of each pair, by which pairs are dealt."""
    key = (codes >> _SYM_BITS) * _MIX
    return key ^ (key >> _U(29))


def _first(ordered: np.ndarray) -> np.ndarray:
    """Where each distinct value of an ordered array begins."""
    return np.flatnonzero(np.concatenate([np.ones(min(1, len(ordered)), bool), ordered[1:] != ordered[:-1]]))


def _summed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes, ascending, and the sums of their counts; quick where the codes come in ascending runs."""
    by = np.argsort(codes, kind="stable")
    codes = codes[by]
    first = _first(codes)
    return codes[first], np.add.reduceat(counts[by].astype(_U), first) if len(first) else counts.astype(_U)


def _by_order(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of pairs (of full order, ascending) at every order, each summed from the one above it."""
    orders = [(codes, counts.astype(_U))]
    for k in range(ORDER - 1, -1, -1):
        orders.append(_summed(at_order(orders[-1][0], k), orders[-1][1]))
    return (
        np.concatenate([at_order(own, k) for k, (own, _) in zip(range(ORDER, -1, -1), orders)][::-1]),
        np.concatenate([n for _, n in orders][::-1]),
    )


def _ask(shares: int):
    def ask(table: pa.Table) -> pa.Table:
        number = table.column("block")[0].as_py()
        texts = list(text_bytes(table.column("text")))
        learned = np.array(table.column("learned").to_pylist(), bool)
        block = Block(texts)
        counts = np.bincount(block.pair[np.repeat(learned, block.size)], minlength=len(block.codes))
        codes, counts = _by_order(block.codes, counts)
        words = np.bincount(block.word[np.repeat(learned, block.word_sizes)], minlength=len(block.word_keys))
        keys, words = block.word_keys, words.astype(_U)
        sent: dict[int, list[bytes]] = {}
        for share, part in deal(share_key(codes), shares):
            sent.setdefault(share, [b"", b""])[0] = _pack(codes[part], counts[part])
        for share, part in deal(keys, shares):
            sent.setdefault(share, [b"", b""])[1] = _pack(keys[part], words[part])
        rows = [(s, number, _squeeze(len(a).to_bytes(8, "little") + a + b)) for s, (a, b) in sent.items()]
        return arrow_rows(DEALT, rows)

    return ask


def _pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending keys as differences, and counts, byte plane by byte plane: most planes are nearly all zero."""
    steps = np.diff(keys, prepend=_U(0))
    return b"".join(np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T).tobytes() for x in (steps, counts))


def _unpack(packed: memoryview) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(packed, np.uint8).reshape(16, -1)
    steps, counts = (np.ascontiguousarray(planes[i:i + 8].T).view(_U).ravel() for i in (0, 8))
    return np.cumsum(steps, dtype=_U), counts


def _squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def _expand(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _split(sent: bytes) -> tuple[memoryview, memoryview]:
    size, whole = int.from_bytes(sent[:8], "little"), memoryview(sent)
    return whole[8:8 + size], whole[8 + size:]


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of all the ranges of ``size`` from ``start``, range by range."""
    return np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())


def _answer(table: pa.Table) -> pa.Table:
    """Corpus totals of one share, for each block that asked: all symbols of the contexts it holds, the
    counts of its words in the order sent, and, for the first block alone, the share's tokens and distinct tokens."""
    share = table.column("share")[0].as_py()
    asked = [(b, *_split(_expand(s.as_py()))) for b, s in zip(table.column("block").to_pylist(), table.column("sent"))]
    pairs = [_unpack(p) for _, p, _ in asked]
    words = [_unpack(w) for _, _, w in asked]
    codes, counts = _summed(np.concatenate([c for c, _ in pairs]), np.concatenate([n for _, n in pairs]))
    codes, counts = codes[counts > 0], counts[counts > 0]
    keys, totals = _summed(np.concatenate([k for k, _ in words]), np.concatenate([n for _, n in words]))
    heads = np.array([totals.sum(), (totals > 0).sum()], _U).tobytes()
    told = min(a[0] for a in asked)
    contexts = codes >> _SYM_BITS
    start = _first(contexts)
    contexts, size = contexts[start], np.diff(np.append(start, len(codes)))
    rows = []
    for (number, _, _), (own, _), (mine, _) in zip(asked, pairs, words):
        wanted = own >> _SYM_BITS
        wanted = wanted[_first(wanted)]
        at = np.searchsorted(contexts, wanted)
        at = at[np.append(contexts, _U(0))[at] == wanted]
        held = _ranges(start[at], size[at])
        found = _pack(codes[held], counts[held])
        known = totals[np.searchsorted(keys, mine)]
        known = np.ascontiguousarray(known.view(np.uint8).reshape(-1, 8).T).tobytes()
        head = heads if number == told else bytes(16)
        rows.append((share, number, _squeeze(head + len(found).to_bytes(8, "little") + found + known)))
    return arrow_rows(DEALT, rows)


class Trie:
    """Totals of the contexts that a block holds, by order."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        by = np.argsort(codes, kind="stable")  # they come in ascending runs
        codes, counts = codes[by], counts[by].astype(np.float64)
        bounds = np.searchsorted(codes, np.arange(1, ORDER + 3, dtype=_U) << _LEVEL)
        self.codes, self.counts, self.contexts, self.start, self.total, self.kinds = [], [], [], [], [], []
        for here in map(slice, bounds[:-1], bounds[1:]):
            own, n = codes[here], counts[here]
            context = own >> _SYM_BITS
            start = _first(context)
            self.codes.append(own)
            self.counts.append(n)
            self.contexts.append(context[start])
            self.start.append(start)
            self.total.append(np.add.reduceat(n, start) if len(n) else n)
            self.kinds.append(np.diff(np.append(start, len(n))))

    def find(self, k: int, codes: np.ndarray) -> np.ndarray:
        """Count of each code at order ``k``, 0 where it is not."""
        if not len(self.codes[k]):
            return np.zeros(len(codes))
        at = np.minimum(np.searchsorted(self.codes[k], codes), len(self.codes[k]) - 1)
        return np.where(self.codes[k][at] == codes, self.counts[k][at], 0.0)

    def shadow(self, k: int, at: np.ndarray) -> np.ndarray:
        """What the symbols of the contexts ``at`` order ``k`` count one order below."""
        if not k:
            return np.zeros(len(at))
        kinds, of = np.unique(at, return_inverse=True)
        size = self.kinds[k][kinds]
        own = self.codes[k][_ranges(self.start[k][kinds], size)]
        below = self.find(k - 1, at_order(own, k - 1))
        return np.bincount(np.repeat(np.arange(len(kinds)), size), weights=below, minlength=len(kinds))[of]

    def log10(self, codes: np.ndarray) -> np.ndarray:
        """log10 probability of the symbol of each pair (of full order) after its context."""
        out = np.zeros(len(codes))
        # the pairs not coded yet, and what the order above takes from theirs
        left = np.arange(len(codes))
        lost_total, lost_kinds = np.zeros(len(codes)), np.zeros(len(codes))
        for k in range(ORDER, -1, -1):
            if not len(self.contexts[k]) or not len(left):
                continue
            own = at_order(codes[left], k)
            context = own >> _SYM_BITS
            at = np.minimum(np.searchsorted(self.contexts[k], context), len(self.contexts[k]) - 1)
            known = self.contexts[k][at] == context
            kinds = self.kinds[k][at] - lost_kinds
            whole = 2 * (self.total[k][at] - lost_total)
            count = self.find(k, own)
            hit = known & (count > 0)
            out[left[hit]] += np.log10((2 * count[hit] - 1) / whole[hit])
            miss = known & (count == 0) & (kinds > 0)
            out[left[miss]] += np.log10(kinds[miss] / whole[miss])
            left, at, known = left[~hit], at[~hit], known[~hit]
            lost_total, lost_kinds = np.zeros(len(left)), np.zeros(len(left))
            lost_total[known] = self.shadow(k, at[known])
            lost_kinds[known] = self.kinds[k][at[known]]
        out[left] -= np.log10(SYMBOLS - lost_kinds)
        return out


_KINDS = {"held_out": pa.bool_(), "n_tokens": pa.int64(), "n_known": pa.int64(), "word_logs": pa.float64(),
          "score": pa.float64(), "tokens": pa.int64(), "kinds": pa.int64()}
_SCORES = "held_out boolean, n_tokens long, n_known long, word_logs double, score double, tokens long, kinds long"


def _score(shares: int):
    def score(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:  # a block number that no document has
            return pa.table({"doc_id": docs.column("doc_id")} | {n: pa.array([], t) for n, t in _KINDS.items()})
        block = Block(list(text_bytes(docs.column("text"))))
        codes, counts, heads, known = [], [], [], {}
        for share, sent in zip(answers.column("share").to_pylist(), (_expand(x.as_py()) for x in answers.column("sent"))):
            heads.append(np.frombuffer(sent, _U, 2))
            pairs, words = _split(sent[16:])
            c, n = _unpack(pairs)
            codes.append(c)
            counts.append(n)
            planes = np.frombuffer(words, np.uint8).reshape(8, -1)
            known[share] = np.ascontiguousarray(planes.T).view(_U).ravel()
        tokens, kinds = (int(sum(int(h[i]) for h in heads)) for i in (0, 1))
        trie = Trie(np.concatenate(codes), np.concatenate(counts))
        logs = trie.log10(block.codes)
        scores = np.empty(len(block.size))
        bounds, cuts = np.append(block.starts, len(block.pair)), _first(block.starts // _STEP)
        for a, b in zip(cuts, np.append(cuts[1:], len(scores))):  # a few texts at a time
            scores[a:b] = np.add.reduceat(np.take(logs, block.pair[bounds[a]:bounds[b]]), bounds[a:b] - bounds[a])
        count = np.zeros(len(block.word_keys))
        for share, part in deal(block.word_keys, shares):
            count[part] = known[share]
        base = np.log10(count + 1)
        of = np.repeat(np.arange(len(block.size)), block.word_sizes)
        rows = len(block.size)
        n_known = np.bincount(of, weights=count[block.word] > 0, minlength=rows)
        word_logs = np.bincount(of, weights=base[block.word], minlength=rows)
        # what the block was told of the corpus totals, on its first row
        told = np.zeros((2, rows), np.int64)
        told[:, 0] = tokens, kinds
        return pa.Table.from_arrays(
            [
                docs.column("doc_id").combine_chunks(), pa.array(~np.array(docs.column("learned").to_pylist(), bool)),
                pa.array(block.word_sizes), pa.array(n_known.astype(np.int64)), pa.array(word_logs), pa.array(scores),
                pa.array(told[0]), pa.array(told[1]),
            ],
            names=["doc_id", *_KINDS],
        )

    return score


def score(docs: DataFrame, learned: Column, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document.

    ``learned``: whether the model learns from the row (null: not).
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    blocks, answers, shares = _exchange(docs, learned, block_bytes)
    scored = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_score(shares), f"doc_id {kind}, {_SCORES}")
    scored = written(scored, "ppm")
    tokens, kinds = (x or 0 for x in scored.agg(F.sum("tokens"), F.sum("kinds")).first())
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("word_logs") - F.col("n_tokens") * math.log10(tokens + kinds + 1)).alias("base_score"), "score")


def _exchange(docs: DataFrame, learned: Column, block_bytes: int) -> tuple[DataFrame, DataFrame, int]:
    """The rows with their blocks, the answers that the blocks get, and the number of shares."""
    n = block_count(docs.sparkSession, docs, block_bytes)
    shares = max(16, n // 4)
    blocks = docs.select(
        "doc_id", "text", F.coalesce(learned, F.lit(False)).alias("learned"),
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("long").alias("block"),
    )
    asked = blocks.groupBy("block").applyInArrow(_ask(shares), DEALT_DDL)
    return blocks, asked.groupBy("share").applyInArrow(_answer, DEALT_DDL), shares


def learned_rows() -> Column:
    """The training rows: crc32 of the id is not 2 modulo 7."""
    return crc_of_id(F.col("doc_id")) % 7 != 2
