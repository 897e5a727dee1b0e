"""Toxicity: a convolutional text classifier trained in numpy.

A word is the mean of hashed embeddings: of itself and of its first 4, 5 and 6
bytes, so that unseen forms of a known stem are covered. Filters of several
widths run over the word vectors, the largest response of each filter over the
whole text is kept, and a logistic layer gives the score.

All labelled training rows (but texts above ``MAX_FIT_BYTES``) train the network
in Spark tasks. They are dealt by id into shards of about ``SHARD_ROWS``; one
shard alone takes the network from its random start, and then every shard
trains from the common network, a round over its rows, after which the shards'
changes are averaged (an embedding over the shards that changed it), ``EPOCHS``
times. The driver holds one network, whatever the number of rows. The network
then scores every text in the tasks: per distinct word the filter products are
computed once and cached, so a text costs a few additions per word.

A fifth of the labelled training rows, by a hash of the id, is kept out of the
fit. The scale of the score is set on all of them, counted by their logit (to
``BIN``), so that the best cut of all languages together lies at 0.7;
``thresholds`` has the best cut of each language on the same rows, for
``flagged``. Neither language nor source nor id is an input of a score.

Defined cases: a null or empty text has a score (that of no words); repeated
rows score alike; without labelled rows of both classes every score is 0; a
language without validation rows takes the common cut; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import RDD
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtally.llm.common import crc_of_id, text_bytes

BUCKETS = 1 << 17
SIZE = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
SHARD_ROWS = 6000
MAX_FIT_BYTES = 1 << 16
EPOCHS = 4
STEPS = 20_000
SETTLED = 0.01
RATE = 0.1
INIT = 0.05
CUT = 0.7
BIN = 0.001
_PREFIXES = (4, 5, 6)
_EDGE = b".,!?;:\"'()[]"
_PADS = max(WIDTHS)
_CACHE = 150_000


def features(word: bytes) -> tuple[int, ...]:
    """Buckets of a word: of itself and of its first bytes."""
    word = word.strip(_EDGE) or word
    mask, digest = BUCKETS - 1, xxhash.xxh32_intdigest
    return (digest(word) & mask, *[digest(word[:n], n) & mask for n in _PREFIXES])


def words(text: bytes) -> list[bytes]:
    return text.lower().split()


@dataclass
class Model:
    embedding: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    shift: float
    scale: float = 1.0
    thresholds: dict[str, float] = field(default_factory=dict)

    def logit(self, ids: np.ndarray) -> float:
        return float(_forward(self.embedding, self.filters, self.bias, ids)[0] @ self.out + self.shift)

    def score(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * logits + np.log(CUT / (1 - CUT)), -30, 30)))


def _vectors(embedding: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Word vectors, followed by zero words up to the widest filter."""
    x = np.zeros((max(len(ids), 1) + _PADS - 1, embedding.shape[1]), np.float32)
    if len(ids):
        x[:len(ids)] = embedding[ids].mean(axis=1)
    return x


def _forward(embedding, filters, bias, ids):
    x = _vectors(embedding, ids)
    n = len(x) - _PADS + 1
    pooled, where = [], []
    for w in filters:
        z = sum(x[j:j + n] @ w[j] for j in range(len(w)))
        at = z.argmax(axis=0)
        where.append(at)
        pooled.append(z[at, np.arange(z.shape[1])])
    return np.tanh(np.concatenate(pooled) + bias), where, x


def _begin(rng: np.random.Generator) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Parameters (embedding, filters, bias, out, shift), and Adagrad's sums of squared gradients beside them."""
    embedding = rng.normal(0, INIT, (BUCKETS, SIZE)).astype(np.float32)
    filters = [rng.normal(0, 0.3, (w, SIZE, FILTERS)).astype(np.float32) for w in WIDTHS]
    bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
    out = rng.normal(0, 0.3, len(bias)).astype(np.float32)
    shift = np.zeros(1, np.float32)
    params = [embedding, *filters, bias, out, shift]
    return params, [np.full_like(a, 0.1) for a in params]


def _round(params: list[np.ndarray], totals: list[np.ndarray], texts: list[np.ndarray], labels: np.ndarray, order: np.ndarray) -> None:
    """One Adagrad step per text, in place; settled texts change nothing."""
    embedding, *filters, bias, out, shift = params
    seen = {id(a): t for a, t in zip(params, totals)}

    def step(a, grad):
        total = seen[id(a)]
        total += grad * grad
        a -= RATE * grad / np.sqrt(total)

    for i in order:
        ids = texts[i]
        hidden, where, x = _forward(embedding, filters, bias, ids)
        error = 1 / (1 + np.exp(-np.clip(hidden @ out + shift[0], -30, 30))) - labels[i]
        if abs(error) < SETTLED:
            continue
        back = error * out * (1 - hidden * hidden)
        step(out, error * hidden)
        step(shift, np.array([error], np.float32))
        step(bias, back)
        places, grads = [], []
        for k, (w, at) in enumerate(zip(filters, where)):
            g = back[k * FILTERS:(k + 1) * FILTERS]
            places += [at + j for j in range(len(w))]
            grads += [(w[j] * g).T for j in range(len(w))]
            step(w, np.stack([x[at + j].T * g for j in range(len(w))]))
        place, grad = np.concatenate(places), np.concatenate(grads) / ids.shape[1]
        inside = place < len(ids)
        rows, grad = ids[place[inside]], grad[inside][:, None, :]
        total = seen[id(embedding)]
        np.add.at(total, rows, grad * grad)
        np.add.at(embedding, rows, -RATE * grad / np.sqrt(total[rows]))


def _model(params: list[np.ndarray]) -> Model:
    embedding, *filters, bias, out, shift = params
    return Model(embedding, filters, bias, out, float(shift[0]))


def _trained(texts: list[np.ndarray], labels: np.ndarray, seed: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    rng = np.random.default_rng(seed)
    params, totals = _begin(rng)
    for _ in range(max(EPOCHS, -(-STEPS // len(texts)))):
        _round(params, totals, texts, labels, rng.permutation(len(texts)))
    return params, totals


def train(texts: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Model:
    """Fit by Adagrad on one text at a time; ``texts`` holds the buckets of each word.

    At least ``EPOCHS`` rounds and ``STEPS`` steps; settled texts change nothing.
    """
    return _model(_trained(texts, labels, seed)[0])


def _changes(before: list[np.ndarray], after: list[np.ndarray], rows: np.ndarray) -> list[np.ndarray]:
    """What a shard changed: the first array in ``rows`` only, the others whole."""
    return [after[0][rows] - before[0][rows], *(b - a for a, b in zip(before[1:], after[1:]))]


def _merged(one, other):
    """The sum of two shards' changes: (rows, shards that changed each, shards, changes)."""
    rows, place = np.unique(np.concatenate([one[0], other[0]]), return_inverse=True)
    here, there = place[:len(one[0])], place[len(one[0]):]

    def added(a, b):
        out = np.zeros((len(rows), *a.shape[1:]), a.dtype)
        out[here] += a
        out[there] += b
        return out

    changes = [[added(a[0], b[0]), *(x + y for x, y in zip(a[1:], b[1:]))] for a, b in zip(one[3], other[3])]
    return rows, added(one[1], other[1]), one[2] + other[2], changes


def best_cut(logits: np.ndarray, labels: np.ndarray, counts: np.ndarray | None = None) -> tuple[float, float]:
    """The middle of the best cut (by F1) between sorted logits, and the distance to its neighbours.

    With ``counts``, so many rows have that logit, ``labels`` of them label 1.
    """
    order = np.argsort(logits, kind="stable")
    x, y = logits[order], labels[order]
    right = np.cumsum(y[::-1])[::-1]
    chosen = np.cumsum((np.ones(len(y)) if counts is None else counts[order])[::-1])[::-1]
    f1 = 2 * right / (chosen + max(y.sum(), 1))
    f1[1:][x[1:] == x[:-1]] = -1
    k = int(f1.argmax())
    below = x[k - 1] if k else x[k] - 1
    return float((x[k] + below) / 2), float(max(x[k] - below, 1e-3))


def _coded(texts: list[bytes]) -> list[np.ndarray]:
    """The buckets of each word of each text."""
    known: dict[bytes, int] = {}
    places = [[known.setdefault(w, len(known)) for w in words(t)] for t in texts]
    buckets = np.array([features(w) for w in known], np.uint32).reshape(-1, 1 + len(_PREFIXES))
    return [buckets[np.array(p, np.int64)] for p in places]


def _learned(shards: RDD, whole: bool) -> list[np.ndarray]:
    """Parameters trained on every shard; rows that are kept out only where ``whole``."""
    context = shards.context

    def fitted(part):
        # by id and text: any order of the rows in a shard trains the same
        rows = sorted((doc_id, text or "", label) for doc_id, text, _, label, kept_out in part if whole or not kept_out)
        return _coded([t.encode() for _, t, _ in rows]), np.array([y for *_, y in rows], np.float32)

    def start(part):
        texts, y = fitted(part)
        return [_trained(texts, y, 7)] if texts else []

    params = totals = None
    first = 0
    while params is None:  # a small table may have empty shards
        for params, totals in context.runJob(shards, lambda part: start(v for _, v in part), [first]):
            pass
        first += 1
    if shards.getNumPartitions() == 1:
        return params

    for number in range(EPOCHS):
        shipped = context.broadcast((params, totals))  # about 8 MB, whatever the input

        def learn(index, part):
            texts, y = fitted(v for _, v in part)
            if not texts:
                return
            old = shipped.value
            new = [[a.copy() for a in arrays] for arrays in old]
            _round(*new, texts, y, np.random.default_rng([number, index]).permutation(len(texts)))
            rows = np.flatnonzero((new[1][0] != old[1][0]).any(axis=1))
            yield rows, np.ones((len(rows), 1), np.float32), 1, [_changes(a, b, rows) for a, b in zip(old, new)]

        rows, changed, n, changes = shards.mapPartitionsWithIndex(learn).treeReduce(_merged)
        for arrays, change in zip((params, totals), changes):
            arrays[0][rows] += change[0] / changed
            for a, c in zip(arrays[1:], change[1:]):
                a += c / n
        shipped.unpersist()
    return params


def _usable(docs: DataFrame, labels: DataFrame, training: Column) -> tuple[DataFrame, DataFrame]:
    """The labels that training may use, and the texts with them.

    Never a broadcast join: the labels grow with the input, and so does what is shuffled, at every size.
    """
    usable = labels.where(training & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", "toxic")
    short = F.coalesce(F.octet_length("text"), F.lit(0)) <= MAX_FIT_BYTES
    return usable, docs.where(training & short).select("doc_id", "text", "lang").join(usable.hint("merge"), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, training: Column, shard_rows: int = SHARD_ROWS) -> Model | None:
    """Model from the labelled rows for which ``training`` (of doc_id) holds; None without both classes.

    A fifth of the rows is kept out of the fit and sets the cuts.
    """
    usable, rows = _usable(docs, labels, training)
    n = max(1, -(-usable.count() // shard_rows))
    dealt = rows.select(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(n)).alias("shard"), "doc_id", "text", "lang", "toxic",
                        (F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(5)) == 4).alias("kept_out"))
    # moved once: what the shuffle wrote serves all rounds
    shards = dealt.rdd.map(lambda r: (r[0], tuple(r[1:]))).partitionBy(n, int)
    found = shards.map(lambda r: (r[1][4], r[1][3])).countByValue()  # by kept out and label
    if len({label for _, label in found}) < 2:
        return None
    model = _model(_learned(shards, whole=not all((False, label) in found for label in (0, 1))))
    calibrate(model, shards, whole=not all((True, label) in found for label in (0, 1)))
    return model


def calibrate(model: Model, shards: RDD, whole: bool) -> None:
    """Shift and scale so that the common best cut scores ``CUT``; a cut per language.

    From the rows kept out, or all where ``whole``.
    """
    shipped = shards.context.broadcast(model)

    def binned(part):
        scorer = _Scorer(shipped.value)
        counts: Counter = Counter()
        rows = [v for _, v in part if whole or v[4]]
        for at in range(0, len(rows), 100):
            some = rows[at:at + 100]
            logits = np.clip(scorer.logits([words((r[1] or "").encode()) for r in some]), -100, 100)
            for r, place in zip(some, np.rint(logits / BIN).astype(np.int64).tolist()):
                counts[r[2] or "", place, r[3]] += 1
        return counts.items()

    # at most 200,000 bins of a language and label
    got = shards.mapPartitions(binned).reduceByKey(lambda a, b: a + b).collect()
    shipped.unpersist()
    bins: dict[tuple[str, int], list[int]] = {}
    for (lang, place, label), count in got:
        bins.setdefault((lang, place), [0, 0])[label] += count
    keys = sorted(bins)
    logits = np.array([place * BIN for _, place in keys])
    positive = np.array([bins[k][1] for k in keys], np.float64)
    counts = np.array([sum(bins[k]) for k in keys], np.float64)
    places = np.unique(logits)
    at = np.searchsorted(places, logits)
    cut, gap = best_cut(places, np.bincount(at, positive), np.bincount(at, counts))
    model.shift -= cut
    model.scale = float(np.clip(4.0 / gap, 1.0, 4.0))
    scores = model.score(logits - cut)
    of = np.array([lang for lang, _ in keys])
    for lang in set(of):
        here = of == lang
        if 0 < positive[here].sum() < counts[here].sum():
            model.thresholds[str(lang)] = best_cut(scores[here], positive[here], counts[here])[0]


class _Scorer:
    """Scores batches of texts; filter products of each distinct word are kept."""

    def __init__(self, model: Model):
        self.model = model
        # columns: for each width and each place in it, the products with its filters
        self.weights = np.concatenate([w[j] for w in model.filters for j in range(len(w))], axis=1)
        self.clear()

    def clear(self):
        self.known: defaultdict[bytes, int] = defaultdict()
        self.known.default_factory = self.known.__len__  # a word not seen before gets the next number
        self.known[b""]  # no word: the pad, number 0, whose products stay zero
        self.products = np.zeros((_CACHE + 1, self.weights.shape[1]), np.float32)

    def lookup(self, texts: list[list[bytes]]) -> np.ndarray:
        """Numbers of the words of the texts, each followed by its pads."""
        if len(self.known) > _CACHE:
            self.clear()
        before = len(self.known)
        pads = [b""] * _PADS
        flat = []
        for t in texts:
            flat += t
            flat += pads
        ids = np.fromiter(map(self.known.__getitem__, flat), np.int64, len(flat))
        count = len(self.known)
        if count > len(self.products):
            self.products = np.concatenate([self.products, np.zeros((count - len(self.products), self.weights.shape[1]), np.float32)])
        if count > before:
            fresh = np.array([features(w) for w in islice(reversed(self.known), count - before)])[::-1]
            self.products[before:count] = self.model.embedding[fresh].mean(axis=1) @ self.weights
        return ids

    def logits(self, texts: list[list[bytes]]) -> np.ndarray:
        ids = self.lookup(texts)
        products = self.products.take(ids, axis=0)  # once for all filters
        n = np.array([len(t) for t in texts])
        starts = np.concatenate([[0], np.cumsum(n + _PADS)[:-1]])
        last = len(products) - _PADS + 1
        # a row more, so that every text has an end among the rows
        z = np.zeros((last + 1, len(WIDTHS) * FILTERS), np.float32)
        column = 0
        for k, width in enumerate(WIDTHS):
            z[:last, k * FILTERS:(k + 1) * FILTERS] = sum(
                products[j:j + last, column + j * FILTERS:column + (j + 1) * FILTERS] for j in range(width))
            column += width * FILTERS
        # the largest from each start to its end; what lies between an end and the next start is left
        pooled = np.maximum.reduceat(z, np.stack([starts, starts + np.maximum(n, 1)], axis=1).ravel(), axis=0)[::2]
        hidden = np.tanh(pooled + self.model.bias)
        return hidden @ self.model.out + self.model.shift

    def __call__(self, texts: list[list[bytes]]) -> np.ndarray:
        return self.model.score(self.logits(texts))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang, score of every document."""
    if model is None:
        return docs.select("doc_id", "lang", F.lit(0.0).alias("score"))
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # about 1 MB, whatever the input

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(shipped.value)
        for batch in batches:
            out, group, size = [], [], 0
            for text in text_bytes(batch.column(1)):
                group.append(words(text))
                size += len(text)
                if size > 400_000:
                    out.append(scorer(group))
                    group, size = [], 0
            if group:
                out.append(scorer(group))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), pa.array(np.concatenate(out).astype(np.float64))],
                    names=["doc_id", "lang", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", "lang").mapInArrow(scored, f"doc_id {kind}, lang string, score double")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, flagged (by the cut of its language) of every document.

    Labels are learned from rows whose crc32 of the id is not 1 modulo 3.
    """
    held_out = crc_of_id(F.col("doc_id")) % 3 == 1
    model = fit(docs, labels, ~held_out)
    out = score(docs, model)
    cuts = model.thresholds if model else {}
    cut = F.lit(CUT)
    for lang, value in sorted(cuts.items()):
        cut = F.when(F.coalesce(F.col("lang"), F.lit("")) == lang, F.lit(value)).otherwise(cut)
    return out.select(
        "doc_id", held_out.alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
        (F.col("score") >= cut).cast("int").alias("flagged"),
    )
