import math
import random

import numpy as np
import pytest
import xxhash
from odd_rows import ODD_ROWS, SCHEMA

from jobtally.llm import toxicity as T


def corpus(n=900, seed=2):
    """Invented words; a third of the texts hold a form of one of two stems."""
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice("abdeiklnorst") for _ in range(rng.randrange(2, 9))) for _ in range(rng.randrange(3, 80))]
        toxic = i % 3 == 0
        if toxic:
            stem = rng.choice(["vermuk", "quoxzel"])
            for _ in range(2):
                words.insert(rng.randrange(len(words)), stem + rng.choice("abcdefghij") + rng.choice("xyz") + rng.choice(["", ",", "."]))
        rows.append((i, " ".join(words), rng.choice(["en", "de"]), "s"))
        labels.append((i, 1, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def classified(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows + ODD_ROWS[1:3], SCHEMA).dropDuplicates(["doc_id"])
    return T.classify(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect(), labels


def test_held_out_accuracy(classified):
    got, labels = classified
    truth = {i: t for i, _, t in labels}
    held = [r for r in got if r.held_out]
    assert len(held) > 200
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= T.CUT) for r in got)


def test_empty_and_null_texts(spark, classified):
    rows, labels = corpus(200)
    docs = spark.createDataFrame(ODD_ROWS, SCHEMA)
    got = T.classify(docs.unionByName(spark.createDataFrame(rows, SCHEMA)), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    by = got.where("doc_id is null or doc_id < 0 or doc_id in (1, 2, 3)").collect()
    assert all(0 <= r.score <= 1 for r in by) and len(by) >= 5


def test_without_labels_and_empty_table(spark, odd, nothing):
    schema = "doc_id long, quality int, toxic int"
    for labels in ([], [(1, 1, 1)], [(None, None, None)]):
        got = T.classify(odd, spark.createDataFrame(labels, schema)).collect()
        assert len(got) == len(ODD_ROWS) and {r.score for r in got} == {0.0}
    assert T.classify(nothing, spark.createDataFrame([], schema)).count() == 0


def test_batch_scorer_equals_network():
    rows, labels = corpus(150)
    texts = [T.words(r[1].encode()) for r in rows] + [[], [b"a"], [b"a", b"b"]]
    coded = [np.array([T.features(w) for w in t], np.int64).reshape(-1, 1 + len(T._PREFIXES)) for t in texts]
    model = T.train(coded[:60], np.array([t for _, _, t in labels[:60]], np.float32))
    want = model.score(np.array([model.logit(c) for c in coded]))
    assert T._Scorer(model)(texts) == pytest.approx(want, abs=1e-5)


def plain_words(text):
    """Buckets of the words of a text, byte by byte."""
    out, word = [], b""
    for b in (text or "").encode() + b" ":
        if b in b" \t\n\x0b\x0c\r":
            if word:
                bare = word
                while bare and bare[0] in b".,!?;:\"'()[]":
                    bare = bare[1:]
                while bare and bare[-1] in b".,!?;:\"'()[]":
                    bare = bare[:-1]
                bare = bare or word
                out.append([xxhash.xxh32(bare).intdigest() % T.BUCKETS]
                           + [xxhash.xxh32(bare[:n], seed=n).intdigest() % T.BUCKETS for n in (4, 5, 6)])
            word = b""
        else:
            word += bytes([b + 32 if 65 <= b <= 90 else b])
    return out


def plain_logit(embedding, filters, bias, out, shift, ids):
    """The network in loops: means, convolutions from every word on, maxima, tanh, one linear layer."""
    size = len(embedding[0])
    vectors = [[sum(float(embedding[b][d]) for b in word) / len(word) for d in range(size)] for word in ids]
    hidden = []
    for filter_ in filters:
        for f in range(filter_.shape[2]):
            best = -math.inf
            for at in range(max(len(vectors), 1)):
                z = 0.0
                for j in range(len(filter_)):
                    if at + j < len(vectors):
                        z += sum(vectors[at + j][d] * float(filter_[j, d, f]) for d in range(size))
                best = max(best, z)
            hidden.append(math.tanh(best + float(bias[len(hidden)])))
    return sum(h * float(o) for h, o in zip(hidden, out)) + shift


def test_scores_equal_loops(spark, monkeypatch):
    """Hashing, convolution, pooling and sigmoid of a fixed model, over whole texts in Spark tasks."""
    rng = np.random.default_rng(3)
    monkeypatch.setattr(T, "_CACHE", 40)
    filters = [rng.normal(0, 1, (w, T.SIZE, T.FILTERS)).astype(np.float32) for w in T.WIDTHS]
    n = len(T.WIDTHS) * T.FILTERS
    model = T.Model(rng.normal(0, 1, (T.BUCKETS, T.SIZE)).astype(np.float32), filters, rng.normal(0, 1, n).astype(np.float32),
                    rng.normal(0, 0.2, n).astype(np.float32), 0.3, 1.5)
    rows = [(i, t) for i, (_, t, _, _) in enumerate(corpus(25)[0])]
    rows += [(100, None), (101, ""), (102, "One"), (103, "'A, b.' (C) ..."), (104, "É\u00a0x \x0by\x0c\x1fz " * 30), (105, "same same same")]
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string")
    got = {r.doc_id: r.score for r in T.score(docs.repartition(3), model).collect()}
    for i, t in rows:
        logit = plain_logit(model.embedding, filters, model.bias, model.out, model.shift, plain_words(t))
        x = 1.5 * logit + math.log(0.7 / 0.3)
        assert got[i] == pytest.approx(1 / (1 + math.exp(-x)), abs=1e-4), (i, t)


def test_gradients_equal_differences(monkeypatch):
    """The first step's gradients, read back from the Adagrad step, are those of the log loss."""
    for name, value in (("BUCKETS", 64), ("EPOCHS", 0), ("STEPS", 0)):
        monkeypatch.setattr(T, name, value)
    ids = np.array([[1, 2, 3, 4], [5, 6, 7, 8], [9, 10, 11, 12], [13, 14, 15, 16], [17, 18, 19, 20]])
    before = T.train([ids], np.array([1.0], np.float32))
    monkeypatch.setattr(T, "STEPS", 1)
    after = T.train([ids], np.array([1.0], np.float32))

    def loss(parts):
        return math.log(1 + math.exp(-plain_logit(parts[0], parts[1:4], parts[4], parts[5], float(parts[6][0]), ids)))

    def parts_of(model):
        return [np.array(p, np.float64) for p in (model.embedding, *model.filters, model.bias, model.out, [model.shift])]

    old, new = parts_of(before), parts_of(after)
    checked = 0
    for k, (a, b) in enumerate(zip(old, new)):
        flat = np.flatnonzero(a != b)
        assert len(flat) > 0
        for at in flat[:: max(1, len(flat) // 6)]:
            step = (b - a).flat[at]
            gradient = -math.copysign(math.sqrt(0.1 * step * step / (T.RATE ** 2 - step * step)), step)
            sides = []
            for d in (1e-5, -1e-5):
                moved = [p.copy() for p in old]
                moved[k].flat[at] += d
                sides.append(loss(moved))
            assert gradient == pytest.approx((sides[0] - sides[1]) / 2e-5, rel=0.02, abs=2e-4), (k, at)
            checked += 1
    assert checked > 30


def test_very_long_rows_do_not_train(spark, monkeypatch):
    rows, labels = corpus(200)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(T, "MAX_FIT_BYTES", 10)
    assert {r.score for r in T.classify(docs, marks).collect()} == {0.0}


def test_best_cut():
    cut, gap = T.best_cut(np.array([3.0, -1.0, 5.0, 0.0]), np.array([1, 0, 1, 0]))
    assert cut == 1.5 and gap == 3.0


def test_score_does_not_read_language(spark):
    rows, labels = corpus(300)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    a = T.classify(spark.createDataFrame(rows, SCHEMA), marks)
    b = T.classify(spark.createDataFrame([(i, t, "xx", None) for i, t, _, _ in rows], SCHEMA), marks)
    assert {r.doc_id: r.score for r in a.collect()} == {r.doc_id: r.score for r in b.collect()}


def test_every_labelled_row_trains(spark, monkeypatch):
    """Rows beyond one shard train the network and set its cuts; no part of them is left out."""
    rows, labels = corpus(1500)
    # a stem of its own in rows of a single shard but the first
    shard = {r.doc_id: r.shard for r in spark.createDataFrame([(i,) for i, *_ in rows], "doc_id long").selectExpr(
        "doc_id", "pmod(xxhash64(doc_id, 7), 4) AS shard").collect()}
    rare = {i for i, _, y in labels if y and shard[i] == 3}
    rows = [(i, t.replace("vermuk", "dwyffg").replace("quoxzel", "dwyffg") if i in rare else t, lang, s) for i, t, lang, s in rows]
    docs = spark.createDataFrame(rows, SCHEMA)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    seen = []
    monkeypatch.setattr(T, "calibrate", lambda model, shards, whole, real=T.calibrate: (
        seen.append((shards.getNumPartitions(), shards.count())), real(model, shards, whole))[1])
    training = T.crc_of_id(T.F.col("doc_id")) % 3 != 1
    want = docs.where(training).count()
    model = T.fit(docs, marks, training, shard_rows=-(-want // 4))
    again = T.fit(docs.repartition(7), marks.repartition(3), training, shard_rows=-(-want // 4))
    assert seen == [(4, want)] * 2
    assert all((a == b).all() for a, b in zip([model.embedding, *model.filters], [again.embedding, *again.filters]))
    truth = {i: y for i, _, y in labels}
    held = [r for r in T.score(docs.where(~training), model).collect()]
    assert sum((r.score >= T.CUT) == truth[r.doc_id] for r in held) / len(held) > 0.95
    rare_held = [r for r in held if r.doc_id in rare]
    assert rare_held and sum(r.score >= T.CUT for r in rare_held) / len(rare_held) > 0.9


def test_labels_are_never_broadcast(spark):
    """The shuffled bytes grow with the input from the smallest tables on: labels and texts are both dealt."""
    rows, labels = corpus(60)
    docs, marks = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    joined = T._usable(docs, marks, T.F.lit(True))[1]
    assert joined.count() == 60
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_words_beyond_the_cache(monkeypatch):
    """The scorer numbers each word once, keeps no more words than its cache and one call's, and pads stay zero."""
    rows, _ = corpus(40)
    texts = [T.words(r[1].encode()) for r in rows]
    model = T.train([np.zeros((1, 4), np.int64)], np.ones(1, np.float32))
    want = T._Scorer(model)(texts)
    monkeypatch.setattr(T, "_CACHE", 50)
    scorer = T._Scorer(model)
    assert np.concatenate([scorer([t]) for t in texts]) == pytest.approx(want, abs=1e-6)
    assert scorer.known[b""] == 0 and not scorer.products[0].any()
    assert len(scorer.known) <= 50 + max(len(t) for t in texts)
