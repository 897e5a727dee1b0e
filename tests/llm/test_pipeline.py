import collections
import random

import brute
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from jobtally.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("aeioulmnrst") for _ in range(rng.randrange(2, 9)))
    line = lambda n: " ".join(word() for _ in range(n)).capitalize() + "."
    passage = line(60)
    rows = []
    for i in range(120):
        lines = [line(rng.randrange(9, 40)) for _ in range(rng.randrange(1, 6))]
        if i % 6 == 0:
            lines.insert(rng.randrange(len(lines)), passage)
        if i % 9 == 0:
            lines.append("Home | News | About | Contact")
        if i % 10 == 0:
            lines = [lines[0], "BUY!! " * 80]
        rows.append([i, "\n".join(lines), "en", rng.choice(["a", "b", "c", None])])
    for i in range(120, 150):
        copy = rows[rng.randrange(120)]
        text = copy[1]
        if i % 2:
            text = text.replace(" ", "  ", 1)
        rows.append([i, text, "en", copy[3]])
    rows += [[150, None, None, None], [151, "", "en", "a"], [152, "too short.", "en", "a"], [153, "é" * 3000 + " word" * 12, "fr", "b"]]
    return [(*r, None if r[1] is None else len(r[1])) for r in rows]


def expected(rows):
    """Texts after each of the first three stages, and the sizes of the sources."""
    kept = {}
    sources = {}
    for doc_id, text, _, source, _ in rows:
        found = brute.quality(text)
        if found[6]:
            kept[doc_id], sources[doc_id] = found[7], source
    yield dict(kept)
    labels = brute.components({i: brute.shingle_set(t, 5) for i, t in kept.items()}, 80)
    kept = {i: t for i, t in kept.items() if labels[i] == i}
    yield dict(kept)
    kept = {i: data.decode("utf-8", "ignore") for i, data, _, _ in brute.remove_repeats(list(kept.items())) if data}
    yield dict(kept)
    yield brute.mix([(i, len(brute.WORD.findall(t)), sources[i]) for i, t in kept.items()])


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The output of each stage, written and read again as run() does."""
    folder = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(corpus(), SCHEMA).write.parquet(f"{folder}/documents.parquet")
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for k, (_, stage) in enumerate(P.STAGES):
        stage(spark, docs, folder).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        out.append(docs)
    return folder, out


def test_stages_equal_brute_force(stages):
    _, out = stages
    *texts, targets = expected(corpus())
    for got, want in zip(out, texts):
        assert got.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        rows = got.collect()
        assert {r.doc_id: r.text for r in rows} == want and len(rows) == len(want)
        assert all(r.n_chars == len(r.text) for r in rows)
    assert len(texts[0]) > len(texts[1]) and texts[1] != texts[2]
    mixed = out[3].withColumn("size", F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))
    largest = max(len(brute.WORD.findall(t)) for t in texts[2].values())
    taken = {r.source: r.t for r in mixed.groupBy("source").agg(F.sum("size").alias("t")).collect()}
    for source, (_, target) in targets.items():
        assert abs(taken[source] - target) <= largest


def test_packed_ids_are_those_of_the_mix(stages):
    _, out = stages
    tokenizer = Tokenizer.from_file(tokenizer_path())
    want = collections.Counter()
    for r in out[3].collect():
        want[(r.doc_id, len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1)] += 1
    got = collections.Counter()
    for r in out[4].collect():
        got[(r.doc_id, r.doc_tokens)] += r.length
    assert got == collections.Counter({k: n * k[1] for k, n in want.items()})
    assert out[4].agg(F.max("sequence_id")).first()[0] == (sum(k[1] * n for k, n in want.items()) - 1) // 1024


def test_run_gives_the_last_stage(spark, stages):
    folder, out = stages
    got = P.run(spark, folder)
    assert got.columns == out[4].columns
    key = ["doc_id", "doc_tokens", "length"]
    assert got.agg(F.sum("length")).first() == out[4].agg(F.sum("length")).first()
    assert got.select("doc_id", "doc_tokens").distinct().count() == out[4].select(*key[:2]).distinct().count()


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
