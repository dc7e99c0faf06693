"""Toxicity: held-out accuracy, and edge cases of windows, training and scoring."""

from __future__ import annotations

import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from clickpulse.llm import toxicity
from clickpulse.llm.queries import op4_toxicity

GIVEN = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def trained():
    rnd = random.Random(0)
    syllables = "ba ke li mo nu ra sti tho vel wen".split()
    word = lambda: "".join(rnd.choices(syllables, k=rnd.randrange(1, 5)))
    texts, labels = [], []
    for i in range(400):
        words = [word() for _ in range(rnd.randrange(5, 120))]
        y = i % 4 == 0
        for _ in range(rnd.randrange(2, 6) * y):
            words.insert(rnd.randrange(len(words)), rnd.choice(["frumpish", "zquagg", "dorkifix"]))
        texts.append(" ".join(words))
        labels.append(int(y))
    return toxicity.train(texts[:300], labels[:300]), texts[300:], labels[300:]


def test_windows_cover_every_word():
    for n in range(30):
        words = [f"W{i}".encode() for i in range(n)]
        found = list(toxicity.windows(b" \n".join(words).decode()))
        assert {w for f in found for w in f.split()} == {w.lower() for w in words}
    assert list(toxicity.windows(None)) == list(toxicity.windows(" \t")) == []
    assert max(map(len, toxicity.windows("é" * 10_000))) < 300


def test_unseen_documents_are_told_apart(trained):
    model, texts, labels = trained
    gains = toxicity.Gains(model.ordinary, model.toxic)
    got = [sum(a * b for a, b in zip(model.weights, gains.features(t))) + model.bias > 0 for t in texts]
    assert sum(g == bool(y) for g, y in zip(got, labels)) >= 96


def test_scores_of_edge_rows(spark, trained):
    model = trained[0]
    schema = "doc_id long, text string, score string"
    rows = [(1, None, "x"), (2, "", "x"), (None, "zquagg frumpish dorkifix ba ke", "x"), (3, "ba ke li", "x"), (3, "ba ke li", "x"), (4, "a" * 300_000, "x")]
    got = toxicity.score(spark.createDataFrame(rows, schema), model).collect()
    assert len(got) == 6 and all(0 <= r["score"] <= 1 for r in got)
    by_id = {r["doc_id"]: r["score"] for r in got}
    assert by_id[1] == by_id[2] < 0.5 < by_id[None]
    assert toxicity.score(spark.createDataFrame([], schema), model).count() == 0


@pytest.mark.parametrize("labels", [[], [0] * 9, [1] * 9, [0, 1], [0, 1, 0, 1, 1, 0, 1, 0, 0]])
def test_training_on_little_or_one_sided_data(spark, labels):
    model = toxicity.train([f"some text {i}" for i in range(len(labels))], labels)
    rows = toxicity.score(spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string"), model).collect()
    assert all(0 < r["score"] < 1 for r in rows)


def test_scores_equal_plain_lengths(trained):
    """Each window compressed on its own with a fresh compressor, features and logistic by hand."""
    model, texts, _ = trained
    half = len(model.ordinary) // 2
    both = model.ordinary[:half] + model.toxic + model.ordinary[half:]
    for text in [*texts[:12], "", None]:
        words = (text or "").lower().encode().split()
        found = [b" " + b" ".join(words[i : i + 4]) for i in range(0, max(1, len(words) - 1) if words else 0, 3)]
        gains = [len(toxicity.compressor(model.ordinary).compress(w)) - len(toxicity.compressor(both).compress(w)) for w in found]
        over = [sum(g >= t for g in gains) for t in (1, 2, 3, 4, 6)]
        x = [min(max([0, *gains]), 12) / 4, *(math.log1p(n) for n in over), *(20 * n / (len(gains) + 10) for n in over)]
        want = 1 / (1 + math.exp(-(model.bias + sum(a * b for a, b in zip(model.weights, x)))))
        got = toxicity._raw_scores([text], model, toxicity.Gains(model.ordinary, model.toxic))[0]
        assert got == pytest.approx(want, rel=1e-9)


def test_training_sees_passages_at_the_end_of_long_documents(spark):
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choices("ba ke li mo nu ra sti tho vel wen".split(), k=rnd.randrange(1, 5)))
    docs = []
    for i in range(240):
        words = [word() for _ in range(2500)]
        if i % 4 == 0:
            words[-12:] = [rnd.choice(["frumpish", "zquagg", "dorkifix", word()]) for _ in range(12)]
        docs.append((i, " ".join(words), int(i % 4 == 0)))
    assert min(len(t) for _, t, _ in docs) > 12_000
    frame = spark.createDataFrame(docs, "doc_id long, text string, toxic int")
    model = toxicity.train_on(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"), F.col("doc_id") < 180)
    assert b"zquagg" in model.toxic and b"frumpis" in model.toxic
    kept = spark.createDataFrame([(1, "x" * 7999 + "é"), (2, "".join(map(chr, range(40_000, 50_000))))], "doc_id long, text string")
    whole, cut = (r["t"] for r in kept.select(toxicity.drawn("text").alias("t")).collect())
    assert len(whole) == 8000 and len(cut) == 8000 + 15
    assert cut[0] == chr(40_000) and cut[-1] == chr(49_999)


def test_repeated_ids_give_the_same_model(spark):
    rows = [(i % 40, f"text {i} of words {'zquagg ' * (i % 2)}" * 3) for i in range(160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    assert toxicity.train_on(docs, labels, F.lit(True)) == toxicity.train_on(docs.orderBy(F.desc("text")), labels, F.lit(True))


def test_null_and_repeated_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, None), (None, "c")], "doc_id long, text string, ".rstrip(", "))
    labels = spark.createDataFrame([(1, 0), (1, 0), (2, None), (None, 1), (9, 1)], "doc_id long, toxic int")
    assert toxicity.train_on(docs, labels, F.lit(True)).weights == ()
    assert toxicity.train_on(docs.limit(0), labels.limit(0), F.lit(True)).bias == 0.0


def test_held_out_accuracy(spark):
    rows = op4_toxicity(spark, GIVEN).join(spark.read.parquet(f"{GIVEN}/labels.parquet"), "doc_id", "left").collect()
    assert len(rows) == spark.read.parquet(f"{GIVEN}/documents.parquet").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert r["predicted"] == (r["score"] >= 0.5)
    held = [r for r in rows if r["held_out"] and r["toxic"] is not None]
    right = sum(r["predicted"] == r["toxic"] for r in held) / len(held)
    found = [r["predicted"] for r in held if r["toxic"] == 1]
    false = [r["predicted"] for r in held if r["toxic"] == 0]
    print(right, sum(found) / len(found), sum(false) / len(false))
    assert right > 0.95 and sum(found) > 0.7 * len(found) and sum(false) < 0.02 * len(false)
