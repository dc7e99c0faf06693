"""Byte-level network: its forward and backward pass against plain ones, held-out accuracy, edge cases."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickpulse.llm import quality_classifier as qc
from clickpulse.llm.queries import op10_quality_classifier

GIVEN = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(1)
    start = qc._initial(rng, 0.5)
    return qc.Model(*(p + rng.standard_normal(p.shape).astype(np.float32) * 0.1 for p in start))


def plain(text, m):
    rows, hidden = qc.chunks(text), []
    for row in rows:
        best = [max(sum(m.tables[w, row[p + w], f] for w in range(qc.WIDTH)) for p in range(qc.CHUNK)) for f in range(qc.FILTERS)]
        hidden.append(np.tanh(np.tanh(np.array(best) + m.bias) @ m.hidden + m.hidden_bias))
    pooled = np.concatenate([np.max(hidden, axis=0), np.mean(hidden, axis=0)])
    return 1 / (1 + np.exp(-(pooled @ m.out + m.out_bias)[0]))


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 992, 993, 70_000])
def test_chunks_cover_every_byte_and_overlap(n):
    data = np.random.default_rng(n).integers(0, 256, n, np.uint8)
    rows = qc.chunks(data.tobytes())
    seen = {k * qc.STEP + i: v for k, row in enumerate(rows) for i, v in enumerate(row[: qc.CHUNK])}
    assert [seen[i] for i in range(n)] == data.tolist()
    assert all(v == qc.PAD for i, v in seen.items() if i >= n) and qc.CHUNK - qc.STEP >= qc.WIDTH - 1


def test_probability_matches_a_plain_pass(model):
    for text in (b"", b"abc", "é%%% ".encode() * 150):
        assert abs(qc.probability(text, model) - plain(text, model)) < 1e-5


def test_gradients_match_differences(model):
    m = qc.Model(*(p.astype(np.float64) for p in model))
    rows = np.concatenate([qc.chunks(b"abc def " * 80), qc.chunks(b"%%% the &&& " * 20), qc.chunks(b"x y z")])
    doc, y = np.array([0, 0, 1, 2]), np.array([1.0, 0.0, 1.0])

    def loss(m):
        hidden = np.tanh(np.tanh(qc._pooled(rows, m)[0].astype(np.float64)) @ m.hidden + m.hidden_bias)
        pooled = [np.concatenate([hidden[doc == i].max(0), hidden[doc == i].mean(0)]) for i in range(3)]
        p = qc._sigmoid((np.array(pooled) @ m.out + m.out_bias)[:, 0])
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    grads = qc._gradients(rows, doc, y, qc.Model(*(p.astype(np.float32) for p in m)))
    for k in (1, 2, 3, 4, 5):  # the layers above the maxima, whose place stays under small steps
        flat = m[k].reshape(-1)
        for i in range(0, flat.size, max(1, flat.size // 7)):
            ends = []
            for sign in (1, -1):
                moved = flat.copy()
                moved[i] += sign * 1e-3
                ends.append(loss(m._replace(**{qc.Model._fields[k]: moved.reshape(m[k].shape)})))
            assert abs((ends[0] - ends[1]) / 2e-3 - grads[k].reshape(-1)[i]) < 2e-3


@pytest.mark.parametrize("labels", [[], [0] * 5, [1] * 5])
def test_training_without_both_labels(labels):
    m = qc.train([b"text"] * len(labels), labels)
    assert abs(qc.probability(b"", m) - (sum(labels) + 0.5) / (len(labels) + 1)) < 1e-5


def test_edge_rows(spark, model):
    schema = "doc_id long, text string, score string"
    rows = [(1, None, "x"), (2, "", "x"), (None, "a b", "x"), (3, "c", "x"), (3, "c", "x"), (4, "é" * 200_000, "x")]
    got = qc.score(spark.createDataFrame(rows, schema), model).collect()
    assert len(got) == 6 and all(0 <= r["score"] <= 1 for r in got)
    by_id = {r["doc_id"]: r["score"] for r in got}
    assert by_id[1] == by_id[2]
    assert qc.score(spark.createDataFrame([], schema), model).count() == 0
    labels = spark.createDataFrame([(1, None), (2, 1), (2, 1), (None, 0)], "doc_id long, quality int")
    docs = spark.createDataFrame(rows, schema)
    assert 0.5 < qc.probability(b"any", qc.train_on(docs, labels, F.lit(True))) < 1


def test_held_out_accuracy(spark):
    rows = op10_quality_classifier(spark, GIVEN).join(spark.read.parquet(f"{GIVEN}/labels.parquet"), "doc_id", "left").collect()
    assert len(rows) == spark.read.parquet(f"{GIVEN}/documents.parquet").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert r["predicted"] == (r["score"] >= 0.7)
    held = [r for r in rows if r["held_out"] and r["quality"] is not None]
    assert sum(r["predicted"] == r["quality"] for r in held) > 0.98 * len(held)
    good = [r["predicted"] for r in held if r["quality"] == 1]
    assert sum(good) > 0.99 * len(good)
