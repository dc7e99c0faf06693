"""The pipeline against plain versions of its stages."""

from __future__ import annotations

import os
import sys
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import corpus_pipeline  # noqa: E402
from test_secret_scan import plain as plain_spans  # noqa: E402
from test_simhash import groups_by_pairs, plain_fingerprint  # noqa: E402

from clickpulse.llm import quality_rules, tokens, toxicity  # noqa: E402

GIVEN = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    """What each stage but the last keeps, as {doc_id: text}, and the last one's rows."""
    docs, out = spark.read.parquet(f"{GIVEN}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, docs, GIVEN)
        assert rows.columns == docs.columns and rows.dtypes == docs.dtypes
        data = [tuple(r) for r in rows.collect()]
        out.append({r[0]: r[1] for r in data})
        assert len(out[-1]) == len(data) and all(r[4] == len(r[1]) for r in data)
        docs = spark.createDataFrame(data, docs.schema)
    return out, corpus_pipeline.pack(spark, docs, GIVEN).collect()


def test_stages_against_plain_versions(spark, kept):
    (clean, good, single, safe), packed = kept
    docs = spark.read.parquet(f"{GIVEN}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    usable = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0
    model = toxicity.train_on(docs, spark.read.parquet(f"{GIVEN}/labels.parquet"), usable)
    gains = toxicity.Gains(model.ordinary, model.toxic)
    raw = {i: model.bias + np.dot(model.weights, gains.features(t)) for i, t in texts.items()}
    assert clean == {i: t for i, t in texts.items() if raw[i] < 0}

    judged = quality_rules.judge(spark.createDataFrame(list(clean.items()), "doc_id long, text string")).where("kept")
    assert good == {r["doc_id"]: r["text"] for r in judged.collect()} and 0 < len(good) < len(clean)

    order = sorted(good)
    groups = groups_by_pairs([plain_fingerprint(good[i]) for i in order])
    assert single == {i: good[i] for i, g in zip(order, groups) if order[g] == i} and len(single) < len(good)

    for i, text in single.items():
        out, at = "", 0
        for start, _, end in plain_spans(text):
            out += text[at:start] + "[SECRET]" if start >= at else ""
            at = max(at, end)
        assert safe[i] == out + text[at:]
    assert safe.keys() == single.keys()

    encoder, pieces = tokens.library_encoder(tokens.vocabulary("byte_bpe_50k.json")), defaultdict(list)
    for r in packed:
        pieces[r["doc_id"]].append((r["start"], bytes(r["tokens"])))
    for i, text in safe.items():
        assert b"".join(t for _, t in sorted(pieces[i])) == next(iter(encoder.encode([text]))) + b"\x01\0\0\0"
    assert pieces.keys() == safe.keys()


def test_run_gives_the_last_stage_of_all(spark, kept):
    rows = corpus_pipeline.run(spark, GIVEN).collect()
    assert {r["doc_id"] for r in rows} == set(kept[0][-1])
    assert sum(r["length"] for r in rows) == sum(r["length"] for r in kept[1])


def test_edge_rows_pass_every_stage(spark):
    schema = spark.read.parquet(f"{GIVEN}/documents.parquet").schema
    long = "the quick brown fox and the lazy dog " * 3
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (2, long, None, None, None), (2, long, None, None, None), (3, "x" * 300_000, "en", "b", None)]
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(rows, schema)
        assert stage(spark, docs, GIVEN).count() >= 0
        assert stage(spark, docs.limit(0), GIVEN).count() == 0


def test_the_dedup_stage_keeps_one_row_of_each_group(spark):
    schema = spark.read.parquet(f"{GIVEN}/documents.parquet").schema
    texts = [(3, "a b c d"), (5, "a b c d"), (5, "q r s t"), (7, "k l m n"), (7, "k l m n"), (None, "k l m n"), (None, "v w"), (None, "v w")]
    docs = spark.createDataFrame([(i, t, None, None, len(t)) for i, t in texts], schema)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, GIVEN)
    assert sorted((r[0] or 99, r[1]) for r in kept.collect()) == [(3, "a b c d"), (5, "q r s t"), (7, "k l m n"), (99, "v w")]
