"""Packing: every id in exactly one piece, gapless sequences, little padding, balanced steps."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from clickpulse.llm import packing, tokens
from clickpulse.llm.queries import op7_packing

PATH = tokens.vocabulary("byte_bpe_50k.json")
ENCODER = tokens.library_encoder(PATH)


def ids(n, doc):
    return np.arange(doc * 100_000, doc * 100_000 + n, dtype="<u4").tobytes()


def packed(lengths, **options):
    packer = packing.Packer(**options)
    steps = [g for k, n in enumerate(lengths) for g in packer.feed(k, ids(n, k))]
    return steps + list(packer.finish())


def check(steps, lengths, tiers=packing.TIERS):
    pieces, short = defaultdict(list), 0
    for tier, group in steps:
        for sequence in group:
            n = sum(p.length for p in sequence)
            assert 0 < n <= tier and tier in tiers
            short += n < tier
            for p in sequence:
                assert p.doc_tokens == lengths[p.doc]
                pieces[p.doc].append(p)
    assert short <= 1
    for doc, n in enumerate(lengths):
        own = sorted(pieces[doc], key=lambda p: p.start)
        assert b"".join(p.tokens for p in own) == ids(n, doc)
        assert [p.start for p in own] == np.cumsum([0, *(p.length for p in own)]).tolist()[:-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 6000), max_size=60), st.sampled_from([500, 5000, 1 << 20]))
def test_every_id_is_in_one_piece_and_windows_are_full(lengths, round_tokens):
    check(packed(lengths, round_tokens=round_tokens), lengths)


def test_steps_have_equal_tokens_and_close_costs():
    rng = np.random.default_rng(0)
    lengths = np.minimum(rng.lognormal(6, 1, 4000).astype(int) + 1, 9000).tolist()
    steps = packed(lengths)
    check(steps, lengths)
    costs = defaultdict(list)
    for tier, group in steps:
        if sum(p.length for s in group for p in s) == packing.STEP_TOKENS:
            costs[tier].append(sum(p.length**2 for s in group for p in s))
    assert sum(map(len, costs.values())) >= len(steps) - len(packing.TIERS)
    for tier, found in costs.items():
        assert len(found) < 5 or np.std(found) < 0.1 * np.mean(found)
    pieces = sum(len(s) for _, g in steps for s in g)
    whole = sum(-(-n // 2048) for n in lengths)
    assert pieces < 1.9 * whole  # most documents stay in one piece per window


def test_small_tiers_hold_short_documents():
    steps = packed([200] * 50 + [400] * 50 + [2000] * 50)
    used = {tier for tier, _ in steps}
    assert {512, 2048} <= used
    shorter = [s for tier, g in steps if tier == 2048 for s in g if len(s) > 1]
    assert shorter and all(max(p.length for p in s) == 2000 for s in shorter[:40])


def rows_of(spark, df, tmp_path):
    df.write.parquet(str(tmp_path / "documents.parquet"))
    return op7_packing(spark, str(tmp_path)).collect()


def test_query_packs_every_document(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(150).select("doc_id", "text")
    extra = spark.createDataFrame([(10**6, None), (10**6 + 1, ""), (10**6 + 2, "x" * 30000), (None, "y z")], docs.schema)
    df = docs.unionByName(extra).repartition(3)
    rows = rows_of(spark, df, tmp_path)
    want = {d["doc_id"]: next(iter(ENCODER.encode([d["text"]]))) + b"\x01\0\0\0" for d in df.collect()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert pieces.keys() == want.keys()
    for doc, data in want.items():
        at = 0
        for r in sorted(pieces[doc], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(data) // 4
            assert r["ids_crc32"] == zlib.crc32(data[4 * at : 4 * (at + r["length"])])
            at += r["length"]
        assert 4 * at == len(data)
    padding = 0
    for own in sequences.values():
        own.sort(key=lambda r: r["offset"])
        n = sum(r["length"] for r in own)
        assert [r["offset"] for r in own] == np.cumsum([0, *(r["length"] for r in own)]).tolist()[:-1] and n <= 2048
        padding += 0 if n & (n - 1) == 0 else 2048 - n
    assert padding <= 2048 * 3


def test_repeated_rows_clashing_columns_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b", 5, "x")] * 3, "doc_id long, text string, length int, tokens string")
    rows = packing.pack(df.coalesce(1), PATH, 1).collect()
    assert sum(r["length"] for r in rows) == 9 and {r["doc_id"] for r in rows} == {1}
    assert packing.pack(df.limit(0), PATH, 1).count() == 0
