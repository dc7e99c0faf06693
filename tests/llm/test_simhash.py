"""SimHash near-duplicates against all pairs on small inputs."""

from __future__ import annotations

import random
import re

import numpy as np
import pandas as pd
import pytest
import xxhash

from clickpulse.llm import blocks, simhash
from clickpulse.llm.queries import op2_simhash_near_dedup


def plain_fingerprint(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups_by_pairs(marks, distance=3):
    """Smallest position reachable, by union-find over all pairs."""
    root = list(range(len(marks)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(marks)):
        for j in range(i):
            if bin(marks[i] ^ marks[j]).count("1") <= distance:
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(marks))]


def corpus(seed=1, n=120):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "ÀB", "İx"]
    texts = [None, "", " \n\t", "one", "ONE", "one two", "a\x0bb c", "a b c d"]
    while len(texts) < n:
        words = rnd.choices(vocabulary, k=rnd.choice([5, 60, 200]))
        texts.append(" ".join(words))
        for _ in range(rnd.randrange(4)):
            words = list(words)
            words[rnd.randrange(len(words))] = "New"
            texts.append("  ".join(words))
    return texts


def test_a_bit_of_exactly_half_the_shingles_is_zero():
    a, b = (xxhash.xxh64_intdigest(g, 42) for g in (b"a b c", b"b c d"))
    assert simhash.fingerprint(b"a b c d") & (1 << 64) - 1 == a & b
    assert simhash.fingerprint(b"a b c a b c") & (1 << 64) - 1 == plain_fingerprint("a b c a b c")  # a shingle twice of four


def test_fingerprint_matches_its_definition():
    for text in [*corpus(), "x " * 70000]:
        want = plain_fingerprint(text)
        assert simhash.fingerprint((text or "").encode()) & (1 << 64) - 1 == want


def test_groups_match_all_pairs(spark, tmp_path):
    texts = corpus()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    rows = {r["doc_id"]: r for r in op2_simhash_near_dedup(spark, str(tmp_path)).collect()}
    marks = [plain_fingerprint(t) for t in texts]
    want = groups_by_pairs(marks)
    assert len(rows) == len(texts) and len(set(want)) < len(texts)
    for i, mark in enumerate(marks):
        assert rows[i]["fingerprint"] == f"{mark:016x}"
        assert rows[i]["component_id"] == want[i]


@pytest.mark.parametrize("piece", [8, 1024])
def test_a_hot_bucket_of_close_marks_loses_no_link(spark, monkeypatch, piece):
    """Many fingerprints that differ in few bits, cut into pieces, and chains that only steps join."""
    monkeypatch.setattr(blocks.pieces, "__defaults__", (piece,))
    rnd = random.Random(2)
    marks = {rnd.getrandbits(64) for _ in range(60)}
    base = rnd.getrandbits(64)
    marks |= {base ^ sum(1 << b for b in rnd.sample(range(20), rnd.randrange(9))) for _ in range(120)}
    marks |= {(1 << 3 * k) - 1 for k in range(1, 20)}
    marks = sorted(marks)
    signed = [(m - (1 << 64) if m >> 63 else m,) for m in marks]
    df = spark.createDataFrame(signed, "fingerprint long")
    pairs = [(r["a"] & (1 << 64) - 1, r["b"] & (1 << 64) - 1) for r in simhash.links(df).collect()]
    assert all(bin(a ^ b).count("1") <= 60 for a, b in pairs)
    at = {m: i for i, m in enumerate(marks)}
    root = np.arange(len(marks))
    for _ in range(len(marks)):
        for a, b in pairs:
            root[at[a]] = root[at[b]] = min(root[at[a]], root[at[b]])
    assert root.tolist() == groups_by_pairs(marks)


def test_every_plan_of_blocks_meets_close_pairs():
    assert simhash.plan_blocks(10) == (4, 1)
    rnd = random.Random(3)
    for n in (10, 10**5, 10**8, 10**10, 10**15):
        count, shared = simhash.plan_blocks(n)
        assert count - shared == 3
        for _ in range(200):
            flips = rnd.sample(range(64), 3)
            clean = sum(not any(a <= f < z for f in flips) for a, z in simhash._bounds(count))
            assert clean >= shared


def test_keep_one_with_nulls_repeats_and_clashing_columns(spark):
    schema = "doc_id long, text string, fingerprint string, component_id int"
    rows = [(5, "a b c d", "x", 1), (3, "A b c d", "x", 1), (None, "a b c d", "x", 1), (7, "q r s t u", "x", 1), (7, "q r s t u", "x", 1)]
    df = spark.createDataFrame(rows, schema)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r[0] or -1) for r in kept.collect()) == [-1, 3, 7, 7]
    assert simhash.keep_one(df.limit(0)).count() == 0


def test_keep_one_judges_each_row_by_its_own_text(spark):
    x, y, z = "a b c d e", "q r s t u", "k l m n o"
    rows = [(3, x), (5, x), (5, y), (7, y), (9, z), (9, z), (None, z), (None, "v w"), (None, "v w"), (8, ""), (8, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = [tuple(r) for r in simhash.keep_one(df).collect()]
    assert {(3, x), (5, y)} <= set(kept) and (5, x) not in kept and (7, y) not in kept
    one = simhash.keep_one(df, repeats=False)
    assert one.columns == df.columns
    got = sorted((r[0] or 99, r[1] or "") for r in one.collect())
    assert got == [(3, x), (5, y), (8, ""), (9, z), (99, "v w")]
    assert simhash.keep_one(df.limit(0), repeats=False).count() == 0


def test_forest_keeps_groups_together():
    a, b = np.array([4, 3, 1, 6]), np.array([3, 2, 0, 5])
    child, root = blocks.forest(a, b, 8)
    assert dict(zip(child.tolist(), root.tolist())) == {1: 0, 3: 2, 4: 2, 6: 5}
    assert simhash._close(3)(pd.DataFrame({"fingerprint": np.array([], np.int64), "piece": np.array([], np.int64)})).empty
