"""Embedding near-duplicates against all pairs in double precision."""

from __future__ import annotations

import math

import numpy as np
import pytest

from clickpulse.llm import blocks, embedding_dedup
from clickpulse.llm.queries import op8_embedding_near_dedup

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, cosine=0.98):
    """(links, smallest id reachable) of each position, over all pairs."""
    n = len(rows)
    root, links = list(range(n)), [0] * n
    unit = []
    for _, v, label in rows:
        ok = v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v)
        v = np.array(v, np.float32).astype(np.float64) if ok else None
        unit.append(v / np.linalg.norm(v) if ok and len(v) and np.any(v != 0) else None)

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if unit[i] is None or unit[j] is None or rows[i][2] != rows[j][2] or len(unit[i]) != len(unit[j]):
                continue
            if unit[i] @ unit[j] >= cosine:
                links[i] += 1
                links[j] += 1
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return links, [top(i) for i in range(n)]


def sample(seed=0, dim=16):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(40):
        centre = rng.standard_normal(dim)
        for _ in range(rng.integers(1, 6)):
            rows.append(((centre + rng.standard_normal(dim) * rng.choice([0, 0.02, 0.12])).tolist(), int(g % 3)))
    hot = rng.standard_normal(dim)
    rows += [((hot + rng.standard_normal(dim) * 0.15).tolist(), 1) for _ in range(70)]
    rows += [(hot.tolist(), 2)] * 5
    rows += [(None, 1), ([0.0] * dim, 1), ([0.0] * dim, 1), ([float("nan")] + [1.0] * 15, 1), ([None] + [1.0] * 15, 1)]
    rows += [([float("inf")] * dim, 1), (hot.tolist(), None), ([], 1), ([1.0, 2.0], 1), ([2.0, 4.0], 1), ([3.0], 1)]
    rows += [((hot * 1e30).tolist(), 1), ((hot * 1e-30).tolist(), 1)]
    return [(i, [None if x is None else float(np.float32(x)) for x in v] if v is not None else None, y) for i, (v, y) in enumerate(rows)]


@pytest.mark.parametrize("piece", [16, 1024])
def test_all_links_and_groups_are_found(spark, monkeypatch, tmp_path, piece):
    monkeypatch.setattr(blocks.pieces, "__defaults__", (piece,))
    rows = sample()
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = {r["vec_id"]: r for r in op8_embedding_near_dedup(spark, str(tmp_path)).collect()}
    links, root = plain(rows)
    assert len(got) == len(rows) and max(links) > 40
    for i in range(len(rows)):
        assert (got[i]["n_links"], got[i]["component_id"]) == (links[i], root[i]), i
        assert got[i]["kept"] == (root[i] == i)


def test_recall_on_the_given_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    plain_rows = [(r["vec_id"], r["embedding"], r["label"]) for r in rows.orderBy("vec_id").collect()]
    links, _ = plain(plain_rows)
    got = embedding_dedup.near_duplicates(rows).agg({"n_links": "sum"}).first()[0]
    assert sum(links) * 0.999 <= got <= sum(links)


@pytest.mark.parametrize("cosine", [0.9, 0.98, 0.99])
@pytest.mark.parametrize("dim", [1, 2, 3, 4, 8, 32, 384, 1536])
def test_pairs_at_the_cosine_share_a_filter_and_lists_stay_short(dim, cosine):
    words, margin = embedding_dedup.planned(dim, 50_000, cosine)
    code, rng = embedding_dedup.product_code(dim, words), np.random.default_rng(dim)
    u, w = (rng.standard_normal((200, dim)) for _ in range(2))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    w -= (w * u).sum(axis=1, keepdims=True) * u
    v = u if dim == 1 else cosine * u + math.sqrt(1 - cosine**2) * w / np.linalg.norm(w, axis=1, keepdims=True)
    a, b = (embedding_dedup.list_decode(x, code, margin) for x in (u, v))
    assert sum(np.intersect1d(x, y).size > 0 for x, y in zip(a, b)) >= 198
    assert np.mean([len(x) for x in a]) <= 1.2 * embedding_dedup.LIST


@pytest.mark.parametrize("columns", [1, 3, 4096])
def test_shared_numbers(columns):
    rng = np.random.default_rng(0)
    lists = [np.sort(rng.choice(40, rng.integers(0, 6), replace=False)) for _ in range(30)]
    want = [[bool(set(a) & set(b)) for b in lists] for a in lists]
    got = embedding_dedup._shared(lists, columns)
    np.fill_diagonal(got, False)
    assert got.tolist() == [[w and i != j for j, w in enumerate(row)] for i, row in enumerate(want)]


@pytest.mark.parametrize("dim, cosine", [(2, 0.98), (5, 0.95), (100, 0.9), (700, 0.98)])
def test_links_of_other_dimensions_and_cosines(spark, dim, cosine):
    rng, rows = np.random.default_rng(dim), []
    for g in range(60):
        centre = rng.standard_normal(dim)
        rows += [(centre + rng.standard_normal(dim) * s).tolist() for s in (0, 0.05, 0.1, 0.2, 0.45)]
    rows = [(i, [float(np.float32(x)) for x in v], 1) for i, v in enumerate(rows)]
    links, _ = plain(rows, cosine)
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA), cosine=cosine).collect()
    assert sum(links) > 100 and 0.99 * sum(links) <= sum(r["n_links"] for r in got) <= sum(links)
    assert all(r["n_links"] <= links[r["vec_id"]] for r in got)


def test_list_decoding_finds_all_exceeding_filters():
    rng = np.random.default_rng(1)
    unit = embedding_dedup.unit_rows(rng.standard_normal((20, 11)).tolist())
    code = embedding_dedup.product_code(11, 16)
    decoded = embedding_dedup.list_decode(unit, code, 0.1)
    for u, got in zip(unit, decoded):
        score = np.add.outer(u[:6] @ code[0], u[6:] @ code[1]).ravel() / math.sqrt(2)
        assert got.tolist() == np.flatnonzero(score >= score.max() - 0.1).tolist()


def test_empty_tables_repeated_rows_and_clashing_columns(spark):
    schema = SCHEMA + ", n_links int, filter int, key string"
    rows = [(1, [1.0, 0.0], 3, 9, 9, "x"), (1, [1.0, 0.0], 3, 9, 9, "x"), (None, [1.0, 0.01], 3, 9, 9, "x")]
    df = spark.createDataFrame(rows, schema)
    got = sorted(tuple(r) for r in embedding_dedup.near_duplicates(df).na.fill(-1, ["vec_id"]).collect())
    assert got == [(-1, 2, 1, False), (1, 2, 1, True), (1, 2, 1, True)]
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0
