"""Whitening against whole-number arithmetic in Python and numpy's eigenvectors."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clickpulse.llm import whitening
from clickpulse.llm.queries import op12_embedding_whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, scale=256, components=4):
    """Rows of (id, component): n, deviation, whitened up to sign, explained."""
    usable = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    numbers = [(i, tuple(math.floor(scale * float(np.float32(c))) for c in v)) for i, v in usable]
    fit = sorted({x for _, x in numbers})
    n, dims = len(fit), len(fit[0])
    sums = [sum(x[d] for x in fit) for d in range(dims)]
    mean = [Fraction(s, n) for s in sums]
    cov = np.array([[float(sum((x[a] - mean[a]) * (x[b] - mean[b]) for x in fit) / n) for b in range(dims)] for a in range(dims)])
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:components], vectors.T[::-1][:components]
    out = {}
    for i, x in numbers:
        off = np.array([float(x[d] - mean[d]) for d in range(dims)])
        deviation = sum((n * x[d] - sums[d]) ** 2 for d in range(dims))
        for k, (e, v) in enumerate(zip(values, vectors)):
            out.setdefault((i, k + 1), []).append((n, deviation, off @ v / math.sqrt(e) if e > 1e-9 else None, e / cov.trace()))
    return out


def compare(got, want):
    assert sum(map(len, want.values())) == len(got)
    signs = {}
    for row in got:
        n, deviation, whitened, explained = want[row["vec_id"], row["component"]][0]
        assert (row["n"], row["deviation"]) == (n, deviation)
        assert row["explained"] == pytest.approx(explained, rel=1e-9)
        if whitened is None:
            assert row["whitened"] is None
        elif abs(whitened) > 1e-6:
            signs.setdefault(row["component"], set()).add(round(row["whitened"] / whitened, 6))
        assert row["identity_error"] < 1e-9
    assert all(found in ({1.0}, {-1.0}) for found in signs.values())


def vectors(count, dims, seed=0):
    rng = np.random.default_rng(seed)
    return (rng.standard_normal((count, dims)) * np.linspace(1, 3, dims)).astype(np.float32).tolist()


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_cross_products_are_exact(data):
    dims, most = data.draw(st.integers(1, 5)), data.draw(st.sampled_from([1, 9, 1 << 20, (1 << 62) - 1]))
    rows = data.draw(st.lists(st.lists(st.integers(-most, most), min_size=dims, max_size=dims), min_size=1, max_size=130))
    sums, products = whitening._summed(np.array(rows, np.int64))
    assert sums == [sum(r[d] for r in rows) for d in range(dims)]
    assert products.tolist() == [[sum(r[a] * r[b] for r in rows) for b in range(dims)] for a in range(dims)]


def test_rows_equal_plain_arithmetic(spark):
    rows = list(enumerate(vectors(300, 6)))
    rows += [(7, rows[3][1]), (None, rows[4][1]), (400, None), (401, [1.0, None] + [0.0] * 4), (402, [float("nan")] + [0.0] * 5)]
    rows += [(403, [float("inf")] + [0.0] * 5), (404, [-0.0] * 6), (405, [0.0] * 6)]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA + ", n string")
    got = whitening.whiten(df.repartition(5)).collect()
    want = plain([(i if i is not None else None, v) for i, v in rows])
    seen = {}
    for row in got:  # ids that repeat have several vectors
        seen.setdefault((row["vec_id"], row["component"]), []).append(row["deviation"])
    assert {k: sorted(v) for k, v in seen.items()} == {k: sorted(r[1] for r in v) for k, v in want.items()}
    compare([r for r in got if r["vec_id"] != 7], {k: v for k, v in want.items() if k[0] != 7})


def test_large_whole_numbers_stay_exact(spark):
    base = [2.0**40, -(2.0**41), 3.0]
    rows = [(i, [base[0] + 4096 * i, base[1] - 8192 * i * i, base[2] * i]) for i in range(50)]
    df = spark.createDataFrame([(i, v) for i, v in rows], "vec_id long, embedding array<double>")
    got = whitening.whiten(df).collect()
    numbers = [tuple(math.floor(256 * c) for c in v) for _, v in rows]
    sums = [sum(x[d] for x in numbers) for d in range(3)]
    for row in got:
        assert row["deviation"] == sum((50 * a - s) ** 2 for a, s in zip(numbers[row["vec_id"]], sums))
        assert row["identity_error"] < 1e-4


def test_components_without_variance_are_null(spark):
    rows = [(i, [float(i), 0.0, 5.0]) for i in range(10)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 30
    assert all((r["whitened"] is None) == (r["component"] > 1) for r in got)
    assert all(r["explained"] == pytest.approx(1 if r["component"] == 1 else 0, abs=1e-12) for r in got)
    one = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 3, "vec_id long, embedding array<double>")).collect()
    assert [(r["n"], int(r["deviation"]), r["whitened"]) for r in one] == [(1, 0, None)] * 6


def test_lengths_are_fitted_apart(spark):
    short, long = list(enumerate(vectors(40, 2))), [(100 + i, v) for i, v in enumerate(vectors(60, 5, 1))]
    df = spark.createDataFrame([(i, v, 0) for i, v in short + long + [(999, [])]], SCHEMA)
    got = whitening.whiten(df).collect()
    compare([r for r in got if r["vec_id"] < 100], plain(short))
    compare([r for r in got if r["vec_id"] >= 100], plain(long))


def test_empty_table_and_one_without_usable_rows(spark):
    for rows in ([], [(1, None, 0), (2, [None], 0)]):
        assert whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_query_on_the_given_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    got = op12_embedding_whitening(spark, "/root/testdata/sf0.001")
    assert dict(got.dtypes)["deviation"] == "bigint"
    compare(got.collect(), plain(rows[:]))
