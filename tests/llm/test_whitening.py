"""Whitening against a dense eigendecomposition."""

import math

import numpy as np
import pytest

from promolens.llm import whitening
from promolens.llm.whitening import leading, whitened_components

DDL = "vec_id long, embedding array<float>, label int, x string, n string"


def table(spark, rows):
    return spark.createDataFrame([(i, e, 1, "clash", "clash") for i, e in rows], DDL).repartition(3)


def brute(vectors, k):
    x = np.floor(64 * np.array(vectors, np.float32).astype(float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(0)
    y = (n * x - s) / n
    values, vecs = np.linalg.eigh(y.T @ y / n)
    values, vecs = values[::-1][:k], vecs[:, ::-1][:, :k]
    return (y @ vecs) / np.sqrt(values), values / np.trace(y.T @ y / n), [sum((n * int(v) - int(t)) ** 2 for v, t in zip(r, s)) for r in x]


def check(found, ids, vectors, k):
    white, explained, deviation = brute(vectors, k)
    rows = {(r.vec_id, r.component): r for r in found.collect()}
    assert len(rows) == len(ids) * k
    got = np.array([[rows[i, c + 1].whitened for c in range(k)] for i in ids])
    assert np.abs(got * np.sign((got * white).sum(0)) - white).max() < 1e-8
    for i, d in zip(ids, deviation):
        for c in range(k):
            row = rows[i, c + 1]
            assert int(row.deviation) == d and row.n == len(ids) and row.identity_error < 1e-9
            assert math.isclose(row.explained, explained[c], rel_tol=1e-9)


def test_equals_dense_decomposition(spark):
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((300, 70)) * np.linspace(3, 1, 70)
    check(whitened_components(table(spark, list(enumerate(vectors.tolist()))), 5, probes=6), range(300), vectors, 5)


def test_unusable_rows_are_left_out_and_copies_count(spark):
    rng = np.random.default_rng(4)
    good = rng.standard_normal((40, 6)).tolist()
    good += [good[0]] * 30
    bad = [None, [], [None] + [1.0] * 5, [math.nan] * 6, [math.inf] + [0.0] * 5, [1.0] * 4, [3e38] + [0.0] * 5]
    rows = list(enumerate(good)) + [(100 + i, e) for i, e in enumerate(bad)]
    check(whitened_components(table(spark, rows), 4), range(70), good, 4)


def test_fewer_dimensions_than_components_and_a_flat_direction(spark):
    rng = np.random.default_rng(5)
    vectors = rng.standard_normal((30, 3)).tolist()
    assert whitened_components(table(spark, [(i, [*v, 2.0]) for i, v in enumerate(vectors)])).count() == 90


def test_null_ids_and_repeated_rows_stay(spark):
    rows = [(None, [1.0, 0.0]), (None, [0.0, 1.0]), (7, [3.0, 1.0]), (7, [3.0, 1.0])]
    found = whitened_components(table(spark, rows)).collect()
    assert len(found) == 8 and sum(r.vec_id is None for r in found) == 4 and sum(r.vec_id == 7 for r in found) == 4


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(5)]])
def test_nothing_to_whiten(spark, rows):
    found = whitened_components(table(spark, rows))
    assert found.collect() == []
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_large_entries_have_exact_deviations(spark):
    vectors = [[1e9, 0.0], [-1e9, 3.0], [5e8, -7.0]]
    found = whitened_components(table(spark, list(enumerate(vectors)))).collect()
    deviation = brute(vectors, 2)[2]
    assert {r.vec_id: int(r.deviation) for r in found} == dict(enumerate(deviation))


def test_certified_where_the_spectrum_hardly_parts():
    """Few probes, gaps of a thousandth: rounds go on until every residual is small; the filter does the work."""
    rng = np.random.default_rng(6)
    basis = np.linalg.qr(rng.standard_normal((120, 120)))[0]
    spectrum = 1 + 0.001 * np.arange(120)[::-1]
    v = basis @ np.diag(spectrum) @ basis.T
    passes = []
    values, q = leading(lambda x: passes.append(x.shape[1]) or v @ x, 120, 10, probes=10)
    assert np.abs(values - spectrum[:10]).max() < 1e-10
    assert np.abs(np.abs((q.T @ basis)[:, :10]) - np.eye(10)).max() < 1e-6
    assert max(passes) == 20


def test_block_grows_where_rounds_do_not_suffice(monkeypatch):
    rng = np.random.default_rng(7)
    basis = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    v = basis @ np.diag(1 + 1e-7 * np.arange(40)) @ basis.T
    monkeypatch.setattr(whitening, "DEGREE", 2)
    values, _ = leading(lambda x: v @ x, 40, 4, probes=1, tolerance=1e-15, rounds=3)
    assert np.allclose(values, 1 + 1e-7 * np.arange(39, 35, -1), atol=1e-12)
