import math
import struct

import numpy as np
import pytest

from retentio.llm import whitening as w

SCHEMA = "vec_id long, embedding array<float>, label int, x array<string>, component string, n int, key int"


def frame(spark, rows):
    return spark.createDataFrame([(i, e, k, ["x"], "c", 3, 4) for i, e, k in rows], SCHEMA)


def check(spark, rows, count=16):
    kept = [(i, e) for i, e, _ in rows if e and all(c is not None and math.isfinite(c) for c in e)]
    x = np.array([[math.floor(64 * struct.unpack("f", struct.pack("f", c))[0]) + 1_000_000 for c in e] for _, e in kept], dtype=object)
    fit = np.array(sorted(set(map(tuple, x))), dtype=object)
    n, s = len(fit), fit.sum(axis=0)
    centred = ((fit * n - s) / n).astype(float)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1][:, :count]
    got = sorted(w.whiten(frame(spark, rows), count).collect(), key=str)
    assert len(got) == len(kept) * vectors.shape[1]
    projected = ((x * n - s) / n).astype(float) @ vectors
    want = {}
    for (i, _), y, z in zip(kept, x, projected):
        for c in range(vectors.shape[1]):
            e = values[c]
            live = e > values[0] * 1e-20
            want.setdefault((i, c + 1), []).append((int(((y * n - s) ** 2).sum()), abs(z[c]) / math.sqrt(e) if live else 0.0, e / values.sum() if live else 0.0))
    for r in got:
        assert r.n == n
        near = [d for d, z, e in want[r.vec_id, r.component] if d == r.deviation and abs(abs(r.whitened) - z) < 1e-7 and abs(r.explained - e) < 1e-9]
        assert near, (r, want[r.vec_id, r.component])
        assert r.identity_error < 1e-6
    signs = {}
    for r in got:  # one sign of a component for all rows
        for (i, _), z in zip(kept, projected):
            if i == r.vec_id and abs(abs(z[r.component - 1]) / math.sqrt(max(values[r.component - 1], 1e-300)) - abs(r.whitened)) < 1e-7 and abs(r.whitened) > 1e-3:
                signs.setdefault(r.component, set()).add(math.copysign(1, z[r.component - 1] * r.whitened))
    if len({i for i, _ in kept}) == len(kept):
        assert all(len(v) == 1 for v in signs.values())


@pytest.fixture
def spread():
    rng = np.random.default_rng(1)
    return [(i, [float(c) for c in rng.normal(size=8) * (8, 7, 5, 4, 2, 1, 0.5, 0.3)], i % 3) for i in range(300)]


def test_against_eigh(spark, spread):
    check(spark, spread)


def test_fewer_components_than_entries(spark, spread):
    check(spark, spread, 3)


def test_dropped_and_repeated_rows(spark, spread):
    odd = [(500, None, 1), (501, [1.0, None] + [0.0] * 6, 1), (502, [float("nan")] + [1.0] * 7, None), (503, [float("inf")] * 8, 1), (504, [], 1), (None, spread[0][1], None)]
    check(spark, spread + odd + spread[:120] + [spread[5]] * 200)
    ids = {r.vec_id for r in w.whiten(frame(spark, spread + odd)).select("vec_id").distinct().collect()}
    assert ids == {i for i, _, _ in spread} | {None}


def test_another_length_is_dropped(spark, spread):
    got = w.whiten(frame(spark, spread + [(900, [1.0] * 5, 1)])).select("vec_id").distinct().collect()
    assert {r.vec_id for r in got} == {i for i, _, _ in spread}


def test_no_variance(spark):
    got = w.whiten(frame(spark, [(k, [1.0, 2.0, 3.0], 0) for k in range(5)])).collect()
    assert len(got) == 15 and all(r.whitened == 0 and r.explained == 0 and r.deviation == 0 and r.n == 1 and r.identity_error == 0 for r in got)


def test_few_distinct_vectors(spark):
    check(spark, [(k, [float(k % 3), 2.0 * (k % 3), 5.0, float(k % 2)], 0) for k in range(40)])


def test_very_large_entries(spark):
    got = w.whiten(frame(spark, [(0, [3e38, 1.0], 0), (1, [-3e38, 2.0], 0), (2, [0.0, 3.0], 0)])).collect()
    assert len(got) == 6 and all(math.isfinite(r.whitened) for r in got)


def test_empty(spark):
    assert w.whiten(frame(spark, [])).collect() == []
    assert w.whiten(frame(spark, [(1, None, 2)])).collect() == []


@pytest.mark.parametrize("matrix", ["plain", "graded", "deficient", "equal", "close"])
def test_solver_against_eigh(matrix):
    rng = np.random.default_rng(2)
    r = {"plain": lambda: rng.normal(size=(200, 30)), "graded": lambda: rng.normal(size=(200, 30)) * np.logspace(0, -7, 30),
         "deficient": lambda: np.kron(np.eye(10), np.ones((3, 1))) @ rng.normal(size=(10, 30)),
         "equal": lambda: np.vstack([np.eye(30), -np.eye(30)]), "close": lambda: np.linalg.qr(rng.normal(size=(60, 30)))[0] * (1 + 1e-9 * np.arange(30))}[matrix]()
    r = np.linalg.qr(r, mode="r")
    values, vectors = w.directions(r, 30)
    assert np.allclose(values, np.linalg.eigvalsh(r.T @ r)[::-1], rtol=1e-12, atol=1e-13 * values[0])
    live = vectors[:, values[:30] > 0]
    assert np.abs(live.T @ live - np.eye(live.shape[1])).max() < 1e-10
    assert np.abs(r.T @ r @ live - live * values[:live.shape[1]]).max() < 1e-12 * values[0]


def test_singular_values_have_relative_accuracy():
    """A bidiagonal matrix of widely spread entries: the smallest singular value in all its digits."""
    a, b = np.logspace(0, -12, 13), np.logspace(-1, -12, 12)
    from fractions import Fraction
    product = Fraction(1)
    for x in a:
        product *= Fraction(float(x)) ** 2
    found = Fraction(1)
    for s in w.singular_values_squared(a, b):
        found *= Fraction(float(s))
    assert abs(float(found / product) - 1) < 1e-12  # the determinant holds the small ones
