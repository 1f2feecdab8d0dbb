import hashlib
import math
import struct
from collections import defaultdict

import numpy as np
import pytest

from retentio.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int, x array<string>, code string, computed int, _l int, _salt int"


def frame(spark, rows):
    return spark.createDataFrame([(i, e, k, ["x"], "c", 3, 4, 5) for i, e, k in rows], SCHEMA)


def brute(rows, entries=256, rounds=4, parts=4, scale=1024):
    """Plain k-means over all entries in Python's integers."""
    kept = [(i, [math.floor(scale * struct.unpack("f", struct.pack("f", c))[0]) for c in e], k) for i, e, k in rows if e and all(c is not None and math.isfinite(c) for c in e)]
    kept.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    cuts = vc._cuts(len(kept[0][1]), parts)
    book = [[x[c] for _, x, _ in kept[:entries]] for c in cuts]
    d = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b))
    for k in range(rounds + 1):
        codes = [[min(range(len(book[p])), key=lambda j: (d(x[c], book[p][j]), j)) for p, c in enumerate(cuts)] for _, x, _ in kept]
        if k < rounds:
            for p, c in enumerate(cuts):
                members = defaultdict(list)
                for (_, x, _), code in zip(kept, codes):
                    members[code[p]].append(x[c])
                for j, ms in members.items():
                    book[p][j] = [sum(col) // len(ms) for col in zip(*ms)]
    errors = [sum(d(x[c], book[p][code[p]]) for p, c in enumerate(cuts)) for (_, x, _), code in zip(kept, codes)]
    by = defaultdict(int)
    for (_, _, label), e in zip(kept, errors):
        by[label] += e
    sha = hashlib.sha256(",".join(str(v) for b in book for e in b for v in e).encode()).hexdigest()
    return sorted(((i, "".join(f"{j:02x}" for j in code), e, by[label], sha) for (i, _, label), code, e in zip(kept, codes, errors)), key=str)


def got(df):
    return sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect()), key=str)


@pytest.fixture
def clustered():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 10))
    return [(int(i * 7 % 400), [float(c) for c in np.round(centres[i % 12] + 0.2 * rng.normal(size=10), 3)], (i % 4) or None) for i in range(400)]


@pytest.mark.parametrize("entries", [3, 40, 256])
def test_against_brute_force(spark, clustered, entries):
    assert got(vc.vector_codes(frame(spark, clustered).repartition(5), entries=entries)) == brute(clustered, entries)


def test_labels_in_salted_parts(spark, clustered):
    assert got(vc.vector_codes(frame(spark, clustered), entries=40, largest=1)) == brute(clustered, 40)


def test_odd_rows(spark, clustered):
    odd = [(800, None, 1), (801, [1.0, None] + [0.0] * 8, 1), (802, [float("nan")] * 10, None), (803, [float("-inf")] * 10, 1), (804, [], 1),
           (None, clustered[3][1], None), (None, clustered[4][1], 1), (7, clustered[9][1], 2)]
    rows = clustered + odd + [clustered[0]] * 150
    assert got(vc.vector_codes(frame(spark, rows), entries=60)) == brute(rows, 60)
    assert got(vc.vector_codes(frame(spark, rows + [(900, [1.0] * 3, 1)]), entries=60)) == brute(rows, 60)


def test_fewer_vectors_than_entries_and_ties(spark):
    rows = [(k, [float(k // 2)] * 4, 1) for k in range(9)]
    assert got(vc.vector_codes(frame(spark, rows))) == brute(rows)


def test_large_entries_are_exact(spark):
    rows = [(k, [float(k * 9e3), -float(k % 3) * 7e3, 1.0, 2.0, float(k), 0.5, 0.25, 3e5], k % 2) for k in range(30)]
    assert got(vc.vector_codes(frame(spark, rows), entries=5)) == brute(rows, 5)
    huge = got(vc.vector_codes(frame(spark, [(k, [3e38 * (k % 3 - 1)] * 4, k % 2) for k in range(9)]), entries=2))
    assert len(huge) == 9 and any(r[2] is None for r in huge) and any(r[3] is None for r in huge)
    assert vc.as_long([1 << 63, (1 << 63) - 1]) == [None, (1 << 63) - 1]


def test_empty(spark):
    for rows in ([], [(1, None, 2)]):
        out = vc.vector_codes(frame(spark, rows))
        assert out.collect() == [] and out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_net_displacement_saves_work(spark, clustered):
    """Later rounds compute few distances, and fewer than bounds of summed moves would."""
    rows, width = vc.whole_vectors(frame(spark, clustered).select("vec_id", "label", "embedding"), 1024)
    _, book, computed = vc.fit_codes(rows, width, entries=40)
    assert computed[0] >= 400 * 4 * 40 > 4 * computed[1] > 4 * computed[-1]
    history = [np.array([[0, 0]]), np.array([[30, 0]]), np.array([[1, 0]])]  # there and back
    assert vc.Codebook(history, 1).moved[0] == 1  # not 30 + 29


def test_bounds_hold_in_every_round():
    rng = np.random.default_rng(5)
    x = rng.integers(-50, 50, size=(300, 4))
    history, state = [rng.integers(-50, 50, size=(20, 4))], vc.Bounds.unknown(300, 5)
    for _ in range(6):
        book = vc.Codebook(history, 5)
        state, _ = book.assign(x, state)
        d = vc._distances(x, book.entries)
        assert (state.code == d.argmin(axis=1)).all()
        assert (state.upper + book.moved[state.upper_round, state.code] >= np.sqrt(d.min(axis=1))).all()
        for g, members in enumerate(book.groups):
            other = np.where(members[None, :] == state.code[:, None], np.inf, np.sqrt(d[:, members])).min(axis=1)
            assert (state.lower[:, g] - book.group_moved[state.lower_round[:, g], g] <= other + 1e-6).all()
        history = [*history, history[-1] + rng.integers(-9, 10, size=(20, 4))]
