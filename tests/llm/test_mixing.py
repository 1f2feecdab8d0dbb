from collections import defaultdict

import pytest

from retentio.llm import mixing


def fill(sizes, weights, cap):
    """Water-filling by repeated clamping, in floats."""
    total, clamped = sum(sizes.values()), {}
    while True:
        free = {s: w for s, w in weights.items() if s not in clamped}
        left = total - sum(clamped.values())
        over = [s for s, w in free.items() if left * w / sum(free.values()) > cap * sizes[s]]
        if not over:
            return clamped | {s: left * w / sum(free.values()) for s, w in free.items()}
        clamped |= {s: cap * sizes[s] for s in over}


def words(text):
    return len((text or "").encode().split())


def test_targets_and_repetitions(edges, edge_rows):
    rows = mixing.mix(edges).collect()
    assert len(rows) == len(edge_rows)
    sizes = defaultdict(int)
    for _, t, _, s in edge_rows:
        sizes[s] += words(t)
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = fill(sizes, {s: 1 + k % 3 for k, s in enumerate(names)}, 3)
    taken = defaultdict(int)
    for r in rows:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 3 * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0)
        taken[r.source] += r.taken
    for s in names:
        largest = max(words(t) for _, t, _, k in edge_rows if k == s)
        assert abs(taken[s] - want[s]) <= largest / 2 + 1
    key = lambda r: (str(r.doc_id), r["size"], r.taken)
    assert sorted(map(key, rows)) == sorted(map(key, mixing.mix(edges.repartition(5)).collect()))


def test_empty(nothing):
    assert mixing.mix(nothing).collect() == []
