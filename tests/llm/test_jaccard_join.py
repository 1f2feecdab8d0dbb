import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from retentio.llm import jaccard_join as j


def brute(rows):
    sets = []
    for _, t, *_ in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()})
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    lists, overlap = defaultdict(list), Counter()
    for k, s in enumerate(sets):
        for x in s:
            for other in lists[x]:
                overlap[other, k] += 1
            lists[x].append(k)
    for (a, b), o in overlap.items():
        if 100 * o >= 80 * (len(sets[a]) + len(sets[b]) - o):
            parent[root(a)] = root(b)
    least = {}
    for k, (i, *_) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return sorted((str(i), len(sets[k]), str(least.get(root(k)) if sets[k] else i)) for k, (i, *_) in enumerate(rows))


def test_against_brute_force(edges, edge_rows):
    want = brute(edge_rows)
    for long in (j.LONG, 4):  # 4: lists in pieces, and the salted join
        assert sorted((str(r[0]), r[1], str(r[2])) for r in j.jaccard_components(edges, long=long).collect()) == want


def test_empty(nothing):
    assert j.jaccard_components(nothing).collect() == []


def test_a_list_of_unlinked_sets_takes_linear_rows():
    n = 1500
    sets = np.arange(n, dtype=np.int64) * 7919 + 1
    batch = pa.RecordBatch.from_arrays([pa.array(np.zeros(n, dtype=np.int64)), pa.array(sets), pa.array(np.full(n, 50, dtype=np.int32)),
                                        pa.array(np.zeros(n, dtype=np.int32)), pa.array(sets)], names=["token", "set", "size", "pos", "component"])
    tracemalloc.start()
    out = list(j._attach(80)([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n <= sum(b.num_rows for b in out) <= 2 * n and peak < 4_000_000
    pairs = list(j._between(80, 10_000)([batch]))
    assert sum(b.num_rows for b in pairs) == n * (n - 1) // 2 and max(b.num_rows for b in pairs) < 10_000 + n


def test_only_lists_of_several_components_stay():
    token = np.repeat(np.arange(5), [3, 6, 2, 7, 1]).astype(np.int64)
    comp = np.array([1, 1, 1, 1, 1, 1, 2, 2, 2, 3, 4, 5, 5, 5, 5, 5, 5, 5, 9], dtype=np.int64)
    cols = [token, np.arange(len(token), dtype=np.int64), np.full(len(token), 9, dtype=np.int32), np.zeros(len(token), dtype=np.int32), comp]
    for step in (1, 3, 100):
        batches = [pa.RecordBatch.from_arrays([pa.array(x[k:k + step]) for x in cols], names=["token", "set", "size", "pos", "component"]) for k in range(0, len(token), step)]
        got = [(r["token"], r["set"], r["long"]) for b in j._only_open(4)(iter(batches)) for r in b.to_pylist()]
        open_rows = [(t, s, t == 1) for t, s in zip(token.tolist(), range(len(token))) if t in (1, 2)]
        assert [r for r in got if r[0] != 3] == open_rows
        assert all(r[2] for r in got if r[0] == 3)  # one component, but longer than a task holds


def test_sketches_rule_out_no_similar_sets():
    rng = np.random.default_rng(3)
    for threshold in (80, 50, 100):
        for size in (1, 3, 63, 64, 65, 200, 513, 1030):
            a = np.unique(rng.integers(-2**63, 2**63, size))
            sets = [a[k:] for k in range(0, size, max(1, size // 40))]
            sets += [np.unique(np.append(a, rng.integers(-2**63, 2**63, k))) for k in range(0, size, max(1, size // 40))]
            block = j._Sketches([(k, len(x), j._sketch(x)) for k, x in enumerate(sets)], threshold)
            assert block.meets(len(a), j._sketch(a))
            similar = [k for k, x in enumerate(sets) if 100 * len(np.intersect1d(a, x)) >= threshold * len(np.union1d(a, x))]
            assert set(similar) <= set(block.used())
    far = np.unique(rng.integers(-2**63, 2**63, 500))
    block = j._Sketches([(k, 500, j._sketch(np.unique(rng.integers(-2**63, 2**63, 500)))) for k in range(50)], 80)
    assert not block.meets(500, j._sketch(far)) and block.used() == []


def test_sets_that_share_only_a_passage_do_not_travel(spark, monkeypatch):
    passage = " ".join(f"p{k}" for k in range(12))
    rows = [(d, " ".join([passage] + [f"w{d}x{k}" for k in range(60)])) for d in range(40)]
    rows += [(100 + d, " ".join([t, "end"])) for d, t in rows[:3]]
    compared, answers = [], j._answers
    monkeypatch.setattr(j, "BUCKETS", 1)  # no shingle is known to be rare: the passage is in the prefixes
    monkeypatch.setattr(j, "_answers", lambda work, sets: compared.append(work.where("probe").count()) or answers(work, sets))
    got = {r.doc_id: r.component_id for r in j.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {d: d - 100 if d >= 100 else d for d, _ in rows}
    assert sum(compared) <= 12


def test_a_list_of_two_sets_is_done():
    token = np.repeat(np.arange(3), [2, 3, 2]).astype(np.int64)
    cols = [token, np.array([1, 2, 3, 4, 5, 6, 6], dtype=np.int64), np.full(7, 9, dtype=np.int32), np.zeros(7, dtype=np.int32)]
    for step in (1, 2, 7):
        batches = [pa.RecordBatch.from_arrays([pa.array(x[k:k + step]) for x in cols], names=["token", "set", "size", "pos"]) for k in range(0, 7, step)]
        rows = [r for b in j._lists(80, 100)(iter(batches)) for r in b.to_pylist()]
        assert [(r["token"], r["set"], r["done"]) for r in rows] == [(0, 1, True), (0, 2, True), (1, 3, False), (1, 4, False), (1, 5, False)]
        assert {r["lead1"] for r in rows[:2]} - {None} <= {1, 2} and any(r["lead1"] for r in rows[:2])
        pieces = [r for b in j._lists(80, 1)(iter(batches)) for r in b.to_pylist()]
        assert not any(r["done"] for r in pieces if r["token"] == 1)
