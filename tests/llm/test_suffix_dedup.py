import hashlib
from collections import Counter

import numpy as np

from retentio.llm import suffix_dedup as s


def brute(rows, length):
    seen = Counter(b[p:p + length] for b in ((t or "").encode() for _, t, *_ in rows) for p in range(len(b) - length + 1))
    out = []
    for i, t, *_ in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p:p + length]] > 1:
                gone[p:p + length] = b"\1" * length
        spans = sum(1 for p in range(len(b)) if gone[p] and not (p and gone[p - 1]))
        out.append((str(i), len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out)


def test_against_brute_force(edges, edge_rows, nothing):
    got = lambda **k: sorted((str(r[0]), *r[1:]) for r in s.dedup_substrings(edges, 60, 16, **k).collect())
    want = brute(edge_rows, 60)
    assert got(batches=3) == want
    assert got(batches=2, hot_rows=2) == want  # every repeated key takes the way of hot ones
    assert s.dedup_substrings(nothing).collect() == []


def test_levels_merge_geometrically(spark):
    family = s.SuffixFamily()
    batches = [[1, 2], [2, 3], [4, 5], [5, 1], [6, 3]]
    for n, keys in enumerate(batches, 1):
        family.add(spark.createDataFrame([(k, 1) for k in keys], "key long, n long"))
        assert [r for r, _ in family.levels] == [r for r in (3, 2, 1, 0) if n >> r & 1]
    assert sorted(r.key for r in family.repeated().collect()) == [1, 2, 3, 5]


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 4, 300, dtype=np.uint8), rng.integers(0, 4, 500, dtype=np.uint8)
    b[100:400] = a
    runs = lambda x: {w: (at - w, key) for first, last, anchor, keys in s.anchor_runs(x, 50, 10)
                      for f, l, at, key in zip(first, last, anchor, keys) for w in range(f, l + 1)}
    ra, rb = runs(a), runs(b)
    assert all(ra[w] == rb[w + 100] for w in range(251)) and len(ra) == 251
