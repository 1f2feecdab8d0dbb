import random

import duckdb
import numpy as np
import pytest

from retentio.llm import odd_sketches as o
from retentio.llm.jaccard_join import shingles

from .test_jaccard_join import brute as five_words


def brute(rows, n=2):
    sets = []
    for _, t, *_ in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} - {()})
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                parent[root(a)] = root(b)
    least = {}
    for k, (i, *_) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    out = []
    for k, (i, *_) in enumerate(rows):
        component = least.get(root(k)) if sets[k] else i
        out.append((str(i), len(sets[k]), str(component), i == component))
    return sorted(out)


def got(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in df.collect())


@pytest.mark.parametrize("part, block", [(o.PART, o.BLOCK), (3, 2)])  # 3 and 2: bands in several parts, clusters in several blocks
def test_against_brute_force(edges, edge_rows, part, block):
    assert got(o.near_duplicates(edges, part=part, block=block)) == brute(edge_rows)


def test_chains_and_a_hot_group(spark):
    """Copies of copies, each a little further from the first, and a group that holds a third of the rows."""
    rng = random.Random(8)
    words = [f"v{k}" for k in range(500)]
    rows, text = [], [rng.choice(words) for _ in range(60)]
    for k in range(150):
        rows.append((k, " ".join(text), "en", "a"))
        text[rng.randrange(60)] = rng.choice(words)
        if k % 10 == 9:
            text[rng.randrange(60)] = rng.choice(words)
    base = [rng.choice(words) for _ in range(80)]
    for k in range(150, 300):
        copy = list(base)
        for _ in range(rng.choice((0, 1, 3, 4, 6))):
            copy[rng.randrange(80)] = rng.choice(words)
        rows.append((k, " ".join(copy), "en", "a"))
    rows += [(k, " ".join(rng.choice(words) for _ in range(40)), "en", "b") for k in range(300, 380)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(4)
    assert got(o.near_duplicates(df, part=20, block=12)) == brute(rows)


def test_empty(nothing):
    assert o.near_duplicates(nothing).collect() == []


def test_sketches_never_hide_a_similar_pair_and_estimate_it():
    rng = np.random.default_rng(6)
    limit = o.most_bits(80)
    assert limit < 2 * o.SAMPLES / 2
    errors = []
    for true in (0.8, 0.85, 0.95, 0.3, 0.1):
        common = rng.integers(-1 << 62, 1 << 62, size=400)
        rest = rng.integers(-1 << 62, 1 << 62, size=(2, round(400 * (1 - true) / true / 2)))
        a, b = (o.odd_sketch(o.minhashes(np.concatenate((common, r)))) for r in rest)
        bits = sum(bin(int(x) & (1 << 64) - 1).count("1") for x in a ^ b)
        if true >= 0.8:
            assert bits <= limit
            errors.append(abs(o.similarity(bits) - true))
        else:
            assert bits > limit
    assert max(errors) < 0.1


def test_overlaps_of_a_block():
    rng = random.Random(2)
    sets = [np.array(sorted(rng.sample(range(60), rng.randrange(1, 30)))) for _ in range(25)]
    want = [[len(set(a) & set(b)) for b in sets] for a in sets]
    got_ = o.overlaps(np.concatenate(sets), np.array([len(s) for s in sets]), columns=7)
    assert all(got_[i][j] == want[i][j] for i in range(25) for j in range(25) if i != j)


def test_forest_joins_what_the_masks_join():
    masks = np.zeros((6, 6), dtype=bool)
    masks[0, 3] = masks[3, 5] = masks[0, 5] = masks[1, 2] = True
    masks |= masks.T
    assert len(o._forest(np.arange(6), enumerate(masks))[0]) == 3
    assert o._forest(np.array([0, 1, 1, 0, 4, 0]), enumerate(masks))[0] == []


def test_long_texts_in_chunks():
    h = shingles(" ".join(map(str, range(5000))), 2)
    parts = [o.minhashes(h[at:at + 100]) for at in range(0, len(h), 100)]
    assert (o.minhashes(h) == np.min(parts, axis=0)).all()


def test_samples_differ_like_independent_ones():
    """Over many pairs of similarity 0.85 the number of differing samples has a binomial's mean and spread."""
    rng = np.random.default_rng(9)
    differ = []
    for _ in range(300):
        x = rng.integers(-1 << 62, 1 << 62, size=68 + 2 * 6)
        a, b = o.minhashes(x[:74]), o.minhashes(np.concatenate((x[:68], x[74:])))
        differ.append(int((a != b).sum()))
    mean = 256 * 0.15
    assert abs(np.mean(differ) - mean) < 2 and abs(np.std(differ) - (mean * 0.85) ** 0.5) < 1.2


def test_sql_of_five_words_equals_brute_force(edge_rows):
    rows = [r for k, r in enumerate(edge_rows) if r[0] is not None and r[0] not in (905, 904)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [r[:2] for r in rows])
    want = con.execute(o.components_sql(5)).fetchall()
    assert sorted((str(a), b, str(c)) for a, b, c in want) == five_words(rows)
