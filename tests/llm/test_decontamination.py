import re

from retentio.llm import decontamination as d

ITEMS = [(1, "One two three four five six seven eight nine ten eleven"), (2, "short item"), (2, "short item"), (None, "w1 w2, w3!"), (4, None), (5, "...")]


def words(t):
    return re.findall("[0-9a-z\x80-\U0010ffff]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(text):
    w, hit, items = words(text), set(), set()
    for i, t in ITEMS:
        q = words(t)
        n = min(10, len(q))
        for j in range(len(q) - n + 1 if n else 0):
            for p in range(len(w) - n + 1):
                if w[p:p + n] == q[j:j + n]:
                    hit |= set(range(p, p + n))
                    items.add("" if i is None else str(i))
    return len(w), len(hit), sorted(items)


def test_against_brute_force(spark, edge_rows):
    from .conftest import frame

    more = [(700, "x ONE-two three, four five six seven eight nine TEN eleven y", "en", "a"), (701, "a Short  item b short item", "en", "a"),
            (702, "w1 w2 w3 w1 w2 w3", "en", "a"), (703, "one two three four five six seven eight nine", "en", "a")]
    rows = [r for r in edge_rows if r[0] != 904] + more
    docs = frame(spark, rows)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    key = lambda x: (str(x[0]), x[1:])
    want = sorted(((i, *brute(t)) for i, t, *_ in rows), key=key)
    for block in (1 << 20, 20):
        found = d.scan_documents(docs, bench, block_bytes=block).collect()
        assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found), key=key) == want
        assert all(r.contaminated == (r.n_hit > 0) and sum(b - a for a, b in r.spans) == r.n_hit for r in found)
    assert d.cut_words("a Short  item, b", [[1, 3]]) == "a , b"


def test_empty(spark, nothing, edges):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert d.scan_documents(nothing, bench).collect() == []
    assert not any(r.contaminated for r in d.scan_documents(edges, bench.limit(0)).collect())


def test_shared_and_repeated_windows():
    passage = " ".join(f"p{k}" for k in range(12))
    items = [(str(k), f"own{k} {passage}") for k in range(50)] + [("again", "a " * 40), ("short", "a b")]
    w = d.WindowSet(items)
    hashes, at, _, _ = w.windows[10]
    assert len(hashes) == len(at) == 50 * 4 + 1  # the 31 equal windows of one item are kept once
    hit, found = w.scan(d.words_of(f"x {passage} y a b"))
    assert hit.tolist() == [False, *[True] * 12, False, True, True] and found == {*range(50), 51}
    assert w.scan(d.words_of("a " * 9))[1] == set()


def test_a_window_takes_few_bytes():
    items = [(str(i), " ".join(f"w{(i * 7919 + k * k) % 5000}" for k in range(200))) for i in range(500)]
    w = d.WindowSet(items)
    kept = w.words.nbytes + sum(h.nbytes + at.nbytes for h, at, _, _ in w.windows.values())
    assert kept <= 17 * 200 * 500
