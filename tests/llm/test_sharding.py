import zlib
from collections import Counter, defaultdict

import duckdb

from retentio.llm import sharding


def minimax(sizes, n):
    """Smallest largest sum of n contiguous parts, by dynamic programming."""
    ends = [0]
    for s in sizes:
        ends.append(ends[-1] + s)
    best = ends[:]
    for _ in range(n - 1):
        best = [min(max(best[j], ends[i] - ends[j]) for j in range(i + 1)) for i in range(len(ends))]
    return best[-1]


def greedy(parts, capacity):
    """Each part's groups (lists of (place, size)) filled into shards in order."""
    shards = []
    for part in parts:
        load = None
        for place, size in part:
            if load is None or load + size > capacity:
                shards.append([])
                load = 0
            shards[-1].append(place)
            load += size
    return shards


def by_hand(sizes, n):
    """The shard of each group, by trying every sum of neighbours as the capacity."""
    parts, done = [list(enumerate(sizes))], []
    while True:
        groups = [g for part in parts for g in part]
        if not groups:
            break
        tried = sorted({sum(s for _, s in part[i:j]) for part in parts for i in range(len(part)) for j in range(i + 1, len(part) + 1)})
        low, high = 0, len(tried) - 1
        ok = lambda c: c >= max(s for _, s in groups) and len(greedy(parts, c)) <= n - len(done)
        while low < high:
            mid = (low + high) // 2
            low, high = (low, mid) if ok(tried[mid]) else (mid + 1, high)
        shards = greedy(parts, tried[low])
        largest = min(p for p, s in groups if s == max(s for _, s in groups))
        if n - len(done) > 1 and sizes[largest] == tried[low]:
            taken = [largest]
        elif n - len(done) > 1 and 1 < len(shards) < n - len(done):
            taken = shards[0]
        else:
            done += shards
            break
        done.append(taken)
        parts = [p for part in parts for p in ([g for g in part if g[0] < taken[0]], [g for g in part if g[0] > taken[-1]]) if p]
    return [k for k, shard in enumerate(sorted(done)) for _ in shard]


def test_capacity_is_minimax_and_groups_stay_whole(edges, edge_rows):
    for cells in (7, 50_000):
        rows = sharding.shard_documents(edges, 6, cells).collect()
        assert len(rows) == len(edge_rows)
        groups = {}
        for i, text, *_ in edge_rows:
            g = groups.setdefault(text or "", [None, 0])
            g[0] = i if g[0] is None or (i is not None and i < g[0]) else g[0]
            g[1] += len((text or "").encode()) + 16
        loads = defaultdict(int)
        for r in rows:
            loads[r.shard] += r["size"]
        in_order = sorted(groups.items(), key=lambda g: (g[1][0] is None, g[1][0] or 0))
        assert max(loads.values()) == minimax([g[1][1] for g in in_order], 6)
        for shard in loads:
            assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
        by_crc = defaultdict(set)
        for r in rows:
            by_crc[r.text_crc32].add(r.shard)
        assert all(len(s) == 1 for s in by_crc.values())
        assert {r.text_crc32 for r in rows} == {zlib.crc32((t or "").encode()) for _, t, *_ in edge_rows}


def test_no_shard_stays_empty_beside_a_large_group(spark):
    small, copies = 900, 250  # texts of 84 bytes; copies of one text make a group of 25,000
    rows = [(i, f"{i:08d}" + "x" * 76) for i in range(small)] + [(small + i, "y" * 84) for i in range(copies)]
    rows += [(small + copies + i, f"{small + i:08d}" + "x" * 76) for i in range(small)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for cells in (30, 50_000):
        loads, home = defaultdict(int), defaultdict(set)
        for r in sharding.shard_documents(docs, 40, cells).collect():
            loads[r.shard] += r["size"]
            home[r.text_crc32].add(r.shard)
        assert sorted(loads) == list(range(40)) and max(loads.values()) == copies * 100
        rest = sorted(loads.values())[:-1]  # 900 texts of 100 bytes on each side, in 19 and 20 shards
        assert rest[-1] == 4_800 and rest[1] >= 3_000 and all(len(h) == 1 for h in home.values())


def test_fewer_groups_than_twice_the_shards(spark):
    docs = spark.createDataFrame([(i, f"text {i:02d}") for i in range(11)], "doc_id long, text string")
    loads = Counter(r.shard for r in sharding.shard_documents(docs, 10).collect())
    assert sorted(loads.values()) == [1] * 9 + [2] and sorted(loads) == list(range(10))


def test_empty(nothing):
    assert sharding.shard_documents(nothing).collect() == []


def test_against_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    plain = con.execute(sharding.OP4_SQL).fetchall()  # the first search: its capacity is that of the largest shard
    rows = sharding.op4_sharding(spark, sf).collect()
    assert sorted((r.doc_id, r["size"], r.law) for r in rows) == sorted(r[:3] for r in plain)
    largest = [max(sum(size for k, size in found if k == shard) for shard in {k for k, _ in found})
               for found in ([(r[3], r[1]) for r in plain], [(r.shard, r["size"]) for r in rows])]
    assert largest[0] == largest[1]
    groups = con.execute("""SELECT min(doc_id), sum(octet_length(encode(coalesce(text, ''))) + 16)::BIGINT
        FROM documents GROUP BY coalesce(text, '') ORDER BY 1""").fetchall()
    shard_of = {r.doc_id: r.shard for r in rows}
    assert [shard_of[i] for i, _ in groups] == by_hand([size for _, size in groups], 40)


def test_no_python_on_the_executors(edges):
    plan = sharding.shard_documents(edges, 3)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
