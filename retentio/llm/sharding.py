"""Sharding: minimax contiguous partition of ordered atomic groups.

Documents with equal texts form a group that is never split. Groups are ordered
by their smallest doc_id, and the order is cut into ``n_shards`` runs so that
the largest run is as small as it can be. The smallest capacity is found by
binary search; a capacity is checked by filling shards greedily.

The groups' running sums stay on the cluster. The driver holds at most ``cells``
rows of (smallest, largest, count) over stretches of them. A greedy cut that
falls inside a stretch lies between two bounds; the search runs once with the
lower and once with the upper bound, and only the stretches that cuts can
still touch are split further. A few rounds make the bounds meet, so the
capacity and the cuts are exact. Everything is DataFrame operations.

A group as large as the capacity fills a shard alone, and says nothing about the
rest: it is set apart, and the search runs again for the stretches between such
groups and the shards that are left. The same is done with the first shard while
shards would stay empty. So neither leaves the other shards unequal.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import running, stored

OVERHEAD = 16


class _Cells:
    """Sorted stretches (smallest, largest, count) of the running sums."""

    def __init__(self, cells):
        self.cells = sorted(cells)
        self.lows = [c[0] for c in self.cells]

    def cut(self, x: int, least: bool) -> int:
        """The largest running sum <= x, or a bound of it (from below or above)."""
        i = bisect_right(self.lows, x) - 1
        if i < 0:
            return 0
        low, high, n = self.cells[i]
        if x >= high:
            return high
        return low if least or n <= 2 else x

    def fill(self, capacity: int, n: int, parts: list[tuple[int, int]], least: bool) -> list[int] | None:
        """Greedy cuts of the ``parts`` with this capacity; None if more than ``n`` shards are needed."""
        cuts = []
        for at, end in parts:
            while at < end:
                cut = end if at + capacity >= end else self.cut(at + capacity, least)
                if cut <= at or len(cuts) == n:
                    return None
                cuts.append(cut)
                at = cut
        return cuts

    def smallest(self, n: int, parts: list[tuple[int, int]], low: int, least: bool) -> int:
        high = sum(end - at for at, end in parts)
        while low < high:
            mid = (low + high) // 2
            if self.fill(mid, n, parts, least) is None:
                low = mid + 1
            else:
                high = mid
        return low

    def reached(self, capacity: int, n: int, at: int, end: int) -> list[int]:
        """Lower bounds of the first ``n`` greedy cuts of a part, also where the fill fails."""
        out = []
        for _ in range(n):
            at = end if at + capacity >= end else max(at, self.cut(at + capacity, True))
            out.append(at)
        return out


def _fetch(ends: DataFrame, ranges: list[tuple[int, int]], cells: int) -> list[tuple[int, int, int]]:
    """Stretches of the running sums within ``ranges`` (inclusive), ``cells`` at most in all."""
    width = sum(b - a + 1 for a, b in ranges)
    share = max(1, cells - len(ranges))
    cell, inside, base = None, None, 0
    for a, b in ranges:
        step = max(1, -(-width // share))
        here = F.col("_end").between(a, b)
        index = F.floor((F.col("_end") - a) / step) + base
        cell = F.when(here, index) if cell is None else cell.when(here, index)
        inside = here if inside is None else inside | here
        base += (b - a) // step + 1
    found = (ends.where(inside).groupBy(cell.alias("_cell"))
             .agg(F.min("_end"), F.max("_end"), F.count("*")).collect())
    return [(r[1], r[2], r[3]) for r in found]


def _settled(ends: DataFrame, known: _Cells, n: int, parts: list[tuple[int, int]], least: int, cells: int) -> tuple[_Cells, int, list[int]]:
    """The smallest capacity for ``n`` shards of the parts and its cuts, with what was fetched for it."""
    while True:
        low = known.smallest(n, parts, least, least=False)
        high = known.smallest(n, parts, low, least=True)
        first = known.fill(low, n, parts, least=True)
        last = known.fill(high, n, parts, least=False)
        if low == high and first == last:
            return known, low, first
        # cut j + 1 of a part lies between these for every capacity that is still possible
        spans = []
        for at, end in parts:
            latest = [c for c in last if at < c <= end]
            earliest = [at, *known.reached(low, n, at, end)]
            spans += [(x + low, min(y + high, end)) for x, y in zip(earliest, [at, *latest, *[end] * (n - len(latest))]) if x < end]
        touched = [c for c in known.cells if c[2] > 2 and any(c[0] <= y and x <= c[1] for x, y in spans)]
        split = set(touched)
        rest = [c for c in known.cells if c not in split]
        found = []
        for k in range(0, len(touched), 60):  # a few dozen ranges a query
            ranges = [(x, y) for x, y, _ in touched[k:k + 60]]
            found += _fetch(ends, ranges, max(120, cells * 60 // max(60, len(touched))))
        known = _Cells(rest + found)


def minimax_cuts(ends: DataFrame, n_shards: int, cells: int = 50_000) -> list[int]:
    """Where to cut ``ends`` (running sums ``_end`` of the ordered group sizes ``_size``)."""
    total = ends.agg(F.max("_end")).first()[0]
    if not total:
        return []
    # a group set apart is at least as large as the mean of what is left: n_shards of them at most
    large = [(r["_end"] - r["_size"], r["_end"]) for r in
             ends.orderBy(F.desc("_size"), "_end").limit(n_shards).select("_end", "_size").collect()]
    known, alone = _Cells(_fetch(ends, [(1, total)], cells)), []
    while True:
        marks = [0, *(x for pair in sorted(alone) for x in pair), total]
        parts = [(x, y) for x, y in zip(marks[::2], marks[1::2]) if x < y]
        n = n_shards - len(alone)
        if not parts:
            return sorted(y for _, y in alone)
        large = [(x, y) for x, y in large if any(a <= x and y <= b for a, b in parts)]
        largest = large[0][1] - large[0][0] if large else 1
        known, capacity, cuts = _settled(ends, known, n, parts, max(largest, -(-sum(y - x for x, y in parts) // n)), cells)
        if n > 1 and large and capacity == largest:
            alone.append(large[0])
        elif n > 1 and 1 < len(cuts) < n:
            alone.append((parts[0][0], cuts[0]))
        else:
            return sorted([*cuts, *(y for _, y in alone)])


def shard_documents(docs: DataFrame, n_shards: int = 40, cells: int = 50_000) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Size is the UTF-8 length of the text plus 16. A null text counts as the
    empty text (size 16, crc 0, one group with the empty texts). A null doc_id
    sorts last. Repeated rows are placed separately, in the same shard. More
    shards than groups leave the last shards empty. An empty table gives an
    empty result. Other columns of ``docs`` are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = stored(docs.select(
        F.col("doc_id"), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.md5(text.cast("binary")).alias("_key")), "shard-base")
    groups = base.groupBy("_key").agg(F.min("doc_id").alias("_first"), F.sum("size").alias("_size"))
    in_order = [F.col("_first").asc_nulls_last(), F.col("_key")]
    ends = stored(running(groups, in_order, "_size", "_end", "shard-groups"), "shard-ends")
    cuts = minimax_cuts(ends, n_shards, cells)
    bounds = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.array().cast("array<long>")
    placed = base.join(ends.select("_key", "_end", F.size(F.filter(bounds, lambda c: c < F.col("_end"))).alias("shard")), "_key")
    by_place = [F.col("_end"), F.col("doc_id").asc_nulls_last()]
    numbered = stored(running(placed.withColumn("_one", F.lit(1).cast("long")), by_place, "_one", "_rank", "shard-placed"), "shard-ranks")
    first = numbered.groupBy("shard").agg(F.min("_rank").alias("_start"))  # one row per shard
    return numbered.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("_rank") - F.col("_start")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op4_sharding(spark, sf_dir: str) -> DataFrame:
    return shard_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: Greedy filling and the binary search as one recursion: each step places one cut or moves the bounds.
OP4_SQL = """
WITH RECURSIVE base AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 16 AS size, md5(coalesce(text, '')) AS k FROM documents
), grp AS (
  SELECT k, min(doc_id) AS f, CAST(sum(size) AS BIGINT) AS s FROM base GROUP BY k
), ends AS (
  SELECT k, CAST(sum(s) OVER (ORDER BY f NULLS LAST, k) AS BIGINT) AS e, s FROM grp
), lim AS (
  SELECT max(e) AS t, greatest(max(s), (max(e) + 39) // 40) AS least FROM ends
), search(lo, hi, pos, used) AS (
  SELECT least, t, CAST(0 AS BIGINT), 0 FROM lim
  UNION ALL
  SELECT CASE WHEN pos < t AND used = 40 THEN (lo + hi) // 2 + 1 ELSE lo END,
         CASE WHEN pos >= t THEN (lo + hi) // 2 ELSE hi END,
         CASE WHEN pos >= t OR used = 40 THEN CAST(0 AS BIGINT) ELSE (SELECT max(e) FROM ends WHERE e <= pos + (lo + hi) // 2) END,
         CASE WHEN pos >= t OR used = 40 THEN 0 ELSE used + 1 END
  FROM search, lim WHERE lo < hi
), best AS (
  SELECT min(hi) AS c FROM search WHERE lo = hi
), fill(pos, j) AS (
  SELECT CAST(0 AS BIGINT), 0
  UNION ALL
  SELECT (SELECT max(e) FROM ends WHERE e <= pos + (SELECT c FROM best)), j + 1 FROM fill, lim WHERE pos < t
), placed AS (
  SELECT b.doc_id, b.size, e.e, (SELECT count(*) FROM fill WHERE j > 0 AND pos < e.e) AS shard
  FROM base b JOIN ends e USING (k)
)
SELECT doc_id, CAST(size AS BIGINT) AS size, 'bytes' AS law, CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY e, doc_id NULLS LAST) - 1 AS slot
FROM placed
"""
