"""Suffix-array dedup: a logarithmic family of sparse suffix arrays.

A byte is removed if it lies in a string of ``LENGTH`` bytes that also starts
elsewhere. Suffixes are taken at anchors chosen by content: of the K-byte
strings inside each window of LENGTH bytes, the one with the smallest hash
(leftmost if equal). Equal windows have the same anchor at the same place, so
each repeat shows as two suffixes with equal first K bytes.

1. Batches of documents arrive one after another. A batch gets its suffix array
   (anchors sorted by the hash of their first K bytes) and is merge-scanned
   against the levels that exist. Levels of equal rank are merged into one of
   the next rank, so there are at most log2(batches) + 1 levels.
2. The scans give the keys that occur twice. A bitmap of fixed size lets most
   texts without any of them go straight to the result; a key let through by
   chance drops out when its runs meet.
3. An anchor owns a run of windows. Where the bytes under such a run (its
   context) occur twice, all of them are repeats. The other contexts of a key
   are compared window by window: within a task for keys with few occurrences,
   by an aggregation over window hashes for hot keys.

Hashes of K-byte strings, contexts and windows have 64 bits.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bitmap_of, discard, free_shuffles, n_partitions, ship, stored

LENGTH = 200
K = 40
BATCHES = 4
#: The contexts of a key with more occurrences are compared by aggregation instead of in one task.
HOT = 5_000
_POS_BITS = 21
_BYTE = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MUL = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


def _join(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    z = left * _MUL[0]
    z += right
    z ^= z >> np.uint64(29)
    z *= _MUL[1]
    return z


def window_hashes(data: np.ndarray, *lengths: int) -> list[np.ndarray]:
    """64-bit hashes of all substrings of each of the ``lengths``, by start."""
    wanted, size, h = 0, 1, _BYTE[data]
    for length in lengths:
        wanted |= length
    powers = {1: h} if wanted & 1 else {}
    while 2 * size <= max(lengths):
        h = _join(h[:-size], h[size:]) if len(h) > size else h[:0]
        size *= 2
        if wanted & size:
            powers[size] = h
    out = []
    for length in lengths:
        total, at = None, 0
        n = max(0, len(data) - length + 1)
        for p in sorted(powers, reverse=True):
            if length & p:
                part = powers[p][at:at + n]
                total = part if total is None else _join(total, part)
                at += p
        out.append(total)
    return out


def anchor_runs(data: np.ndarray, length: int = LENGTH, k: int = K):
    """(first window, last window, anchor, key) of each run of windows with one anchor."""
    n = len(data) - length + 1
    segment = (1 << _POS_BITS) - length
    for at in range(0, max(0, n), segment):
        part = data[at:at + segment + length - 1]
        keys, = window_hashes(part, k)
        mask = np.uint64((1 << _POS_BITS) - 1)
        least = (keys & ~mask) | np.arange(len(keys), dtype=np.uint64)
        width, size = length - k + 1, 1
        while 2 * size <= width:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < width:
            least = np.minimum(least[:size - width], least[width - size:])
        anchor = (least & mask).astype(np.int64)
        first = np.flatnonzero(np.diff(anchor, prepend=-1))
        last = np.append(first[1:], len(anchor)) - 1
        yield first + at, last + at, anchor[first] + at, keys[anchor[first]].view(np.int64)


class SuffixFamily:
    """Levels of sorted anchor keys; rank r holds 2**r batches.

    A batch meets a level of its own rank in a merge, which is a scan of both, and
    the other levels in a merge-scan. A key that two levels share without being
    merged is kept in ``crossing`` with its count there.
    """

    def __init__(self):
        self.levels: list[tuple[int, DataFrame]] = []
        self.crossing: list[DataFrame] = []

    def add(self, batch: DataFrame) -> None:
        """Take in a batch (columns key, n)."""
        new, rank = stored(_level(batch), "suffix-level"), 0
        while self.levels and self.levels[-1][0] == rank:
            _, old = self.levels.pop()
            merged = stored(_level(old.union(new)), "suffix-level")
            discard(old)
            discard(new)
            new, rank = merged, rank + 1
        for _, level in self.levels:
            both = new.join(level.select("key", F.col("n").alias("m")), "key").select("key", (F.col("n") + F.col("m")).alias("n"))
            self.crossing.append(stored(both, "suffix-crossing"))
        self.levels.append((rank, new))

    def repeated(self, over: int = 1) -> DataFrame:
        """The keys that occur more than ``over`` times in a level, or in two together."""
        found = [df.where(F.col("n") > over).select("key") for df in [level for _, level in self.levels] + self.crossing]
        out = found[0]
        for f in found[1:]:
            out = out.union(f)
        return out.distinct() if len(found) > 1 else out

    def close(self) -> None:
        for df in [level for _, level in self.levels] + self.crossing:
            discard(df)


def _level(rows: DataFrame) -> DataFrame:
    return rows.groupBy("key").agg(F.sum("n").alias("n")).sortWithinPartitions("key")


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode(), dtype=np.uint8)


def _anchor_keys(length, k):
    def rows(batches):
        for batch in batches:
            keys, parts = [], []
            for part, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for *_, key in anchor_runs(_bytes(text), length, k):
                    keys.append(key)
                    parts.append(np.full(len(key), part, dtype=np.int32))
            if keys:
                pairs = np.unique(np.rec.fromarrays([np.concatenate(parts), np.concatenate(keys)], names="p,k"), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs[0]["p"].copy()), pa.array(pairs[0]["k"].copy()), pa.array(pairs[1].astype(np.int64))],
                    names=["part", "key", "n"])
    return rows


def _marked(repeated, hot, bits, length, k):
    """Per document: its anchors whose key may repeat, and the text; or, if none, its result."""
    runs_type = pa.list_(pa.struct([("key", pa.int64()), ("context", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("hot", pa.bool_())]))

    def rows(batches):
        maps = [np.frombuffer(m.value, dtype=np.uint64) for m in (repeated, hot)]
        for batch in batches:
            texts = batch.column("text").to_pylist()
            sizes, digests, kept, runs = [], [], [], []
            for text in texts:
                raw = (text or "").encode()
                data, own = np.frombuffer(raw, dtype=np.uint8), []
                for first, last, anchor, key in anchor_runs(data, length, k):
                    bit = key.view(np.uint64) & np.uint64(bits - 1)
                    maybe, many = ((m[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) > 0 for m in maps)
                    for a, b, at, x, h in zip(*(v[maybe].tolist() for v in (first, last, anchor, key, many))):
                        context = xxhash.xxh3_64_intdigest(raw[a:b + length], seed=at - a)
                        own.append((x, context - (context >> 63 << 64), a, b, h))
                sizes.append(len(raw))
                digests.append(None if own else hashlib.sha256(raw).hexdigest())
                kept.append(text if own else None)
                runs.append(own or None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()),
                 pa.array(kept, pa.string()), pa.array(runs, runs_type)],
                names=["doc_id", "n_bytes", "digest", "text", "runs"])
    return rows


def _contexts(length):
    """The bytes under each run that has to be compared."""
    def rows(batches):
        for batch in batches:
            out = {c: [] for c in ("row", "key", "hot", "first", "bytes")}
            for row, text, checks in zip(*(batch.column(c).to_pylist() for c in ("row", "text", "checks"))):
                raw = text.encode()
                for run in checks:
                    out["row"].append(row)
                    out["bytes"].append(raw[run["first"]:run["last"] + length])
                    for c in ("key", "hot", "first"):
                        out[c].append(run[c])
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["row"], pa.int64()), pa.array(out["key"], pa.int64()), pa.array(out["hot"], pa.bool_()),
                 pa.array(out["first"], pa.int32()), pa.array(out["bytes"], pa.binary())], names=list(out))
    return rows


def _windows(raws: list[bytes], length: int):
    """(entry, offset, hash) of all windows of the byte strings."""
    sizes = np.array([len(r) for r in raws], dtype=np.int64)
    ends = np.cumsum(sizes)
    hashes, = window_hashes(np.frombuffer(b"".join(raws), dtype=np.uint8), length)
    counts = sizes - length + 1
    entry = np.repeat(np.arange(len(raws)), counts)
    offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return entry, offset, hashes[(ends - sizes)[entry] + offset].view(np.int64)


def _compare(length, chunk):
    """Runs of windows that occur twice; rows come sorted by key, whole keys at a time."""
    def spans(batch):
        entry, offset, hashes = _windows(batch.column("bytes").to_pylist(), length)
        _, which, counts = np.unique(hashes, return_inverse=True, return_counts=True)
        twice = counts[which] > 1
        at = np.flatnonzero(twice)
        fresh = np.ones(len(at), dtype=bool)
        fresh[1:] = (at[1:] != at[:-1] + 1) | (entry[at[1:]] != entry[at[:-1]])
        begin = at[fresh]
        end = at[np.append(np.flatnonzero(fresh)[1:], len(at)) - 1] if len(at) else at
        first = batch.column("first").to_numpy()[entry[begin]]
        rows = pa.array(entry[begin])
        return pa.RecordBatch.from_arrays(
            [batch.column("row").take(rows), pa.array((first + offset[begin]).astype(np.int32)), pa.array((first + offset[end]).astype(np.int32))],
            names=["row", "first", "last"])

    def rows(batches):
        held = None
        for batch in batches:
            batch = pa.Table.from_batches([batch])
            held = batch if held is None else pa.concat_tables([held, batch])
            if held.num_rows >= chunk:
                keys = held.column("key").to_numpy()
                cut = int(np.searchsorted(keys, keys[-1]))  # the last key may go on
                if cut:
                    yield spans(held.slice(0, cut).combine_chunks().to_batches()[0])
                    held = held.slice(cut)
        if held is not None and held.num_rows:
            yield spans(held.combine_chunks().to_batches()[0])
    return rows


def _window_rows(length):
    """One row per window, for hot keys."""
    def rows(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                entry, offset, hashes = _windows(part.column("bytes").to_pylist(), length)
                own = pa.array(entry)
                start = part.column("first").to_numpy()[entry] + offset
                yield pa.RecordBatch.from_arrays([part.column("row").take(own), pa.array(start.astype(np.int32)), pa.array(hashes)], names=["row", "first", "hash"])
    return rows


def _remove(length):
    """Cut the bytes under all runs out of the texts."""
    def rows(batches):
        for batch in batches:
            removed, spans, digests = [], [], []
            for text, *runs in zip(*(batch.column(c).to_pylist() for c in ("text", "whole", "part"))):
                data = _bytes(text)
                depth = np.zeros(len(data) + 1, dtype=np.int32)
                for own in runs:
                    for r in own or ():
                        depth[r["first"]] += 1
                        depth[r["last"] + length] -= 1
                gone = np.cumsum(depth[:-1]) > 0
                removed.append(int(gone.sum()))
                spans.append(int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()))
                digests.append(hashlib.sha256(data[~gone].tobytes()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests, pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    return rows


def _flag_runs(runs: DataFrame) -> DataFrame:
    """Runs whose context occurs twice (``whole``), and one run of each context
    whose key has others (``check``). Groups of cold keys are bounded and go
    through a window, hot ones through salted windows, aggregates and a join."""
    cold, hot = runs.where("not hot"), runs.where("hot")
    by_context = Window.partitionBy("key").orderBy("context", "row", "first")
    of_key = Window.partitionBy("key")
    as_before = F.coalesce(F.lag("context").over(by_context) == F.col("context"), F.lit(False))
    as_after = F.coalesce(F.lead("context").over(by_context) == F.col("context"), F.lit(False))
    several = F.min("context").over(of_key) != F.max("context").over(of_key)
    cold = cold.select("key", "row", "first", "last", "hot", (as_before | as_after).alias("whole"), (~as_before & several).alias("check"))
    # copies meet in salted groups first; only the first row of each goes on to be joined
    salted = Window.partitionBy("key", "context", "salt")
    hot = hot.withColumn("salt", F.pmod("row", F.lit(n_partitions(runs.sparkSession))))
    hot = hot.select("*", F.row_number().over(salted.orderBy("row", "first")).alias("rank"), F.count("*").over(salted).alias("copies"))
    hot = stored(hot, "suffix-hot")
    later = hot.where("rank > 1").select("key", "row", "first", "last", "hot", F.lit(True).alias("whole"), F.lit(False).alias("check"))
    heads = hot.where("rank = 1")
    contexts = heads.groupBy("key", "context").agg(F.sum("copies").alias("n"), F.min(F.struct("row", "first")).alias("one"))
    per_key = contexts.groupBy("key").agg(F.count("*").alias("n_contexts"))
    contexts = stored(contexts.join(per_key, "key"), "suffix-contexts")
    is_one = (F.col("row") == F.col("one.row")) & (F.col("first") == F.col("one.first"))
    heads = heads.join(contexts, ["key", "context"]).select(
        "key", "row", "first", "last", "hot", (F.col("n") > 1).alias("whole"), (is_one & (F.col("n_contexts") > 1)).alias("check"))
    hot = later.union(heads)
    return cold.union(hot).where("whole or check")


def dedup_substrings(docs: DataFrame, length: int = LENGTH, k: int = K, batches: int = BATCHES, hot_rows: int = HOT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A null text counts as empty; a text shorter than ``length`` keeps all its
    bytes. Equal rows repeat each other, so all of their long strings go. Rows
    are told apart by a number of their own, so a doc_id may be null or occur
    twice. An empty table gives an empty result. Other columns are ignored.
    Matches never cross documents.
    """
    spark = ship(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", "text")

    batch = F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches)).cast("int")
    keys = stored(docs.select(batch.alias("part"), "text").mapInArrow(_anchor_keys(length, k), "part int, key long, n long"), "suffix-keys")
    family = SuffixFamily()
    for part in range(batches):
        family.add(keys.where(F.col("part") == part).select("key", "n"))
    bits, repeated = bitmap_of(family.repeated(), "key")
    _, hot = bitmap_of(family.repeated(hot_rows), "key")
    family.close()
    discard(keys)
    free_shuffles(spark)

    send = spark.sparkContext.broadcast
    marked = docs.mapInArrow(_marked(send(repeated), send(hot), bits, length, k),
                             f"doc_id {id_type}, n_bytes long, digest string, text string, "
                             "runs array<struct<key:long,context:long,first:int,last:int,hot:boolean>>")
    marked = stored(marked.withColumn("row", F.monotonically_increasing_id()), "suffix-marked")
    flagged = stored(_flag_runs(marked.where("runs is not null").select("row", F.inline("runs"))), "suffix-flagged")
    free_shuffles(spark)
    whole = F.collect_list(F.when(F.col("whole"), F.struct("first", "last")))  # no more than the document has windows
    checks = F.collect_list(F.when(F.col("check"), F.struct("first", "last", "key", "hot")))
    per_row = stored(flagged.groupBy("row").agg(whole.alias("whole"), checks.alias("checks")), "suffix-rows")
    discard(flagged)
    free_shuffles(spark)

    texts = marked.where("runs is not null").select("row", "text")
    pieces = stored(per_row.where("size(checks) > 0").select("row", "checks").join(texts, "row")
                    .mapInArrow(_contexts(length), "row long, key long, hot boolean, first int, bytes binary"), "suffix-pieces")
    free_shuffles(spark)
    run = "row long, first int, last int"
    few = pieces.where("not hot").repartition("key").sortWithinPartitions("key").mapInArrow(_compare(length, hot_rows), run)
    window = stored(pieces.where("hot").mapInArrow(_window_rows(length), "row long, first int, hash long"), "suffix-windows")
    twice = window.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    lots = window.join(twice, "hash", "left_semi").select("row", "first", F.col("first").alias("last"))
    part = stored(few.union(lots).groupBy("row").agg(F.collect_list(F.struct("first", "last")).alias("part")), "suffix-parts")
    discard(pieces)
    discard(window)
    free_shuffles(spark)

    clean = marked.where("runs is null").select("doc_id", "n_bytes", F.lit(0).cast("long").alias("n_removed"),
                                                F.lit(0).cast("long").alias("n_spans"), F.col("digest").alias("kept_sha256"))
    gone = per_row.select("row", "whole").join(part, "row", "full")
    cut = (marked.where("runs is not null").select("row", "doc_id", "n_bytes", "text").join(gone, "row", "left")
           .select("doc_id", "n_bytes", "text", "whole", "part")
           .mapInArrow(_remove(length), f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"))
    return clean.union(cut)


def op7_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return dedup_substrings(spark.read.parquet(f"{sf_dir}/documents.parquet"))
