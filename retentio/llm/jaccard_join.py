"""N-gram Jaccard join with set-relation skipping.

A document's set holds the 64-bit hashes of its distinct shingles. Equal sets
become one. Every set is put in one global order, rare shingles first, and its
prefix goes to an inverted index: two similar sets share a prefix shingle.

Index level: a shingle's list is kept in order of set size. From a set, the
blocks of the list that size or position rule out are skipped.

Answer level: in each list the sets of similar size are first compared with one
leader only, then those outside the list's largest component with one of its
sets. What is linked that way forms components, and pairs within a component
need no answer of their own. Between two components that may still be similar,
each set of the smaller one meets the larger one's sets in blocks. A block keeps
one set whole and the others as their differences from it: the overlap with the
first is computed, those with the others are derived from it.

Before any comparison the candidates' odd sketches meet, a bit for each shingle:
where two sketches differ, so do the sets, which rules out most candidates that
only share a frequent shingle and never one that is similar. Sets travel only if
their sketches let them be similar. The global order comes from a table of
``BUCKETS`` counters, whose size does not depend on the data; any order gives the
same links.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bitmap_of, discard, free_shuffles, ship, stored
from .components import components

WORDS = 5
THRESHOLD = 80
BUCKETS = 1 << 18
#: Leaders of a part of a list.
LEADERS = 1
#: Sets of a component that are compared with a probe in one task.
BLOCK = 500
LEADS = tuple(f"lead{k}" for k in range(1, LEADERS + 1))
#: A longer list is joined in salted parts instead of inside one task.
LONG = 50_000
_MUL = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))


def shingles(text: str | None, n: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-word shingles; of all words, if fewer."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, dtype=np.int64)
    h = np.array(list(map(xxhash.xxh3_64_intdigest, words)), dtype=np.uint64)
    size = min(n, len(h))
    total = np.full(len(h) - size + 1, size, dtype=np.uint64)
    for j in range(size):
        total = (total ^ h[j:len(h) - size + 1 + j]) * _MUL[0]
        total ^= total >> np.uint64(32)
    total *= _MUL[1]
    total ^= total >> np.uint64(29)
    total = np.sort(total.view(np.int64))
    return total[np.append(True, total[1:] != total[:-1])]


def _set_id(hashes: np.ndarray) -> int | None:
    if not len(hashes):
        return None
    x = xxhash.xxh3_64_intdigest(hashes.tobytes())
    return x - (x >> 63 << 64)


def _sketch(hashes: np.ndarray) -> bytes | None:
    """Odd sketch: each bit is the parity of the hashes with these low bits. The bits in which
    two sketches differ are at most as many as the elements in which the sets do; a sketch is
    folded to half its width by the exclusive or of its halves."""
    if not len(hashes):
        return None
    bits = max(64, 1 << (len(hashes) - 1).bit_length())
    return np.packbits(np.bincount(hashes & (bits - 1), minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


def _describe(n, buckets):
    """A row per document, and at the end of the task one with its shingle counters."""
    def rows(batches):
        counts, ids = np.zeros(buckets, dtype=np.int64), None
        for batch in batches:
            ids, keys = batch.column(0), batch.column(2)
            sets = [shingles(t, n) for t in batch.column(1).to_pylist()]
            if any(map(len, sets)):
                counts += np.bincount(np.concatenate(sets) & (buckets - 1), minlength=buckets)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(list(map(len, sets)), pa.int64()), pa.array(list(map(_set_id, sets)), pa.int64()), keys, pa.array(list(map(_sketch, sets)), pa.binary()),
                 pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.int64())],
                names=["doc_id", "n", "set", "key", "sketch", "bucket", "count"])
        at = np.flatnonzero(counts)
        if len(at):
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(at), ids.type), pa.nulls(len(at), pa.int64()), pa.nulls(len(at), pa.int64()), pa.nulls(len(at), pa.int64()), pa.nulls(len(at), pa.binary()),
                 pa.array(at.astype(np.int32)), pa.array(counts[at])],
                names=["doc_id", "n", "set", "key", "sketch", "bucket", "count"])
    return rows


def _prefixes(shared, n, buckets, threshold):
    """(token, set, size, pos) for the prefix of every set, once a task."""
    def rows(batches):
        counts = np.frombuffer(shared.value, dtype=np.int64)
        seen: set[int] = set()
        keys: set[int] = set()
        held, held_rows = [], 0

        def out():
            cols = [np.concatenate(c) for c in zip(*held)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["token", "set", "size", "pos"])

        for batch in batches:
            for text, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key in keys:
                    continue
                keys.add(key)
                hashes = shingles(text, n)
                own = _set_id(hashes)
                if own is None or own in seen:
                    continue
                seen.add(own)
                size = len(hashes)
                length = size - (threshold * size + 99) // 100 + 1
                first = np.argsort(counts[hashes & (buckets - 1)], kind="stable")[:length]  # hashes are sorted
                held.append((hashes[first], np.full(length, own, dtype=np.int64), np.full(length, size, dtype=np.int32), np.arange(length, dtype=np.int32)))
                held_rows += length
                if held_rows > 300_000:
                    yield out()
                    held, held_rows = [], 0
        if held:
            yield out()
    return rows


def _cannot(size_a, pos_a, size_b, pos_b, threshold):
    """True if sets that share their first token at these positions cannot be similar."""
    most = np.minimum(size_a - pos_a, size_b - pos_b).astype(np.int64)
    return (100 + threshold) * most < threshold * (size_a.astype(np.int64) + size_b)


def _priority(sets: np.ndarray, k: int) -> np.ndarray:
    """The k-th pseudo-random order of sets, the same in every list."""
    z = (sets.view(np.uint64) ^ np.uint64(k)) * _MUL[k % len(_MUL)]
    z ^= z >> np.uint64(32)
    return z * _MUL[(k + 1) % len(_MUL)]


def _lists(threshold, long):
    """Lists with two sets at least, each row with the leaders it is compared with.

    Rows come by token and size. A list is cut where sizes differ too much to be
    similar; each part has LEADERS leaders, the first sets of as many pseudo-random
    orders. A list may be any length: beyond ``long`` rows it is passed on in
    pieces, and only a leader goes from one piece to the next. A list of two sets
    is marked as done: its leader answers for it.
    """
    names = ["token", "set", "size", "pos"]

    def run(cols, carry, whole=True):
        if carry is not None:  # a leader of the list that goes on
            cols = [np.concatenate(([c], x)) for c, x in zip(carry, cols)]
        token, own = cols[:2]
        same = np.zeros(len(token), dtype=bool)
        same[1:] = (token[1:] == token[:-1]) & (own[1:] == own[:-1])
        token, own, size, pos = (x[~same] for x in cols)
        index = np.arange(len(token))
        start = np.ones(len(token), dtype=bool)
        start[1:] = token[1:] != token[:-1]
        run_of = np.cumsum(start) - 1
        length = np.bincount(run_of)[run_of]
        keep = length > 1
        while True:  # cut the lists where the largest size is too far from the smallest
            head = np.maximum.accumulate(np.where(start, index, 0))
            over = threshold * size.astype(np.int64) > 100 * size[head].astype(np.int64)
            if not over.any():
                break
            begins = over.copy()
            begins[1:] &= ~over[:-1] | (head[1:] != head[:-1])
            start |= begins
        heads = np.flatnonzero(start)
        part = np.cumsum(start) - 1
        leads, taken = [], []
        for k in range(1, LEADERS + 1):
            order = np.lexsort((_priority(own, k), part))
            lead = order[heads][part]
            no = (lead == index) | _cannot(size[lead], pos[lead], size, pos, threshold)
            for before in taken:
                no |= lead == before
            taken.append(lead)
            leads.append(pa.array(own[lead][keep], mask=no[keep]))
        done = pa.array((length[keep] == 2) & whole)
        out = pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (token, own, size, pos)] + leads + [done], names=[*names, *LEADS, "done"])
        return out, tuple(x[taken[0][-1]] for x in (token, own, size, pos))

    def rows(batches):
        held, carry = None, None
        for batch in batches:
            cols = [batch.column(c).to_numpy() for c in names]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols)]
            if not len(cols[0]):
                continue
            other = np.flatnonzero(cols[0] != cols[0][-1])
            cut = int(other[-1]) + 1 if len(other) else 0
            whole = len(cols[0]) - cut <= long
            cut = cut if whole else len(cols[0])
            if cut:
                goes_on = carry is not None and carry[0] == cols[0][0]
                out, last = run([x[:cut] for x in cols], carry if goes_on else None, whole and not goes_on)
                carry = None if whole else last
                yield out
            held = [x[cut:] for x in cols] if cut < len(cols[0]) else None
        if held is not None:
            goes_on = carry is not None and carry[0] == held[0][0]
            yield run(held, carry if goes_on else None, not goes_on)[0]
    return rows


def _by_list(of_lists):
    """Whole lists, sorted by token and size, handed on some batches at a time."""
    names = ["token", "set", "size", "pos", "component"]

    def rows(batches):
        held = None
        for batch in batches:
            cols = [batch.column(c).to_numpy() for c in names]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols)]
            if not len(cols[0]):
                continue
            other = np.flatnonzero(cols[0] != cols[0][-1])
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield from of_lists([x[:cut] for x in cols])
            held = [x[cut:] for x in cols]
        if held is not None:
            yield from of_lists(held)
    return rows


def _blocks(size, threshold, i):
    """The part of a list, sorted by size, whose sizes fit the i-th; the rest is skipped."""
    return slice(np.searchsorted(100 * size, threshold * size[i]), np.searchsorted(threshold * size, 100 * size[i], side="right"))


def _partners(size, pos, comp, threshold):
    """For the sets of a list outside its largest component: each one, the sets that it may
    be similar to in other components, and which of them are in the largest."""
    _, which, counts = np.unique(comp, return_inverse=True, return_counts=True)
    largest = which == counts.argmax()
    order = np.cumsum(~largest)
    for i in np.flatnonzero(~largest):
        block = _blocks(size, threshold, i)
        ok = (comp[block] != comp[i]) & (largest[block] | (order[block] > order[i])) & ~_cannot(size[i], pos[i], size[block], pos[block], threshold)
        j = np.flatnonzero(ok) + block.start
        if len(j):
            yield i, j, largest[j]


def _mixed(cols, threshold):
    """(sets, components, partners) of the lists of several components."""
    token, own, size, pos, comp = cols
    size = size.astype(np.int64)
    edges = np.append(np.flatnonzero(np.diff(token, prepend=token[0] - 1)), len(token))
    mixed = np.minimum.reduceat(comp, edges[:-1]) != np.maximum.reduceat(comp, edges[:-1])
    for k in np.flatnonzero(mixed):
        at = slice(edges[k], edges[k + 1])
        yield own[at], comp[at], _partners(size[at], pos[at], comp[at], threshold)


def _pairs_of(a, b):
    both = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], axis=1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], names=["a", "b"])


def _attach(threshold):
    """A partner in the list's largest component for each set outside it, and (set, set) for
    all that may have a partner: at most two rows for each row of a list."""
    def of_lists(cols):
        a, b = [], []
        for own, _, partners in _mixed(cols, threshold):
            met, other = np.zeros(len(own), dtype=bool), np.full(len(own), -1)
            for i, j, large in partners:
                met[i] = True
                met[j] = True
                inner = j[large]
                if len(inner):
                    other[i] = inner[int(own[i]) % len(inner)]
            i = np.flatnonzero(other >= 0)
            one, two = own[i], own[other[i]]
            a += [own[met], np.minimum(one, two)]
            b += [own[met], np.maximum(one, two)]
        if a:
            yield _pairs_of(a, b)
    return _by_list(of_lists)


def _between(threshold, held_pairs=1_000_000):
    """Pairs of components with sets that may be similar, handed on in pieces."""
    def of_lists(cols):
        a, b, held = [], [], 0
        for _, comp, partners in _mixed(cols, threshold):
            for i, j, _ in partners:
                other = np.unique(comp[j])
                a.append(np.minimum(comp[i], other))
                b.append(np.maximum(comp[i], other))
                held += len(other)
                if held > held_pairs:
                    yield _pairs_of(a, b)
                    a, b, held = [], [], 0
        if a:
            yield _pairs_of(a, b)
    return _by_list(of_lists)


def _long_pairs(lists: DataFrame, threshold: int, salts: int = 16) -> DataFrame:
    """(a, b, component_a, component_b) of long lists: a join in salted parts, with the filters in the join."""
    a = lists.select("token", F.pmod("set", F.lit(salts)).alias("salt"), *[F.col(c).alias(f"a_{c}") for c in ("set", "size", "pos", "component")])
    b = lists.select("token", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<long>")).alias("salt"),
                     *[F.col(c).alias(f"b_{c}") for c in ("set", "size", "pos", "component")])
    most = F.least(F.col("a_size") - F.col("a_pos"), F.col("b_size") - F.col("b_pos"))
    fits = ((F.col("a_component") < F.col("b_component"))
            & ((100 + threshold) * most >= threshold * (F.col("a_size") + F.col("b_size"))))
    return a.join(b, ["token", "salt"]).where(fits).select(
        F.col("a_set").alias("a"), F.col("b_set").alias("b"), F.col("a_component").alias("component_a"), F.col("b_component").alias("component_b")).distinct()


def _sets_of(docs: DataFrame, sketches: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(set, size, hashes) of the sets in ``wanted`` (column set), each from one of its texts.

    Only texts whose key has its bit in a bitmap of the wanted keys are cut into shingles."""
    keys = sketches.join(wanted, "set", "left_semi").select("key")
    bits, bitmap = bitmap_of(keys, "key")
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def rows(batches):
        words, seen = np.frombuffer(shared.value, dtype=np.uint64), set()
        for batch in batches:
            low = batch.column(1).to_numpy() & (bits - 1)
            at = np.flatnonzero(words[low >> 6] >> (low & 63).astype(np.uint64) & np.uint64(1))
            ids, sets = [], []
            for text, key in zip(batch.column(0).take(pa.array(at)).to_pylist(), batch.column(1).to_numpy()[at].tolist()):
                if key in seen:
                    continue
                seen.add(key)
                hashes = shingles(text, n)
                own = _set_id(hashes)
                if own is not None:
                    ids.append(own)
                    sets.append(hashes)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["set", "hashes"])

    found = docs.select("text", "key").mapInArrow(rows, "set long, hashes array<long>").join(wanted, "set", "left_semi")
    return stored(found.groupBy("set").agg(F.first("hashes").alias("hashes")).withColumn("size", F.size("hashes").cast("long")), "jaccard-sets")


def _with_more(sets: DataFrame, docs: DataFrame, sketches: DataFrame, work: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """``sets`` with those of ``work`` that are not among them, and the frame of these alone."""
    missing = work.select("set").distinct().join(sets.select("set"), "set", "left_anti")
    more = _sets_of(docs, sketches, stored(missing, "jaccard-missing"), n)
    return sets.union(more), more


class _Block:
    """Some sets, kept as a pivot and what each of them has more or less than it.

    A set's overlap with all of them is its overlap with the pivot, corrected by
    the differences that it holds.
    """

    def __init__(self, sets: list[np.ndarray]):
        self.pivot, self.sizes = sets[0], np.array([len(x) for x in sets])
        tokens, owners, signs = [], [], []
        for k, x in enumerate(sets):
            for part, sign in ((np.setdiff1d(x, self.pivot, assume_unique=True), 1), (np.setdiff1d(self.pivot, x, assume_unique=True), -1)):
                tokens.append(part)
                owners.append(np.full(len(part), k))
                signs.append(np.full(len(part), sign))
        tokens, owners, signs = map(np.concatenate, (tokens, owners, signs))
        order = np.argsort(tokens, kind="stable")
        self.tokens, self.owners, self.signs = tokens[order], owners[order], signs[order]

    def overlaps(self, x: np.ndarray) -> np.ndarray:
        base = len(np.intersect1d(x, self.pivot, assume_unique=True))
        if not len(self.tokens):
            return np.full(len(self.sizes), base)
        held = x[np.minimum(np.searchsorted(x, self.tokens), len(x) - 1)] == self.tokens
        return base + np.bincount(self.owners[held], weights=self.signs[held], minlength=len(self.sizes)).astype(np.int64)


def _compare(batches):
    """For each probe of a block its most similar set there. Rows come by key, the block's sets before the probes."""
    key, ids, sets, block = None, [], [], None
    for batch in batches:
        hashes = batch.column("hashes")
        flat, ends = hashes.flatten().to_numpy(), np.cumsum([0, *np.diff(hashes.offsets.to_numpy())])
        out = []
        for k, probe, own, i in zip(batch.column("key").to_pylist(), batch.column("probe").to_pylist(), batch.column("set").to_pylist(), range(batch.num_rows)):
            x = flat[ends[i]:ends[i + 1]]
            if k != key:
                key, ids, sets, block = k, [], [], None
            if not probe:
                ids.append(own)
                sets.append(x.copy())
                continue
            if not sets:
                continue
            block = block or _Block(sets)
            overlap = block.overlaps(x)
            best = int((overlap / (block.sizes + len(x) - overlap)).argmax())
            out.append((ids[best], own, int(block.sizes[best]), len(x), int(overlap[best])))
        cols = np.array(out, dtype=np.int64).reshape(-1, 5)
        yield pa.RecordBatch.from_arrays([pa.array(cols[:, c].copy()) for c in range(5)], names=["a", "b", "size_a", "size_b", "overlap"])


def _fold(words: np.ndarray, width: int) -> np.ndarray:
    """Sketches (in the last axis) as they would be with ``width`` words."""
    while words.shape[-1] > width:
        half = words.shape[-1] // 2
        words = words[..., :half] ^ words[..., half:]
    return words


class _Sketches:
    """A block's sketches by width, and which of its sets some probe may be similar to."""

    def __init__(self, members: list[tuple[int, int, bytes]], threshold: int):
        self.threshold, self.groups = threshold, []
        for width in {len(x) for _, _, x in members}:
            group = [m for m in members if len(m[2]) == width]
            words = np.frombuffer(b"".join(x for _, _, x in group), dtype=np.uint64).reshape(len(group), -1)
            self.groups.append(([own for own, _, _ in group], np.array([size for _, size, _ in group]), {words.shape[1]: words}, np.zeros(len(group), dtype=bool)))

    def meets(self, size: int, sketch: bytes) -> bool:
        probe, met = np.frombuffer(sketch, dtype=np.uint64), False
        for _, sizes, by_width, used in self.groups:
            width = min(len(probe), max(by_width))
            if width not in by_width:
                by_width[width] = _fold(by_width[max(by_width)], width)
            apart = np.bitwise_count(by_width[width] ^ _fold(probe, width)).sum(axis=1, dtype=np.int64)
            both = sizes + size  # twice the overlap is at most both - apart
            fits = (100 + self.threshold) * (both - apart) >= 2 * self.threshold * both
            if fits.any():
                used |= fits
                met = True
        return met

    def used(self) -> list[int]:
        return [own for owns, _, _, used in self.groups for own, u in zip(owns, used) if u]


def _may_be_similar(threshold):
    """The rows of work whose sketches leave it open that they are similar: probes, and sets of
    their block. Rows come by key, the block's sets before the probes."""
    def batch_of(rows):
        key, probe, own = zip(*rows) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(probe, pa.bool_()), pa.array(own, pa.int64())], names=["key", "probe", "set"])

    def rows(batches):
        key, members, block = None, [], None
        for batch in batches:
            out = []
            for k, probe, own, size, sketch in zip(*(batch.column(c).to_pylist() for c in ("key", "probe", "set", "size", "sketch"))):
                if k != key:
                    if block:
                        out += [(key, False, x) for x in block.used()]
                    key, members, block = k, [], None
                if not probe:
                    members.append((own, size, sketch))
                elif members:
                    block = block or _Sketches(members, threshold)
                    if block.meets(size, sketch):
                        out.append((k, True, own))
            yield batch_of(out)
        if block:
            yield batch_of([(key, False, x) for x in block.used()])
    return rows


def _possible(work: DataFrame, sketches: DataFrame, threshold: int) -> DataFrame:
    """``work`` (key, probe, set) without what the sketches rule out, stored."""
    rows = work.join(sketches.select("set", "size", "sketch"), "set").repartition("key").sortWithinPartitions("key", "probe")
    return stored(rows.select("key", "probe", "set", "size", "sketch").mapInArrow(_may_be_similar(threshold), "key long, probe boolean, set long"), "jaccard-possible")


def _answers(work: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, size_a, size_b, overlap) of ``work`` (key, probe, set): a is the set of the
    block that the probe b is most similar to."""
    rows = work.join(sets.select("set", "hashes"), "set").repartition("key").sortWithinPartitions("key", "probe")
    return rows.select("key", "probe", "set", "hashes").mapInArrow(_compare, "a long, b long, size_a long, size_b long, overlap long")


def _one_by_one(pairs: DataFrame) -> DataFrame:
    """Work for single pairs: each a is a block of its own, dealt again where it has many partners."""
    salt = F.pmod("b", F.lit(64))
    keyed = pairs.select(F.xxhash64("a", salt).alias("key"), "a", "b")
    return (keyed.select("key", F.lit(False).alias("probe"), F.col("a").alias("set")).distinct()
            .union(keyed.select("key", F.lit(True), "b")))


def _similar(overlap, sizes, threshold):
    """overlap / union >= threshold / 100, for the sum of both sizes."""
    return (100 + threshold) * overlap >= threshold * sizes


def link_sets(docs: DataFrame, n: int = WORDS, threshold: int = THRESHOLD, long: int = LONG) -> tuple[DataFrame, DataFrame]:
    """(documents: doc_id, n, set; components: node, component) of the similarity join."""
    spark = ship(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("key"))
    described = stored(docs.mapInArrow(_describe(n, BUCKETS), f"doc_id {id_type}, n long, set long, key long, sketch binary, bucket int, count long"), "jaccard-documents")
    documents = described.where("bucket is null").select("doc_id", "n", "set", "key")
    counts = np.zeros(BUCKETS, dtype=np.int64)
    table = described.where("bucket is not null").groupBy("bucket").agg(F.sum("count").alias("count")).toArrow()  # BUCKETS rows at most
    counts[table.column("bucket").to_numpy()] = table.column("count").to_numpy()

    row = "token long, set long, size int, pos int"
    prefixes = docs.select("text", "key").mapInArrow(_prefixes(spark.sparkContext.broadcast(counts.tobytes()), n, BUCKETS, threshold), row)
    lists = stored(prefixes.repartition("token").sortWithinPartitions("token", "size", "set")
                   .mapInArrow(_lists(threshold, long), row + "".join(f", {c} long" for c in LEADS) + ", done boolean"), "jaccard-lists")
    of_sets = described.where("set is not null").groupBy("set").agg(F.min("key").alias("key"), F.min("n").alias("size"), F.min("sketch").alias("sketch"))
    sketches = stored(of_sets, "jaccard-sketches")

    free_shuffles(spark)

    # first answers: every set against its leaders
    leads = lists.select(F.explode(F.array_compact(F.array(*LEADS))).alias("a"), F.col("set").alias("b"))
    first = stored(leads.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "jaccard-leaders")
    work = _possible(_one_by_one(first), sketches, threshold)
    sets = _sets_of(docs, sketches, stored(work.select("set").distinct(), "jaccard-nodes"), n)
    free_shuffles(spark)
    links = stored(_linked(_answers(work, sets), threshold), "jaccard-links")
    open_lists = _open_lists(lists.where("not done"), components(links), long)
    discard(lists)
    free_shuffles(spark)

    # sets that are still outside the largest component of a list: one partner there
    across = stored(_long_pairs(open_lists.where("long"), threshold), "jaccard-across")
    tried = stored(_in_tasks(open_lists, _attach(threshold), "a long, b long").distinct(), "jaccard-tried")
    touched = tried.where("a = b").select(F.col("a").alias("set"))
    touched = stored(touched.union(across.select("a")).union(across.select("b")).distinct(), "jaccard-touched")
    work = _possible(_one_by_one(tried.where("a < b").join(first, ["a", "b"], "left_anti")), sketches, threshold)
    held = [sets]
    sets, others = _with_more(sets, docs, sketches, work, n)
    held.append(others)
    free_shuffles(spark)
    more = stored(_linked(_answers(work, sets), threshold), "jaccard-links")
    links = links.union(more)
    joined = components(links)
    before, open_lists = open_lists, _open_lists(open_lists.drop("component", "long"), joined, long)
    discard(before)
    free_shuffles(spark)

    # components that may still be similar: the smaller one's sets against blocks of the larger one's
    pairs = _in_tasks(open_lists, _between(threshold), "a long, b long")
    across = _long_pairs(open_lists.where("long"), threshold)
    pairs = stored(pairs.union(across.select("component_a", "component_b")).distinct(), "jaccard-pairs")
    members = touched.join(joined.withColumnRenamed("node", "set"), "set", "left").select("set", F.coalesce("component", "set").alias("component"))
    members = stored(members, "jaccard-members")
    counted = stored(members.groupBy("component").agg(F.count("*").alias("n")), "jaccard-sizes")
    of = lambda c: counted.select(F.col("component").alias(c), F.col("n").alias(f"n_{c}"))
    sized = pairs.join(of("a"), "a").join(of("b"), "b")
    larger = F.when(F.col("n_a") >= F.col("n_b"), F.struct(F.col("a").alias("large"), F.col("b").alias("little"), F.col("n_a").alias("n"))).otherwise(
        F.struct(F.col("b").alias("large"), F.col("a").alias("little"), F.col("n_b").alias("n")))
    sized = stored(sized.select(larger.alias("p")).select("p.*", F.ceil(F.col("p.n") / BLOCK).alias("blocks")), "jaccard-sized")
    inside = members.join(sized.select(F.col("large").alias("component"), "blocks").distinct(), "component")
    inside = inside.select(F.xxhash64("component", F.pmod("set", "blocks")).alias("key"), F.lit(False).alias("probe"), "set")
    probes = members.join(sized.select("large", F.col("little").alias("component"), "blocks"), "component")
    probes = probes.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    probes = probes.select(F.xxhash64("large", "block").alias("key"), F.lit(True).alias("probe"), "set").distinct()
    work = _possible(inside.union(probes), sketches, threshold)
    sets, others = _with_more(sets, docs, sketches, work, n)
    held.append(others)
    free_shuffles(spark)
    last = stored(_linked(_answers(work, sets), threshold), "jaccard-links")
    for done in (open_lists, sketches, *held):
        discard(done)
    free_shuffles(spark)
    return documents, components(links.union(last))


def _linked(answers: DataFrame, threshold: int) -> DataFrame:
    return answers.where(_similar(F.col("overlap"), F.col("size_a") + F.col("size_b"), threshold)).select("a", "b")


def _only_open(long):
    """The rows of lists with several components. Rows of a list beyond ``long`` rows are all
    passed on, in pieces, and marked."""
    names = ["token", "set", "size", "pos", "component"]

    def batch_of(cols, is_long):
        return pa.RecordBatch.from_arrays([*map(pa.array, cols), pa.array(is_long)], names=[*names, "long"])

    def whole(cols):
        starts = np.flatnonzero(np.diff(cols[0], prepend=cols[0][0] - 1))
        mixed = np.minimum.reduceat(cols[4], starts) != np.maximum.reduceat(cols[4], starts)
        length = np.diff(np.append(starts, len(cols[0])))
        at = np.repeat(mixed, length)
        return batch_of([x[at] for x in cols], np.repeat(length > long, length)[at])

    def rows(batches):
        held, passed = None, None  # rows of the last list; its token once a piece of it went on
        for batch in batches:
            cols = [batch.column(c).to_numpy() for c in names]
            if passed is not None and len(cols[0]):
                more = np.searchsorted(cols[0] != passed, True)
                if more:
                    yield batch_of([x[:more] for x in cols], np.ones(more, dtype=bool))
                cols = [x[more:] for x in cols]
                if len(cols[0]):
                    passed = None
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols)]
            if not len(cols[0]):
                continue
            other = np.flatnonzero(cols[0] != cols[0][-1])
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield whole([x[:cut] for x in cols])
            held = [x[cut:] for x in cols]
            if len(held[0]) > long:
                yield batch_of(held, np.ones(len(held[0]), dtype=bool))
                held, passed = None, held[0][0]
        if held is not None:
            yield whole(held)
    return rows


def _open_lists(lists: DataFrame, labels: DataFrame, long: int) -> DataFrame:
    """The lists of several components, with each set's component (a set without links is its
    own) and whether the list is too long for a task. Components only grow, so other lists
    need no look again."""
    marked = lists.join(labels.withColumnRenamed("node", "set"), "set", "left").withColumn("component", F.coalesce("component", "set"))
    marked = marked.select("token", "set", "size", "pos", "component").repartition("token").sortWithinPartitions("token", "size", "set")
    return stored(marked.mapInArrow(_only_open(long), "token long, set long, size int, pos int, component long, long boolean"), "jaccard-open")


def _in_tasks(lists: DataFrame, work, schema: str) -> DataFrame:
    """``work`` over the lists that fit in a task, each whole."""
    short = lists.where("not long").drop("long").repartition("token").sortWithinPartitions("token", "size", "set")
    return short.mapInArrow(work, schema)


def jaccard_components(docs: DataFrame, n: int = WORDS, threshold: int = THRESHOLD, long: int = LONG) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    A null or empty text, or one without words, has an empty set and is linked
    with nothing, so its component is its own doc_id. Equal sets are linked.
    Rows are linked one by one: a doc_id may occur twice, and a null doc_id is
    never the smallest. An empty table gives an empty result. Other columns are
    ignored.
    """
    documents, links = link_sets(docs, n, threshold, long)
    by_set = documents.where("set is not null").groupBy("set").agg(F.min("doc_id").alias("least"))
    by_set = by_set.join(links.withColumnRenamed("node", "set"), "set", "left").withColumn("component", F.coalesce("component", "set"))
    by_set = stored(by_set, "jaccard-by-set")
    least = by_set.groupBy("component").agg(F.min("least").alias("component_id"))
    of_set = by_set.join(least, "component").select("set", "component_id")
    return (documents.where("set is not null").join(of_set, "set")
            .select("doc_id", F.col("n").alias("n_shingles"), "component_id")
            .union(documents.where("set is null").select("doc_id", "n", "doc_id")))


def op3_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
