"""MinHash near-duplicates, with candidates checked by odd sketches.

A document's set holds the hashes of its distinct word shingles, and equal sets
become one. A set has ``SAMPLES`` MinHash values. The first ``BANDS * ROWS`` make
bands: sets that agree in a band are candidates. At a similarity of 0.8 two sets
share none of the bands with a probability of (1 - 0.8 ** 4) ** 40 < 1e-9.

All samples are folded into an odd sketch, a bitmap in which each sample flips one
bit. Where two sets have the same sample the flips cancel, so the population count of
the XOR of two sketches is at most twice the number of samples that differ, and
of the same parity: it tells high similarities apart with ``BITS`` bits a
set. ``most_bits`` is the count that similar sets exceed with a probability under
1e-10. Only candidates within it have their sets compared, exactly.

Candidates are not all pairs of a band. First a set is compared with one leader: of
the sets that lead its bands, the one that comes first in one order of all sets.
What is linked by then needs no more comparison. A band whose sets are still in
different components goes to a task, in parts of bounded size, and the task hands on
which components have alike sketches, as a forest and not as pairs. Components joined
that way are a cluster, and the sets of a cluster meet in blocks: all overlaps
of a block at once, exactly, and again only a forest of links is handed on. Two
blocks of one component are not compared. Nothing is capped.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bitmap_of, discard, ship, stored
from .components import components
from .jaccard_join import shingles

WORDS, THRESHOLD = 2, 80
ROWS, BANDS = 4, 40
SAMPLES = 256
BITS = 1024
LONGS = BITS // 64
#: Sets of a part of a band and of a block of a cluster; larger ones are dealt into several, and each two meet.
PART, BLOCK = 2000, 500
#: Shingles that are hashed at once, and sets or texts that a task remembers to save work.
_CHUNK, _SEEN = 256, 300_000
_MUL = np.uint64(0x9E3779B97F4A7C15)


def _mixed(z: np.ndarray) -> np.ndarray:
    z = (z ^ z >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ z >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return z ^ z >> np.uint64(31)


_KEYS = _mixed(np.arange(1, SAMPLES + 1, dtype=np.uint64) * _MUL).astype(np.uint32)
_ORDER = np.arange(SAMPLES, dtype=np.uint64)
_FIRST, _SECOND = np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35)
_SHIFTS = np.uint32(16), np.uint32(13)


def minhashes(hashes: np.ndarray) -> np.ndarray:
    """The smallest value of a set's hashes under each of ``SAMPLES`` hash functions.

    The functions are full mixes of the hash and a key: products alone are not
    independent enough, whole runs of samples would differ together.
    """
    least = None
    for at in range(0, len(hashes), _CHUNK):
        x = (hashes[at:at + _CHUNK].view(np.uint64) >> np.uint64(32)).astype(np.uint32)
        values = x[:, None] ^ _KEYS
        values *= _FIRST
        values ^= values >> _SHIFTS[1]
        values *= _SECOND
        values ^= values >> _SHIFTS[0]
        values = values.min(axis=0)
        least = values if least is None else np.minimum(least, values)
    return least.astype(np.uint64)


def band_keys(least: np.ndarray, rows: int = ROWS, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key per band, different for equal values in different bands."""
    key = np.arange(1, bands + 1, dtype=np.uint64) * _MUL
    for r in range(rows):
        key = _mixed(key ^ least[r:rows * bands:rows])
    return key.view(np.int64)


def odd_sketch(least: np.ndarray) -> np.ndarray:
    """Each sample flips one bit of ``LONGS`` 64-bit words."""
    bit = _mixed(least + _ORDER * _MUL) & np.uint64(BITS - 1)
    odd = np.bincount(bit.astype(np.int64), minlength=BITS).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").view(np.int64)


def similarity(bits: int, samples: int = SAMPLES, size: int = BITS) -> float:
    """Estimated Jaccard similarity of two sets from the population count of the XOR of their sketches."""
    return 1 + size / (4 * samples) * math.log(max(1 - 2 * bits / size, 1e-9))


def most_bits(threshold: int, samples: int = SAMPLES, risk: float = 1e-10) -> int:
    """The population count that sets of this similarity exceed with at most ``risk``:
    twice the number of differing samples that a binomial exceeds with it."""
    p, tail = 1 - threshold / 100, 1.0
    for differ in range(samples + 1):
        tail -= math.comb(samples, differ) * p ** differ * (1 - p) ** (samples - differ)
        if tail <= risk:
            return 2 * differ
    return 2 * samples


def _set_id(hashes: np.ndarray) -> int | None:
    if not len(hashes):
        return None
    x = xxhash.xxh3_64_intdigest(hashes.tobytes())
    return x - (x >> 63 << 64)


def _describe(n, rows_, bands):
    """(doc_id, n, set) of each document, with text key, bands and sketch once a set and task."""
    def rows(batches):
        seen: set[int] = set()
        for batch in batches:
            sizes, ids, keys, sketches = [], [], [], []
            for text in batch.column(2).to_pylist():
                hashes = shingles(text, n)
                own = _set_id(hashes)
                sizes.append(len(hashes))
                ids.append(own)
                if own is None or own in seen:
                    keys.append(None)
                    sketches.append(None)
                    continue
                if len(seen) < _SEEN:
                    seen.add(own)
                least = minhashes(hashes)
                keys.append(band_keys(least, rows_, bands))
                sketches.append(odd_sketch(least))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(ids, pa.int64()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64()))],
                names=["doc_id", "text_key", "n", "set", "bands", "sketch"])
    return rows


def _probes(bits, shared):
    """(key, set, n) of the bands whose bit is set: those that two sets may share."""
    def rows(batches):
        bitmap = np.frombuffer(shared.value, dtype=np.int64)
        for batch in batches:
            bands = batch.column("bands")
            key = bands.flatten().to_numpy(zero_copy_only=False)
            each = np.repeat(np.arange(batch.num_rows), np.diff(bands.offsets.to_numpy()))
            low = key & (bits - 1)
            hit = np.flatnonzero(bitmap[low >> 6] >> (low & 63) & 1)
            each = pa.array(each[hit])
            yield pa.RecordBatch.from_arrays([pa.array(key[hit]), batch.column("set").take(each), batch.column("n").take(each)], names=["key", "set", "n"])
    return rows


def _sets_of(texts: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(set, hashes) of the sets in ``wanted`` (set, text_key), from ``texts`` (text_key, text):
    only texts whose key may be wanted are cut into shingles again."""
    bits, bitmap = bitmap_of(wanted, "text_key")
    shared = texts.sparkSession.sparkContext.broadcast(bitmap)

    def rows(batches):
        words, seen = np.frombuffer(shared.value, dtype=np.int64), set()
        for batch in batches:
            key = batch.column(0).to_numpy()
            low = key & (bits - 1)
            hit = [i for i in np.flatnonzero(words[low >> 6] >> (low & 63) & 1).tolist() if key[i] not in seen]
            sets = {}
            for k, text in zip(key[hit].tolist(), batch.column(1).take(pa.array(hit, pa.int64())).to_pylist()):
                if k not in sets:
                    sets[k] = shingles(text, n)
            if len(seen) < _SEEN:
                seen.update(sets)
            found = [(_set_id(x), x) for x in sets.values() if len(x)]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in found], pa.int64()), pa.array([x for _, x in found], pa.list_(pa.int64()))], names=["set", "hashes"])

    found = texts.mapInArrow(rows, "set long, hashes array<long>").join(wanted.select("set"), "set", "left_semi")
    return found.groupBy("set").agg(F.first("hashes").alias("hashes"))


def _compare(threshold):
    """(a, b) of pairs that are linked. Rows come by key, a's set before those that it is compared with."""
    def rows(batches):
        key, leader, own = None, None, None
        for batch in batches:
            hashes = batch.column("hashes")
            flat, ends = hashes.flatten().to_numpy(zero_copy_only=False), np.cumsum([0, *np.diff(hashes.offsets.to_numpy())])
            out = []
            for i, (k, probe, name) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("key", "probe", "set")))):
                x = flat[ends[i]:ends[i + 1]]
                if not probe:
                    key, leader, own = k, x.copy(), name
                elif k == key:
                    overlap = len(np.intersect1d(x, leader, assume_unique=True))
                    if 100 * overlap >= threshold * (len(x) + len(leader) - overlap):
                        out.append((own, name))
            both = np.array(out, dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], names=["a", "b"])
    return rows


def _unlike(a: Column, b: Column) -> Column:
    """Population count of the XOR of two sketches."""
    out = F.lit(0)
    for k in range(LONGS):
        out = out + F.bit_count(F.get(a, F.lit(k)).bitwiseXOR(F.get(b, F.lit(k))))
    return out


def _alike(a: str, b: str, sketch_a: str, sketch_b: str, threshold: int) -> Column:
    """Sizes and sketches allow the similarity."""
    fits = (100 * F.least(a, b) >= threshold * F.greatest(a, b))
    return fits & (_unlike(F.col(sketch_a), F.col(sketch_b)) <= most_bits(threshold))


def _likely(pairs: DataFrame, unique: DataFrame, threshold: int) -> DataFrame:
    """The ``pairs`` (a, b) that sizes and sketches allow."""
    of = lambda c: unique.select(F.col("set").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"s_{c}"))
    return pairs.join(of("a"), "a").join(of("b"), "b").where(_alike("n_a", "n_b", "s_a", "s_b", threshold)).select("a", "b")


def _links(likely: DataFrame, texts: DataFrame, unique: DataFrame, n: int, threshold: int) -> DataFrame:
    """The linked ones of the pairs (a, b), by their full sets; stored."""
    likely = stored(likely, "odd-likely")
    nodes = likely.select(F.col("a").alias("set")).union(likely.select("b")).distinct()
    nodes = stored(nodes.join(unique.select("set", "text_key"), "set"), "odd-nodes")
    # a block has one set, and a part of those that it is compared with
    keyed = likely.select(F.xxhash64("a", F.pmod("b", F.lit(64))).alias("key"), "a", "b")
    work = (keyed.select("key", F.lit(False).alias("probe"), F.col("a").alias("set")).distinct()
            .union(keyed.select("key", F.lit(True), "b")))
    rows = work.join(_sets_of(texts, nodes, n), "set").repartition("key").sortWithinPartitions("key", "probe")
    out = stored(rows.select("key", "probe", "set", "hashes").mapInArrow(_compare(threshold), "a long, b long"), "odd-links")
    discard(likely)
    discard(nodes)
    return out


def _labelled(bands: DataFrame, labels: DataFrame) -> DataFrame:
    """``bands`` with each set's component; a set without links is its own."""
    return bands.join(labels.withColumnRenamed("node", "set"), "set", "left").withColumn("component", F.coalesce("component", "set"))


def _open(bands: DataFrame) -> DataFrame:
    """Per key of several components: its number of sets, its leader (the set that comes
    first in one order of all sets) and the leader's component."""
    first = F.min(F.struct(F.xxhash64("set").alias("order"), "set", "component")).alias("first")
    found = bands.groupBy("key").agg(first, F.count("*").alias("sets"), F.min("component").alias("low"), F.max("component").alias("high"))
    return found.where("low != high").select("key", "sets", F.col("first.set").alias("a"), F.col("first.component").alias("of_a"))


def _led(bands: DataFrame) -> DataFrame:
    """(a, b): each set with the leader of its bands, from another component, that comes first."""
    both = bands.join(_open(bands), "key").where("component != of_a")
    order = F.struct(F.xxhash64("a").alias("order"), "a")
    return both.groupBy(F.col("set").alias("b")).agg(F.min(order).alias("first")).select("first.a", "b")


def _whole(batches):
    """The rows, sorted by key, in tables that hold whole keys."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        if not table.num_rows:
            continue
        key = table.column("key").to_numpy()
        other = np.flatnonzero(key != key[-1])
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut:
            yield table.slice(0, cut).combine_chunks()
        held = table.slice(cut)
    if held is not None:
        yield held.combine_chunks()


def _groups(table):
    """(from, to) of the rows of each key."""
    key = table.column("key").to_numpy()
    edges = np.append(np.flatnonzero(np.diff(key, prepend=key[0] - 1)), len(key))
    return zip(edges.tolist(), edges[1:].tolist())


def _forest(component, rows):
    """(i, j) that join components, without any that others already join, and each row's label after
    that. ``rows`` gives for each i the mask of its partners."""
    _, label = np.unique(component, return_inverse=True)
    out = []
    for i, mask in rows:
        mask = mask & (label != label[i])
        while mask.any():
            j = int(mask.argmax())
            out.append((i, j))
            label[label == label[j]] = label[i]
            mask &= label != label[i]
    return out, label


def _fit(n, i, threshold):
    return 100 * np.minimum(n, n[i]) >= threshold * np.maximum(n, n[i])


def _alike_components(threshold):
    """(a, b): components of a part of a band that alike sketches join, each with the smallest one of them."""
    limit = most_bits(threshold)

    def rows(batches):
        for table in _whole(batches):
            n, component = table.column("n").to_numpy(), table.column("component").to_numpy()
            sketch = pc.list_flatten(table.column("sketch")).to_numpy().view(np.uint64).reshape(-1, LONGS)
            out = []
            for start, end in _groups(table):
                part = slice(start, end)
                s, c, size = sketch[part], component[part], n[part]

                def masks(s=s, c=c, size=size):
                    for i in range(len(s)):
                        mask = (c != c[i]) & _fit(size, i, threshold)
                        at = np.flatnonzero(mask)
                        mask[at] = np.bitwise_count(s[at] ^ s[i]).sum(axis=1) <= limit  # unsigned: numpy counts the bits of absolute values
                        yield i, mask

                joined, label = _forest(c, masks())
                if joined:  # each to the smallest one of its group: other bands hand on the same pairs
                    least = np.full(int(label.max()) + 1, np.iinfo(np.int64).max)
                    np.minimum.at(least, label, c)
                    out += {(int(x), int(r)) for x, r in zip(c, least[label]) if x != r}
            yield _edges(out)
    return rows


def _edges(out):
    both = np.array(out, dtype=np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], names=["a", "b"])


def overlaps(flat: np.ndarray, sizes: np.ndarray, columns: int = 4096) -> np.ndarray:
    """Sizes of the intersections of all sets of a block, exactly: products of 0/1 columns."""
    m = len(sizes)
    tokens, which, counts = np.unique(flat, return_inverse=True, return_counts=True)
    place = np.where(counts > 1, np.cumsum(counts > 1) - 1, -1)[which]  # a token of one set is in no overlap
    owner = np.repeat(np.arange(m), sizes)[place >= 0]
    place = place[place >= 0]
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    out = np.zeros((m, m), dtype=np.float64)
    for at in range(0, int(place[-1]) + 1 if len(place) else 0, columns):
        lo, hi = np.searchsorted(place, (at, at + columns))
        held = np.zeros((m, min(columns, int(place[-1]) + 1 - at)), dtype=np.float32)
        held[owner[lo:hi], place[lo:hi] - at] = 1
        out += held @ held.T  # at most 4096 in a product: exact in 32 bits
    return out.astype(np.int64)


def _linked_sets(threshold):
    """(a, b): a forest of links between the sets of a pair of blocks."""
    def rows(batches):
        for table in _whole(batches):
            name, n, component = (table.column(c).to_numpy() for c in ("set", "n", "component"))
            flat, ends = pc.list_flatten(table.column("hashes")).to_numpy(), np.append(0, np.cumsum(n))
            out = []
            for start, end in _groups(table):
                size, o, c = n[start:end], name[start:end], component[start:end]
                if (c == c[0]).all():
                    continue
                both = overlaps(flat[ends[start]:ends[end]], size)
                out += [(o[i], o[j]) for i, j in _forest(c, ((i, 100 * both[i] >= threshold * (size + size[i] - both[i])) for i in range(len(c))))[0]]
            yield _edges(out)
    return rows


def _clusters(bands: DataFrame, unique: DataFrame, threshold: int, part: int) -> DataFrame:
    """(set, n, component, cluster) of sets in a band of several components, where the sketches of
    some sets of the components are alike; stored."""
    parts = _open(bands).select("key", F.ceil(F.col("sets") / part).cast("int").alias("parts"))
    opened = stored(bands.join(parts, "key"), "odd-open")
    own = F.pmod(F.xxhash64("set"), "parts").cast("int")
    # each two parts of a band meet; a band of one part is alone
    meets = F.expr("transform(filter(sequence(0, parts - 1), j -> j != own), j -> least(own, j) * parts + greatest(own, j))")
    rows = opened.join(unique.select("set", "sketch"), "set").withColumn("own", own)
    rows = rows.withColumn("pair", F.explode(F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(meets)))
    rows = rows.select(F.xxhash64("key", "pair").alias("key"), "n", "component", "sketch").repartition("key").sortWithinPartitions("key")
    alike = stored(rows.mapInArrow(_alike_components(threshold), "a long, b long").distinct(), "odd-alike")
    cluster = components(alike).select(F.col("node").alias("component"), F.col("component").alias("cluster"))
    out = stored(opened.select("set", "n", "component").distinct().join(cluster, "component"), "odd-clusters")
    discard(opened)
    discard(alike)
    return out


def _blocks(members: DataFrame, block: int) -> DataFrame:
    """(key, set, n, component): the sets of each pair of blocks of a cluster. A component of at
    least ``block`` sets has blocks of its own, smaller ones share blocks."""
    sizes = members.groupBy("cluster", "component").agg(F.count("*").alias("sets"))
    little = sizes.where(F.col("sets") < block).groupBy("cluster").agg(F.sum("sets").alias("little"))
    large = F.col("sets") >= block
    place = F.when(large, F.xxhash64("component", F.pmod(F.xxhash64("set"), F.ceil(F.col("sets") / block)))).otherwise(
        F.xxhash64(F.lit("little"), F.pmod(F.xxhash64("component"), F.ceil(F.col("little") / block))))
    placed = members.join(sizes.join(little, "cluster", "left"), ["cluster", "component"])
    placed = stored(placed.withColumn("block", place).withColumn("pure", F.when(large, F.col("component"))).drop("sets", "little"), "odd-placed")
    blocks = placed.groupBy("cluster", "block").agg(F.first("pure").alias("pure"))
    number = blocks.groupBy("cluster").agg(F.count("*").alias("blocks"))
    a = blocks.select("cluster", F.col("block").alias("one"), F.col("pure").alias("pure_one"))
    b = blocks.join(number, "cluster").select("cluster", F.col("block").alias("other"), F.col("pure").alias("pure_other"), "blocks")
    pairs = a.join(b, "cluster").where("(one < other or blocks = 1) and not coalesce(pure_one = pure_other, false)")
    pairs = stored(pairs.select("cluster", F.xxhash64("cluster", "one", "other").alias("key"), "one", "other"), "odd-pairs")
    both = pairs.select("cluster", "key", F.explode(F.array_distinct(F.array("one", "other"))).alias("block"))
    return placed.join(both, ["cluster", "block"]).select("key", "set", "n", "component")


def _cluster_links(members: DataFrame, texts: DataFrame, unique: DataFrame, n: int, threshold: int, block: int) -> DataFrame:
    """Links between sets of a cluster that are in different components: enough of them to join what belongs together."""
    nodes = stored(members.select("set").join(unique.select("set", "text_key"), "set"), "odd-nodes")
    rows = _blocks(members, block).join(_sets_of(texts, nodes, n), "set").repartition("key").sortWithinPartitions("key")
    out = stored(rows.select("key", "set", "n", "component", "hashes").mapInArrow(_linked_sets(threshold), "a long, b long").distinct(), "odd-links")
    discard(nodes)
    return out


def near_duplicates(docs: DataFrame, n: int = WORDS, threshold: int = THRESHOLD, rows: int = ROWS, bands: int = BANDS,
                    part: int = PART, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    A null or empty text, or one without words, has an empty set and is linked with
    nothing, so its component is its own doc_id. Equal sets are linked. Rows are
    linked one by one: a doc_id may occur twice, and all its rows in a component
    have the same ``kept``; a null doc_id is never the smallest, and a row with a
    null doc_id is kept only if its component has no other. An empty table gives an
    empty result. Other columns are ignored.
    """
    spark = ship(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    described = stored(docs.mapInArrow(_describe(n, rows, bands), f"doc_id {id_type}, text_key long, n long, set long, bands array<long>, sketch array<long>"),
                       "odd-documents")
    documents = described.select("doc_id", "n", "set")
    unique = stored(described.where("bands is not null").drop("doc_id").dropDuplicates(["set"]), "odd-sets")

    twice = unique.select(F.explode("bands").alias("key")).groupBy("key").agg(F.count("*").alias("sets")).where("sets > 1")
    bits, bitmap = bitmap_of(twice, "key")
    probes = _probes(bits, spark.sparkContext.broadcast(bitmap))
    lists = stored(unique.select("set", "n", "bands").mapInArrow(probes, "key long, set long, n long"), "odd-bands")

    texts = docs.select("text_key", "text")
    first = lists.withColumn("component", F.col("set"))
    links = _links(_likely(_led(first), unique, threshold), texts, unique, n, threshold)
    marked = stored(_labelled(lists, components(links)), "odd-marked")
    members = _clusters(marked, unique, threshold, part)
    labels = components(links.union(_cluster_links(members, texts, unique, n, threshold, block)))
    discard(marked)
    by_set = documents.where("set is not null").groupBy("set").agg(F.min("doc_id").alias("least"))
    by_set = by_set.join(labels.withColumnRenamed("node", "set"), "set", "left").withColumn("component", F.coalesce("component", "set"))
    by_set = stored(by_set, "odd-by-set")
    least = by_set.groupBy("component").agg(F.min("least").alias("component_id"))
    of_set = by_set.join(least, "component").select("set", "component_id")
    out = (documents.where("set is not null").join(of_set, "set").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
           .union(documents.where("set is null").select("doc_id", "n", "doc_id")))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op13_odd_sketches(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def components_sql(n: int, threshold: int = THRESHOLD) -> str:
    """The same components from all pairs that share a shingle, and a recursion over the links."""
    words = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')"
    return f"""WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, {words} AS words FROM documents),
    s AS MATERIALIZED (SELECT doc_id, CASE WHEN len(words) = 0 OR words IS NULL THEN [] ELSE list_distinct(list_transform(
        range(1, greatest(len(words) - {n - 1}, 1) + 1), lambda i: array_to_string(words[i:i + {n - 1}], ' '))) END AS shingles FROM w),
    t AS MATERIALIZED (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM s),
    links AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b FROM t a JOIN t b ON a.shingle = b.shingle AND a.doc_id != b.doc_id
        AND 100 * least(a.n, b.n) >= {threshold} * greatest(a.n, b.n)
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {threshold} * (a.n + b.n - count(*))),
    reach AS (SELECT DISTINCT a AS doc_id, a AS root FROM links UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.doc_id),
    least_of AS (SELECT doc_id, min(root) AS root FROM reach GROUP BY doc_id)
    SELECT s.doc_id, CAST(len(s.shingles) AS BIGINT) AS n_shingles, coalesce(r.root, s.doc_id) AS component_id
    FROM s LEFT JOIN least_of r ON r.doc_id = s.doc_id"""


OP13_SQL = f"SELECT *, doc_id = component_id AS kept FROM ({components_sql(WORDS)})"
