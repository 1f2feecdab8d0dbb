"""Benchmark decontamination: hash set of test n-grams, scanned over token windows.

A benchmark item gives all runs of 10 consecutive words, or its whole sequence
if it has fewer. The windows are sent to the executors as a hash set in sorted
arrays. Each text is turned into word numbers of the benchmark's vocabulary, a
hash of each window is looked up, and hits are verified word by word.

The set is broadcast in blocks of bounded size: a benchmark above
``block_bytes`` is cut into blocks by item, and the texts are scanned once a
block, with the hits so far stored beside them.
"""

from __future__ import annotations

import re
import uuid
from functools import cached_property
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, stored

N = 10
#: Benchmark text (bytes) that is broadcast at once.
BLOCK_BYTES = 32 << 20
_WORD_BYTES = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(0x80, 0x100))
_FOLD = bytes(ord(chr(b).lower()) if b < 0x80 and chr(b).lower().encode()[0] in _WORD_BYTES else b if b >= 0x80 else 0x20 for b in range(256))
_WORD_TEXT = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")


def words_of(text: str | None) -> list[bytes]:
    """Words of a text, A-Z lower-cased: runs of digits, a-z and everything beyond ASCII."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


class WindowSet:
    """The windows of some benchmark items, with the items each of them stands for.

    The items' words are one array of word numbers. Windows of one length are a sorted
    array of 64-bit hashes beside the places where they start: about 16 bytes a window.
    It is built on the driver; only the vocabulary becomes a dictionary in a worker.
    """

    def __init__(self, items: list[tuple[str, str | list[bytes] | None]], n: int = N):
        """``items``: (id, text), or (id, words of the text)."""
        numbers: dict[bytes, int] = {}
        parts = []
        for _, text in items:
            words = text if isinstance(text, list) else words_of(text)
            parts.append(np.array([numbers.setdefault(w, len(numbers) + 1) for w in words], dtype=np.uint32))
        self.items = [k for k, _ in items]
        self.words = np.concatenate([*parts, np.empty(0, dtype=np.uint32)])
        lengths = np.array(list(map(len, parts)), dtype=np.int64)
        self.ends = np.cumsum(lengths)
        self.vocabulary = b" ".join(numbers)
        self.factors = np.random.default_rng(5).integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.windows = {}
        sizes = np.minimum(lengths, n)
        for size in np.unique(sizes[sizes > 0]).tolist():
            starts = [np.arange(e - k, e - size + 1) for e, k, s in zip(self.ends, lengths, sizes) if s == size]
            self.windows[size] = self._sorted(np.concatenate(starts), size)

    def _sorted(self, at: np.ndarray, size: int):
        """(hashes in order, where their windows start, filter on the first bits)."""
        hashes = self._hash([self.words[at + j] for j in range(size)])
        order = np.lexsort((at, hashes))
        hashes, at = hashes[order], at[order]
        again = (hashes[1:] == hashes[:-1]) & (self.item_of(at[1:]) == self.item_of(at[:-1]))
        for j in range(size):
            again &= self.words[at[1:] + j] == self.words[at[:-1] + j]
        fresh = np.append(True, ~again)  # a window that an item repeats is kept once
        hashes, at = hashes[fresh], at[fresh].astype(np.uint32)
        shift = np.uint64(64 - min(26, max(20, (8 * len(hashes)).bit_length())))
        seen = np.zeros(1 << (64 - int(shift)), dtype=bool)
        seen[hashes >> shift] = True
        return hashes, at, seen, shift

    def item_of(self, at) -> np.ndarray:
        return np.searchsorted(self.ends, at, side="right")

    @cached_property
    def numbers(self) -> dict[bytes, int]:
        return {w: i + 1 for i, w in enumerate(self.vocabulary.split())}

    def _hash(self, columns) -> np.ndarray:
        total = columns[0].astype(np.uint64) * self.factors[0]
        for c, f in zip(columns[1:], self.factors[1:]):
            total = total + c * f
        return total ^ total << np.uint64(29)

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set[int]]:
        """(mask of hit words, indexes of the items with occurring windows)."""
        hit, found = np.zeros(len(words), dtype=bool), set()
        ids = np.fromiter(map(self.numbers.get, words, repeat(0)), dtype=np.uint32, count=len(words))
        for size, (hashes, at, seen, shift) in self.windows.items():
            n = len(ids) - size + 1
            if n <= 0:
                continue
            own = self._hash([ids[j:n + j] for j in range(size)])
            maybe = np.flatnonzero(seen[own >> shift])
            first, last = np.searchsorted(hashes, own[maybe]), np.searchsorted(hashes, own[maybe], side="right")
            for i, a, b in zip(maybe[first < last], first[first < last], last[first < last]):
                starts = at[a:b].astype(np.int64)
                same = np.ones(len(starts), dtype=bool)
                for j in range(size):
                    same &= self.words[starts + j] == ids[i + j]
                if same.any():
                    hit[i:i + size] = True
                    found.update(self.item_of(starts[same]).tolist())
        return hit, found


_SETS: dict[str, WindowSet] = {}


def _window_set(shared, key: str) -> WindowSet:
    """One set for each Python worker and broadcast; only the last is kept."""
    if key not in _SETS:
        _SETS.clear()
        _SETS[key] = shared.value
    return _SETS[key]


def _blocks(benchmark: DataFrame, block_bytes: int):
    """The items in lists of about ``block_bytes`` of text each."""
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.coalesce("text", F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for k in range(n):
        yield [(r[0], r[1]) for r in rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k).collect()]


def scan_documents(docs: DataFrame, benchmark: DataFrame, n: int = N, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items, spans, contaminated.

    ``items`` are the ids (as strings, sorted) of the items with windows in the
    text, each once; ``spans`` are the maximal runs of hit words, as first word
    and word after the last. A null text has no words; a null item_id counts as
    the empty string; items without words have no windows, repeated items count
    once. Empty tables give no rows, or no hits. Other columns are ignored.
    """
    spark = ship(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    kept = f"doc_id {id_type}, text string, items array<string>, spans array<array<int>>"
    final = f"doc_id {id_type}, n_words long, n_hit long, n_items long, items array<string>, spans array<array<int>>, contaminated boolean"

    def scan(shared, last):
        key = uuid.uuid4().hex

        def rows(batches):
            windows = _window_set(shared, key)
            for batch in batches:
                cols = batch.to_pydict()
                out = {k: [] for k in (("n_words", "n_hit") if last else ()) + ("items", "spans")}
                for text, items, spans in zip(cols["text"], cols["items"], cols["spans"]):
                    words = words_of(text)
                    hit, found = windows.scan(words)
                    for a, b in spans:
                        hit[a:b] = True
                    out["items"].append(sorted({*items, *(windows.items[k] for k in found)}))
                    edges = np.flatnonzero(np.diff(hit.astype(np.int8), prepend=0, append=0))
                    out["spans"].append(edges.reshape(-1, 2).tolist())
                    if last:
                        out["n_words"].append(len(words))
                        out["n_hit"].append(int(hit.sum()))
                items, spans = pa.array(out["items"], pa.list_(pa.string())), pa.array(out["spans"], pa.list_(pa.list_(pa.int32())))
                ids = batch.column("doc_id")
                if last:
                    cols = [ids, pa.array(out["n_words"], pa.int64()), pa.array(out["n_hit"], pa.int64()),
                            pa.array(list(map(len, out["items"])), pa.int64()), items, spans, pa.array([k > 0 for k in out["n_hit"]], pa.bool_())]
                    names = ["doc_id", "n_words", "n_hit", "n_items", "items", "spans", "contaminated"]
                else:
                    cols, names = [ids, batch.column("text"), items, spans], ["doc_id", "text", "items", "spans"]
                yield pa.RecordBatch.from_arrays(cols, names=names)
        return rows

    state = docs.select("doc_id", "text", F.array().cast("array<string>").alias("items"), F.array().cast("array<array<int>>").alias("spans"))
    blocks = _blocks(benchmark, block_bytes)
    block = next(blocks)
    for following in blocks:
        state = stored(state.mapInArrow(scan(spark.sparkContext.broadcast(WindowSet(block, n)), False), kept), "decontamination")
        block = following
    return state.mapInArrow(scan(spark.sparkContext.broadcast(WindowSet(block, n)), True), final)


def cut_words(text: str | None, spans: list[list[int]]) -> str | None:
    """The text without the words in ``spans`` (and what lies between them)."""
    if not text or not spans:
        return text
    at = [m.span() for m in _WORD_TEXT.finditer(text)]
    out, end = [], 0
    for a, b in spans:
        out.append(text[end:at[a][0]])
        end = at[b - 1][1]
    return "".join(out) + text[end:]


def op5_decontamination(spark, sf_dir: str) -> DataFrame:
    found = scan_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP5_SQL = f"""
WITH items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS size, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
  FROM items, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS r(i) WHERE len(w) > 0
), docs AS (
  SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents
), runs AS (
  SELECT rid, size, i, array_to_string(w[i:i + size - 1], ' ') AS g
  FROM docs, (SELECT DISTINCT size FROM windows), unnest(range(1, len(w) - size + 2)) AS r(i)
), found AS (
  SELECT DISTINCT rid, size, i, item FROM runs JOIN windows USING (size, g)
), words AS (
  SELECT rid, count(DISTINCT p) AS n_hit FROM found, unnest(range(i, i + size)) AS r(p) GROUP BY rid
), ids AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT rid, item FROM found) GROUP BY rid
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (rid) LEFT JOIN ids USING (rid)
"""
