"""Token counts: prefix dynamic programming over byte-level BPE.

A sequence of tokens is what BPE makes of its text exactly if each two
neighbours are what BPE makes of theirs. So every prefix of a piece of text has
one last token, found from the last tokens of shorter prefixes: the token must
end there, and must go with the last token before it. One pass gives the exact
token count of every prefix, and questions about truncation or budgets are
looked up and need no second encoding.

The text is first split by the tokenizer's pattern; pieces repeat a lot, so the
counts of a piece are kept for the whole life of a Python worker.
"""

from __future__ import annotations

import json
import math

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import ship

#: The split pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LIMIT = 512
#: Entries that a worker keeps, of pieces' totals (about 0.1 KB each) and of token pairs; beyond, it starts anew.
KEPT, KEPT_PAIRS = 1_500_000, 500_000


def _byte_chars() -> dict[str, int]:
    """The characters that stand for bytes in the vocabulary file: printable
    Latin-1 characters for themselves, the others from U+0100 on in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or (161 <= b <= 255 and b != 173)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class PrefixCounter:
    """Exact token counts of all prefixes, from the bytes of a tokenizer's JSON file."""

    def __init__(self, blob: bytes):
        spec = json.loads(blob)
        if spec["model"]["type"] != "BPE" or spec["pre_tokenizer"].get("type") != "ByteLevel" or spec.get("normalizer"):
            raise ValueError("a byte-level BPE tokenizer without normalizer is needed")
        chars = _byte_chars()
        raw = lambda s: bytes(chars[c] for c in s)
        specials = {t["content"] for t in spec["added_tokens"]}
        self.vocab = {raw(s): i for s, i in spec["model"]["vocab"].items() if s not in specials}
        self.rank = {}
        for i, m in enumerate(spec["model"]["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.rank[raw(a), raw(b)] = i
        self.longest = max(map(len, self.vocab))
        self.special = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True)))) if specials else None
        self.split = regex.compile(PATTERN)
        self.white = regex.compile(r"\s").match
        self.pieces: dict[str, np.ndarray] = {}
        self.totals: dict[str, int] = {}
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self.trees: dict[bytes, tuple[bytes, bytes] | None] = {}
        self.right_edges: dict[bytes, list[tuple[bytes, float]]] = {}
        self.left_edges: dict[bytes, list[tuple[bytes, float]]] = {}

    def merge(self, text: bytes, down_to: int = 1) -> list[bytes]:
        """Plain BPE of a short text, until no pair can be merged or ``down_to`` parts are left."""
        parts = [text[i:i + 1] for i in range(len(text))]
        while len(parts) > down_to:
            ranks = [self.rank.get(p, 1 << 60) for p in zip(parts, parts[1:])]
            best = min(ranks)
            if best == 1 << 60:
                break
            out, i = [], 0
            while i < len(parts):
                if i < len(ranks) and ranks[i] == best:
                    out.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def tree(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two tokens whose merge makes this one; None for a byte, and for what BPE never makes."""
        if token not in self.trees:
            parts = self.merge(token, 2) if len(token) > 1 else []
            self.trees[token] = tuple(parts) if len(parts) == 2 and tuple(parts) in self.rank else None
        return self.trees[token]

    def edge(self, token: bytes, side: int) -> list[tuple[bytes, float]]:
        """The parts that stand at one end of a token while BPE makes it, from the byte on: each with
        the rank of the merge that it is used up in (the token itself never is)."""
        known = (self.left_edges, self.right_edges)[side]
        out = known.get(token)
        if out is None:
            out, part, rank = [], token, math.inf
            while True:
                out.append((part, rank))
                halves = self.tree(part)
                if halves is None:
                    break
                part, rank = halves[side], self.rank[halves]
            out = known[token] = out[::-1]
        return out

    def goes_with(self, before: bytes, token: bytes) -> bool:
        """Whether BPE leaves a border between the two: no parts that meet there while the tokens are made
        have a merge that comes before those that use the parts up. Of equal merges the left one comes first."""
        key = (before, token)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            known = len(token) == 1 or self.tree(token) is not None
            if known and before:
                lefts, rights, i, j = self.edge(before, 1), self.edge(token, 0), 0, 0
                while True:
                    (a, used_a), (b, used_b) = lefts[i], rights[j]
                    across = self.rank.get((a, b), math.inf)
                    if across < used_a and across <= used_b and across < math.inf:
                        known = False
                        break
                    if used_a == used_b == math.inf:
                        break
                    if used_a <= used_b:
                        i += 1
                    else:
                        j += 1
            self.pairs[key] = known
        return known

    def byte_counts(self, text: bytes) -> list[int]:
        """Token counts of the prefixes of one piece, by length in bytes."""
        counts, last = [0], [b""]
        vocab, longest, pairs = self.vocab, self.longest, self.pairs
        for end in range(1, len(text) + 1):
            for start in range(max(0, end - longest), end):
                token = text[start:end]
                if token in vocab:
                    known = pairs.get((last[start], token))
                    if known or (known is None and self.goes_with(last[start], token)):
                        counts.append(counts[start] + 1)
                        last.append(token)
                        break
            else:  # cannot happen: every byte is a token
                raise ValueError("no token ends here")
        return counts

    def piece_counts(self, piece: str) -> np.ndarray:
        """Token counts of the prefixes of one piece, by length in code points."""
        known = self.pieces.get(piece)
        if known is None:
            raw = piece.encode()
            counts = np.array(self.byte_counts(raw), dtype=np.uint8 if len(raw) < 256 else np.int32)
            known = counts if len(raw) == len(piece) else counts[np.cumsum([0, *[len(c.encode()) for c in piece]])]
            if len(piece) <= 64:
                if len(self.pieces) >= KEPT_PAIRS:
                    self.pieces.clear()
                self.pieces[piece] = known
        return known

    def total(self, piece: str) -> int:
        n = self.totals.get(piece)
        if n is None:
            n = self.byte_counts(piece.encode())[-1]
            if len(piece) <= 64:
                if len(self.totals) >= KEPT:
                    self.totals.clear()
                self.totals[piece] = n
        return n

    def _parts(self, text: str):
        """(start, part, is special) of the text between and at special strings."""
        at = 0
        for m in self.special.finditer(text) if self.special else ():
            if m.start() > at:
                yield at, text[at:m.start()], False
            yield m.start(), m.group(), True
            at = m.end()
        if at < len(text):
            yield at, text[at:], False

    def count(self, text: str) -> int:
        """Token count of the whole text: the last entry of ``prefix_counts``."""
        return self.count_and_cut(text, None)[0]

    def count_and_cut(self, text: str, limit: int | None) -> tuple[int, int]:
        """Token count of the whole text, and the code points of its longest prefix of at most
        ``limit`` tokens. The pieces are walked once; only the one in which the limit is
        passed, and white space right before it, is laid out by prefixes."""
        get, total, find = self.totals.get, self.total, self.split.findall
        n, cut = 0, None
        for start, part, is_special in self._parts(text):
            if is_special:
                if limit is not None and cut is None and n + len(part) > limit:  # a cut special string is ordinary text
                    cut = self._cut_slowly(text, limit) if n + 1 > limit or self._cut_slowly(text[:start + len(part)], limit) < start + len(part) else None
                n += 1
                continue
            pieces = find(part)
            counts = [get(p) or total(p) for p in pieces]
            more = sum(counts)
            if limit is not None and cut is None and n + more > limit:
                at = int(np.searchsorted(np.cumsum(counts), limit - n, side="right"))
                first = at
                while first and self.white(pieces[first - 1], len(pieces[first - 1]) - 1):
                    first -= 1
                begin = sum(map(len, pieces[:first]))
                end = begin + sum(map(len, pieces[first:at + 1]))
                table = self._laid_out(part, begin, end, n + sum(counts[:first]))
                cut = start + begin + int(np.flatnonzero(table <= limit)[-1])
            n += more
        return n, len(text) if cut is None else cut

    def _laid_out(self, part: str, begin: int, end: int, n: int) -> np.ndarray:
        """Token counts of the prefixes of a part without special strings that end in [begin, end], borders of pieces."""
        out = np.zeros(end - begin + 1, dtype=np.int64)
        out[0] = n
        run_at, run_n = begin, n
        for m in self.split.finditer(part, begin):
            a, b, piece = m.start(), m.end(), m.group()
            counts = self.piece_counts(piece)
            out[a + 1 - begin:b + 1 - begin] = n + counts[1:].astype(np.int64)
            if len(piece) == 3 and piece[0] == "'" and piece[1:].isalpha():
                out[a + 2 - begin] = n + 2  # a cut 're, 've or 'll splits after the quote
            if self.white(piece):
                if a == begin or not self.white(part, a - 1):
                    run_at, run_n = a, n
                elif a > run_at:  # white space at the end of a prefix is one piece
                    stop = b if self.white(piece, len(piece) - 1) else a + 1
                    run = self.piece_counts(part[run_at:stop])
                    out[a + 1 - begin:stop + 1 - begin] = run_n + run[a + 1 - run_at:].astype(np.int64)
            n += int(counts[-1])
            if b >= end:
                return out
        return out

    def prefix_counts(self, text: str, limit: int | None = None) -> np.ndarray:
        """Entry i is the token count of the first i code points.

        With a limit, the table ends where no longer prefix is within it.
        """
        out = np.zeros(len(text) + 1, dtype=np.int64)
        n, filled, run_at, run_n, before = 0, 0, 0, 0, 0
        for start, part, is_special in self._parts(text):
            if is_special:
                for i in range(1, len(part)):  # a cut special string is ordinary text
                    out[start + i] = before + self.count(text[filled:start + i])
                n += 1
                out[start + len(part)] = n
                filled, before = start + len(part), n
                continue
            filled, before, run_n = start, n, n
            for m in self.split.finditer(part):
                a, b, piece = start + m.start(), start + m.end(), m.group()
                counts = self.piece_counts(piece)
                out[a + 1:b + 1] = n + counts[1:].astype(np.int64)
                if len(piece) == 3 and piece[0] == "'" and piece[1:].isalpha():
                    out[a + 2] = n + 2  # a cut 're, 've or 'll splits after the quote
                if self.white(piece):
                    if a == start or not self.white(text, a - 1):
                        run_at, run_n = a, n
                    elif a > run_at:  # white space at the end of a prefix is one piece
                        stop = b if self.white(piece, len(piece) - 1) else a + 1
                        run = self.piece_counts(text[run_at:stop])
                        out[a + 1:stop + 1] = run_n + run[a + 1 - run_at:].astype(np.int64)
                n += int(counts[-1])
                if limit is not None and n > limit:
                    return out[:b + 1]
        return out

    def cut(self, text: str, limit: int) -> int:
        """Code points of the longest prefix of at most ``limit`` tokens."""
        return self.count_and_cut(text, limit)[1]

    def _cut_slowly(self, text: str, limit: int) -> int:
        return int(np.flatnonzero(self.prefix_counts(text, limit) <= limit)[-1])


_COUNTERS: dict[int, PrefixCounter] = {}


def _counter(shared) -> PrefixCounter:
    """One counter for each Python worker and file."""
    key = hash(shared.value)
    if key not in _COUNTERS:
        _COUNTERS[key] = PrefixCounter(shared.value)
    return _COUNTERS[key]


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit, cut_chars.

    ``cut_chars`` is the length in code points of the longest prefix within
    ``limit`` tokens. A null text counts as empty: no bytes, no tokens. Special
    strings inside a text count as one token, as the library takes them. The
    tokenizer's file is read by the driver and sent to the executors. Repeated
    rows, ties and long texts need no special care; an empty table gives an
    empty result. Other columns are ignored.
    """
    with open(tokenizer_path, "rb") as f:
        shared = ship(docs.sparkSession).sparkContext.broadcast(f.read())

    def rows(batches):
        counter = _counter(shared)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            found = [counter.count_and_cut(t, limit) for t in texts]
            n, cuts = ([f[i] for f in found] for i in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(n, pa.int64()),
                 pa.array([k > limit for k in n]), pa.array(cuts, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit", "cut_chars"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        rows, f"doc_id {id_type}, n_bytes long, n_tokens long, over_limit boolean, cut_chars long")


def op6_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
