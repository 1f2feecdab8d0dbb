"""PII: character-level bidirectional LSTM with CRF transitions, in numpy.

The tagger is trained on windows of a bounded sample of the documents. Their
spans are labelled by the rules of ``pii_rules``; further windows put one or
two of the labelled values, also such that touch, into other contexts. It then
tags overlapping windows of every text; a character takes its tag from the
window in which it is most central, and the spans are read off the whole text.
Every kind of span holds a digit or an at sign, so only windows around these
are tagged.

The spans found by rule always stay. A span of the tagger is added if it
overlaps none of them and is a possible value of its kind.
"""

from __future__ import annotations

import hashlib
import string

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, stored
from .pii_rules import KINDS, SIGNS, base_spans, plausible

SIZE, STRIDE, MARGIN = 80, 40, 20
#: Windows of the corpus that the tagger is trained on, at most; as many made ones are added.
MAX_WINDOWS = 1_500
HIDDEN, EPOCHS, BATCH, RATE = 16, 10, 64, 0.02
TAGS = 1 + 2 * len(KINDS)  # outside; begin and inside of each kind

_PLAIN = {c: i for i, c in enumerate(" \n" + string.punctuation)}
_FIRST = len(_PLAIN)
CLASSES = _FIRST + 7


def char_classes(text: str) -> np.ndarray:
    """One class for digits, four for letters, one each for ASCII punctuation, blank and newline."""
    out = np.empty(len(text), dtype=np.int64)
    for i, c in enumerate(text):
        k = _PLAIN.get(c)
        if k is None:
            if "0" <= c <= "9":
                k = _FIRST
            elif "a" <= c <= "z":
                k = _FIRST + 1 + (c > "f")
            elif "A" <= c <= "Z":
                k = _FIRST + 3 + (c > "F")
            else:
                k = _FIRST + 5 + c.isalpha()
        out[i] = k
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


class Tagger:
    """Weights; arrays with a leading 2 hold both directions."""

    def __init__(self, hidden: int = HIDDEN, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        self.w = {
            "x": rng.normal(0, 0.3, (2, CLASSES + 1, 4 * hidden)),  # class CLASSES pads
            "u": rng.normal(0, 0.25, (2, hidden, 4 * hidden)),
            "v": rng.normal(0, 0.3, (2 * hidden, TAGS)),
            "c": np.zeros(TAGS),
            "t": np.zeros((TAGS, TAGS)),
        }
        self.w["x"][:, :, hidden:2 * hidden] += 1.0  # forget gates start open

    def emissions(self, chars: np.ndarray, keep: list | None = None) -> np.ndarray:
        """Tag scores of windows (n, size); ``keep`` receives what the gradient needs."""
        n, size = chars.shape
        both = np.stack((chars, chars[:, ::-1]))
        h, c = np.zeros((2, n, self.hidden)), np.zeros((2, n, self.hidden))
        out = np.empty((2, size, n, self.hidden))
        k = self.hidden
        for t in range(size):
            z = np.matmul(h, self.w["u"])
            z[0] += self.w["x"][0][both[0, :, t]]
            z[1] += self.w["x"][1][both[1, :, t]]
            gates = _sigmoid(z[..., :3 * k])
            new = np.tanh(z[..., 3 * k:])
            before = c
            c = gates[..., k:2 * k] * c + gates[..., :k] * new
            tanh_c = np.tanh(c)
            if keep is not None:
                keep.append((h, before, gates, new, tanh_c))
            h = gates[..., 2 * k:] * tanh_c
            out[:, t] = h
        joined = np.concatenate((out[0], out[1][::-1]), axis=2)  # (size, n, 2 * hidden)
        if keep is not None:
            keep.append((both, joined))
        return joined @ self.w["v"] + self.w["c"]

    def viterbi(self, chars: np.ndarray) -> np.ndarray:
        """Best tags (n, size) under emissions and transitions."""
        e = self.emissions(chars)
        size, n, _ = e.shape
        score, back = e[0], np.empty((size, n, TAGS), dtype=np.int8)
        for t in range(1, size):
            step = score[:, :, None] + self.w["t"]
            back[t] = step.argmax(1)
            score = step.max(1) + e[t]
        out = np.empty((size, n), dtype=np.int8)
        out[-1] = score.argmax(1)
        for t in range(size - 1, 0, -1):
            out[t - 1] = back[t][np.arange(n), out[t]]
        return out.T

    def gradient(self, chars: np.ndarray, tags: np.ndarray) -> dict:
        """Gradient of the mean negative log likelihood of the tags."""
        keep: list = []
        e = self.emissions(chars, keep)
        both, joined = keep.pop()
        size, n, _ = e.shape
        trans = self.w["t"]
        lse = lambda x, axis: (m := x.max(axis, keepdims=True)).squeeze(axis) + np.log(np.exp(x - m).sum(axis))
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[0] = e[0]
        for t in range(1, size):
            alpha[t] = lse(alpha[t - 1][:, :, None] + trans, 1) + e[t]
        for t in range(size - 2, -1, -1):
            beta[t] = lse(trans + (e[t + 1] + beta[t + 1])[:, None, :], 2)
        z = lse(alpha[-1], 1)
        de = np.exp(alpha + beta - z[None, :, None])
        rows = np.arange(n)
        g = {name: np.zeros_like(w) for name, w in self.w.items()}
        for t in range(size):
            de[t, rows, tags[:, t]] -= 1
            if t:
                pair = np.exp(alpha[t - 1][:, :, None] + trans + (e[t] + beta[t])[:, None, :] - z[:, None, None])
                g["t"] += pair.sum(0)
                np.subtract.at(g["t"], (tags[:, t - 1], tags[:, t]), 1)
        g["v"] = np.einsum("tnh,tnk->hk", joined, de)
        g["c"] = de.sum((0, 1))
        dh_all = de @ self.w["v"].T
        k = self.hidden
        dh_all = np.stack((dh_all[..., :k], dh_all[::-1][..., k:]))  # by direction and its own time
        dh, dc = np.zeros((2, n, k)), np.zeros((2, n, k))
        for t in range(size - 1, -1, -1):
            h, before, gates, new, tanh_c = keep[t]
            dh = dh + dh_all[:, t]
            i, f, o = gates[..., :k], gates[..., k:2 * k], gates[..., 2 * k:]
            dc = dc + dh * o * (1 - tanh_c ** 2)
            dz = np.concatenate((dc * new * i * (1 - i), dc * before * f * (1 - f), dh * tanh_c * o * (1 - o), dc * i * (1 - new ** 2)), axis=2)
            g["u"] += np.matmul(h.transpose(0, 2, 1), dz)
            for d in (0, 1):
                np.add.at(g["x"][d], both[d, :, t], dz[d])
            dh = np.matmul(dz, self.w["u"].transpose(0, 2, 1))
            dc = dc * f
        return {name: v / n for name, v in g.items()}


def train(windows: list[tuple[str, list[tuple[int, int, int]]]], seed: int = 1) -> Tagger | None:
    """Fit by Adam; None without any labelled span."""
    if not any(spans for _, spans in windows):
        return None
    chars, tags = (np.stack(x) for x in zip(*[_encode(text, spans) for text, spans in windows]))
    tagger, rng = Tagger(seed=seed), np.random.default_rng(seed)
    first, second = ({k: np.zeros_like(v) for k, v in tagger.w.items()} for _ in range(2))
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(chars))
        for at in range(0, len(order), BATCH):
            part = order[at:at + BATCH]
            step += 1
            rate = RATE * (1 - epoch / EPOCHS) * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
            for name, g in tagger.gradient(chars[part], tags[part]).items():
                g = np.clip(g, -5, 5)
                first[name] += 0.1 * (g - first[name])
                second[name] += 0.001 * (g * g - second[name])
                tagger.w[name] -= rate * first[name] / (np.sqrt(second[name]) + 1e-8)
    return tagger


def _encode(text: str, spans) -> tuple[np.ndarray, np.ndarray]:
    chars, tags = np.full(SIZE, CLASSES), np.zeros(SIZE, dtype=np.int64)
    chars[:len(text)] = char_classes(text[:SIZE])
    for kind, a, b in spans:
        tags[a:b] = 2 + 2 * kind
        tags[a] = 1 + 2 * kind
    return chars, tags


def windows_of(text: str) -> list[tuple[int, int]]:
    """(start, end) of overlapping windows around all digits and at signs."""
    out: list[tuple[int, int]] = []
    stretch = None
    for m in SIGNS.finditer(text):
        a, b = max(0, m.start() - MARGIN), min(len(text), m.end() + MARGIN)
        if stretch and a <= stretch[1]:
            stretch[1] = b
        else:
            if stretch:
                out += _cut(*stretch, len(text))
            stretch = [a, b]
    return out + _cut(*stretch, len(text)) if stretch else out


def _cut(a: int, b: int, n: int) -> list[tuple[int, int]]:
    starts = range(a, max(a + 1, b - SIZE + STRIDE), STRIDE)
    return [(s, min(n, s + SIZE)) for s in starts]


def tag_texts(tagger: Tagger, texts: list[str]) -> list[list[tuple[int, int, int]]]:
    """The tagger's spans of each text; windows of all texts are decoded together."""
    places = [(i, a, b) for i, text in enumerate(texts) for a, b in windows_of(text)]
    best: list[dict[int, tuple[int, int]]] = [{} for _ in texts]
    for at in range(0, len(places), 512):
        part = places[at:at + 512]
        chars = np.full((len(part), SIZE), CLASSES)
        for row, (i, a, b) in enumerate(part):
            chars[row, :b - a] = char_classes(texts[i][a:b])
        for (i, a, b), tags in zip(part, tagger.viterbi(chars)):
            own = best[i]
            for p in range(a, b):
                central = min(p - a, b - 1 - p) + (SIZE if a == 0 else 0)
                if p not in own or own[p][0] < central:
                    own[p] = (central, int(tags[p - a]))
    out = []
    for own in best:
        spans: list[tuple[int, int, int]] = []
        last, begin = None, False
        for p in sorted(own):
            tag = own[p][1]
            kind = (tag - 1) // 2
            if tag and not tag % 2 and last == (kind, p):
                spans[-1] = (kind, spans[-1][1], p + 1)
            elif tag:
                spans.append((kind, p, p + 1))
            last = (kind, p + 1) if tag else None
        out.append(spans)
    return out


def _sample(batches):
    """Windows with digits or at signs, and their rule spans if wholly inside."""
    for batch in batches:
        texts, spans = [], []
        for text in batch.column(0).to_pylist():
            found = base_spans(text or "")
            for a, b in windows_of(text or ""):
                texts.append(text[a:b])
                cut = [s for s in found if s[1] < b and a < s[2]]
                spans.append([[k, max(0, p - a), min(b, q) - a] for k, p, q in cut])
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(spans, pa.list_(pa.list_(pa.int32())))], names=["text", "spans"])


def training_windows(docs: DataFrame, most: int = MAX_WINDOWS) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """The ``most`` windows of the documents that come first by a hash of the
    window, half of them with spans; and as many made from their values."""
    found = docs.select("text").mapInArrow(_sample, "text string, spans array<array<int>>")
    found = stored(found.distinct(), "pii-windows")
    order = [F.xxhash64("text"), F.col("text")]
    has = F.size("spans") > 0
    rows = [r for part in (has, ~has) for r in found.where(part).orderBy(*order).limit(most // 2).collect()]
    real = [(r[0], [tuple(s) for s in r[1]]) for r in rows]
    values = [(k, text[a:b]) for text, spans in real for k, a, b in spans if plausible(k, text[a:b])]
    values += [(k, v[v.index("("):]) for k, v in values if k == 3 and "(" in v and plausible(k, v[v.index("("):])]
    contexts = [text for text, spans in real if not spans] or [text[:spans[0][1]] for text, spans in real if spans[0][1] > 8]
    if not values or not contexts:
        return real
    rng = np.random.default_rng(2)
    made = []
    for _ in range(len(real)):
        context = contexts[rng.integers(len(contexts))]
        at = int(rng.integers(0, 30))
        text, spans = context[:at].rstrip() + " ", []
        for _ in range(int(rng.integers(1, 3))):
            kind, value = values[rng.integers(len(values))]
            if len(text) + len(value) < SIZE - 1:
                spans.append((kind, len(text), len(text) + len(value)))
                text += value + (" " if rng.random() < 0.8 else ", ")
        made.append(((text + context[at:])[:SIZE], spans))
    return real + made


def _describe(shared):
    def rows(batches):
        tagger = shared.value
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            base = [base_spans(t) for t in texts]
            signed = [i for i, t in enumerate(texts) if SIGNS.search(t)] if tagger else []
            added: dict[int, list] = {}
            for at in range(0, len(signed), 256):
                part = signed[at:at + 256]
                for i, spans in zip(part, tag_texts(tagger, [texts[i] for i in part])):
                    added[i] = [(k, a, b) for k, a, b in spans if plausible(k, texts[i][a:b]) and not any(a < q and p < b for _, p, q in base[i])]
            out = {name: [] for name in (*KINDS, "sha", "spans")}
            for i, own in enumerate(base):
                for k, name in enumerate(KINDS):
                    out[name].append(sum(s[0] == k for s in own))
                joined = lambda spans: ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))
                out["sha"].append(hashlib.sha256(joined(own).encode()).hexdigest())
                out["spans"].append(joined(own + added.get(i, [])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(out[k], pa.int64()) for k in KINDS], pa.array(out["sha"], pa.string()), pa.array(out["spans"], pa.string())],
                names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])
    return rows


def find_pii(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    The counts and the digest are those of the rules; ``spans`` also has what the
    tagger adds. A null text counts as empty: no spans, the digest of the empty
    string. Without a tagger nothing is added. Repeated rows are handled alike;
    an empty table gives an empty result. Other columns are ignored.
    """
    shared = ship(docs.sparkSession).sparkContext.broadcast(tagger)  # a few thousand weights
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _describe(shared), f"doc_id {id_type}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def op10_pii(spark, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return find_pii(docs, train(training_windows(docs)))
