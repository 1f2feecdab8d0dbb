"""Quality classifier: generalised additive model with pairwise interactions.

A document's log odds are a sum of one looked-up value per feature and one per
pair of features. The tables are learned by cyclic boosting: round after round
each feature in turn gets a shallow tree on its bins, fitted to the current
residuals and shrunk by the learning rate. Then the pairs that explain most of
what is left are boosted in the same way. Scoring bins the features of a batch
and adds up table entries.

The model is fitted on the driver on at most ``MAX_TRAIN`` labelled documents,
taken in the order of a hash of their id. Features come from the text alone.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

#: Labelled documents that the model is fitted on, at most.
MAX_TRAIN = 20_000
THRESHOLD = 0.3
BINS, PAIR_BINS, PAIRS = 32, 8, 10
ROUNDS, PAIR_ROUNDS, RATE, RIDGE = 150, 60, 0.1, 5.0
FOLDS = 5
FEATURES = ("log_words", "log_chars", "word_length", "symbols", "marked_words", "bangs", "capitals", "digits", "repeated_words",
            "echoes", "distinct_words", "repeated_lines", "bars", "full_stops", "line_words", "beyond_ascii", "entropy")
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#$%&*|<>{}[]\\^~=_")] = True
_UPPER, _DIGIT = (np.array([chr(b) in s for b in range(256)]) for s in ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"))
_MARKS = tuple(bytes([b]) for b in b"#$%&*!|")


def features(text: str | None) -> list[float]:
    """The features of one text; all 0 for an empty one."""
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        return [0.0] * len(FEATURES)
    n = len(words)
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    share = counts[counts > 0] / len(raw)
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
    repeated = 0
    if n > 3:
        k = len(numbers)
        _, which, seen = np.unique((ids[:-2] * k + ids[1:-1]) * k + ids[2:], return_inverse=True, return_counts=True)
        again = seen[which] > 1
        mask = np.zeros(n, dtype=bool)
        for j in range(3):
            mask[j:n - 2 + j] |= again
        repeated = mask.sum()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return [
        math.log1p(n), math.log1p(len(raw)), sum(map(len, words)) / n, counts[_SYMBOL].sum() / len(raw),
        sum(w.endswith(_MARKS) for w in words) / n, int(counts[33]) / n, counts[_UPPER].sum() / len(raw), counts[_DIGIT].sum() / len(raw),
        repeated / n, float((ids[1:] == ids[:-1]).mean()) if n > 1 else 0.0, len(numbers) / n, 1 - len(set(lines)) / len(lines),
        words.count(b"|") / n, int(counts[46]) / n, n / len(lines), counts[128:].sum() / len(raw), float(-(share * np.log2(share)).sum())]


class AdditiveModel:
    """Bin edges and tables of single features and of pairs."""

    def __init__(self, edges, base, single, pairs):
        self.edges, self.base, self.single, self.pairs = edges, base, single, pairs

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(self.edges)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 by table look-ups."""
        b = self.bins(x)
        total = np.full(len(x), self.base)
        for f, table in enumerate(self.single):
            total += table[b[:, f]]
        for (f, g), table in self.pairs.items():
            total += table[_coarse(b[:, f], self.edges[f]), _coarse(b[:, g], self.edges[g])]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _coarse(bins: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Bins of a feature in a pair table."""
    return bins * PAIR_BINS // (len(edges) + 1)


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """(gain, first bin of the right side) of the best cut of a row of bins."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    if not len(gl):
        return 0.0, 0
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl ** 2 / (hl + RIDGE) + gr ** 2 / (hr + RIDGE) - g.sum() ** 2 / (h.sum() + RIDGE)
    at = int(gain.argmax())
    return float(gain[at]), at + 1


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Values per bin of a tree of depth 2 on one feature."""
    _, cut = _best_cut(g, h)
    edges = [0, len(g)]
    if cut:
        _, left = _best_cut(g[:cut], h[:cut])
        _, right = _best_cut(g[cut:], h[cut:])
        edges = sorted({0, left, cut, cut + right, len(g)})
    out = np.zeros(len(g))
    for a, b in zip(edges, edges[1:]):
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """(gain, table) of a tree that cuts one feature, then the other on each side."""
    best = (-1.0, np.zeros_like(g))
    for turned in (False, True):
        a, b = (g.T, h.T) if turned else (g, h)
        for cut in range(1, len(a)):
            out, gain = np.zeros_like(a), -g.sum() ** 2 / (h.sum() + RIDGE)
            for side in (slice(0, cut), slice(cut, None)):
                gs, hs = a[side].sum(0), b[side].sum(0)
                _, at = _best_cut(gs, hs)
                for part in (slice(0, at), slice(at, None)):
                    p, q = gs[part].sum(), hs[part].sum()
                    out[side, part] = p / (q + RIDGE)
                    gain += p ** 2 / (q + RIDGE)
            if gain > best[0]:
                best = (gain, out.T if turned else out)
    return best


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Boost single features, then the strongest pairs; rounds end when the loss on
    a fifth of the rows no longer falls. Without both labels the score is constant."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) if len(x) else np.empty(0) for f in range(len(FEATURES))]
    share = (y.sum() + 1) / (len(y) + 2)
    base = math.log(share / (1 - share))
    model = AdditiveModel(edges, base, [np.zeros(len(e) + 1) for e in edges], {})
    if len(np.unique(y)) < 2:
        return model
    bins = model.bins(x)
    coarse = np.stack([_coarse(bins[:, f], e) for f, e in enumerate(edges)], axis=1)
    test = np.arange(len(y)) % FOLDS == 0
    train = ~test
    total = np.full(len(y), base)
    loss = lambda: float(np.mean(np.logaddexp(0, np.where(y[test] > 0, -total[test], total[test]))))

    def residuals():
        p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        return (y - p)[train], (p * (1 - p))[train]

    best, stale = loss(), 0
    for _ in range(ROUNDS):
        for f, table in enumerate(model.single):
            g, h = residuals()
            b = bins[train, f]
            step = RATE * _tree(np.bincount(b, g, len(table)), np.bincount(b, h, len(table)))
            table += step
            total += step[bins[:, f]]
        now = loss()
        best, stale = (now, 0) if now < best - 1e-6 else (best, stale + 1)
        if stale > 10:
            break

    def grids(f, k):
        g, h = residuals()
        cell = coarse[train, f] * PAIR_BINS + coarse[train, k]
        return (np.bincount(cell, v, PAIR_BINS ** 2).reshape(PAIR_BINS, PAIR_BINS) for v in (g, h))

    gains = [(_pair_tree(*grids(f, k))[0], f, k) for f in range(len(FEATURES)) for k in range(f)]
    for _, f, k in sorted(gains, reverse=True)[:PAIRS]:
        model.pairs[f, k] = np.zeros((PAIR_BINS, PAIR_BINS))
    best, stale = loss(), 0
    for _ in range(PAIR_ROUNDS):
        for (f, k), table in model.pairs.items():
            step = RATE * _pair_tree(*grids(f, k))[1]
            table += step
            total += step[coarse[:, f], coarse[:, k]]
        now = loss()
        best, stale = (now, 0) if now < best - 1e-6 else (best, stale + 1)
        if stale > 5:
            break
    return model


def held_out_of(doc_id) -> "F.Column":
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _feature_rows(batches):
    for batch in batches:
        x = [features(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], names=["label", "x"])


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> AdditiveModel:
    """Fit on labelled documents that are not held out: the ``max_train`` of them
    that come first by a hash of doc_id. Rows without a label are left out; of
    two labels of a document the larger counts."""
    chosen = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out_of(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max("quality").cast("int").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train))
    rows = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # max_train rows at most
            .select("label", "text").mapInArrow(_feature_rows, "label int, x array<double>").toArrow())
    y = rows.column("label").to_numpy().astype(np.float64)
    x = np.array(rows.column("x").to_pylist(), dtype=np.float64).reshape(len(y), len(FEATURES))
    order = np.lexsort((*x.T, y))  # the same model however the rows arrive
    order = order[np.random.default_rng(1).permutation(len(order))]
    return fit(x[order], y[order])


def classify(docs: DataFrame, model: AdditiveModel, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    A null text counts as empty and is scored like any other; a null doc_id is
    not held out. Equal texts get equal scores. An empty table gives an empty
    result. Other columns are ignored.
    """
    spark = ship(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)

    def rows(batches):
        for batch in batches:
            x = np.array([features(t) for t in batch.column(2).to_pylist()], dtype=np.float64).reshape(batch.num_rows, len(FEATURES))
            score = shared.value.score(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                                             names=["doc_id", "held_out", "score", "predicted"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held_out_of(F.col("doc_id")).alias("held_out"), "text").mapInArrow(
        rows, f"doc_id {id_type}, held_out boolean, score double, predicted int")


def op1_quality_gam(spark, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return classify(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
