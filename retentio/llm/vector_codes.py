"""Vector code compression: product codes whose k-means skips work by norm-of-sum bounds.

A vector is cut into parts, and each part is coded by the nearest entry of its
position's codebook. A round of k-means assigns all parts and then moves the
entries. Most assignments cannot have changed, and bounds show it: a part keeps
an upper bound on the distance to its own entry and a lower bound on that to the
others, one for each of ``GROUPS`` groups of entries, each with the round in
which it was measured. All codebooks so far are kept, so a bound is corrected
by how far the entry has truly come since that round: the norm of the sum of
its moves, not the sum of their norms. Only where the corrected bounds meet are
distances of a group computed again, exactly and in whole numbers.

The state of all vectors is a stored table, read and written once a round; the
driver holds the codebooks alone, whose size does not depend on the data.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.guards import MAX_BROADCAST_ROWS
from .common import discard, ship, stored
from .vectors import as_long, matrix, squares, whole_vectors

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
GROUPS = 8
#: Parts that a label's rows are dealt into where labels are too many to broadcast.
SALTS = 64
_SLACK = 1e-9  # far above the rounding of the bounds, far below any gap between distances that differ


def _cuts(width: int, parts: int) -> list[slice]:
    """Equal consecutive parts; if ``parts`` does not divide ``width`` the first ones have one entry more."""
    edges = np.cumsum([0, *[len(x) for x in np.array_split(np.arange(width), parts)]])
    return [slice(int(a), int(b)) for a, b in zip(edges, edges[1:])]


def _distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole numbers: floats as long as they hold them, else Python's integers."""
    if not x.size or not entries.size:
        return np.zeros((len(x), len(entries)))
    largest = float(max(np.abs(x).max(), np.abs(entries).max()))
    if x.shape[1] * (2 * largest) ** 2 < 1 << 53:
        a, b = x.astype(float), entries.astype(float)
        return (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)
    return np.stack([squares(x - e) for e in entries], axis=1)


def _lengths(squared: np.ndarray) -> np.ndarray:
    return np.sqrt(squared.astype(float))


class Bounds:
    """The state of a batch for one part: code, upper and lower bounds, and their rounds."""

    def __init__(self, code, upper, upper_round, lower, lower_round):
        self.code, self.upper, self.upper_round, self.lower, self.lower_round = code, upper, upper_round, lower, lower_round

    @classmethod
    def unknown(cls, n: int, groups: int) -> Bounds:
        """Before the first round: nothing is known, so everything is measured."""
        zero = np.zeros(n, dtype=np.uint8)
        return cls(zero.astype(np.int64), np.full(n, np.inf), zero, np.zeros((n, groups)), np.zeros((n, groups), dtype=np.uint8))


class Codebook:
    """The codebooks of one part position, round by round, and how far entries have come."""

    def __init__(self, history: list[np.ndarray], groups: int):
        self.entries, self.now = history[-1], len(history) - 1
        self.groups = [g for g in np.array_split(np.arange(len(self.entries)), groups)]
        #: net displacement of each entry since each round, and the largest of each group
        self.moved = np.array([_lengths(squares(self.entries - old)) for old in history])
        self.group_moved = np.array([[m[g].max(initial=0) for g in self.groups] for m in self.moved])

    def assign(self, x: np.ndarray, old: Bounds) -> tuple[Bounds, int]:
        """Nearest entries (ties to the lower index), new bounds, and the number of distances computed."""
        n, now = len(x), self.now
        code, lower_round = old.code.copy(), old.lower_round.copy()
        upper = (old.upper + self.moved[old.upper_round, code]) * (1 + _SLACK)
        since = self.group_moved[old.lower_round, np.arange(len(self.groups))]
        lower = old.lower * (1 - _SLACK) - since * (1 + _SLACK)
        kept_upper, kept_round = old.upper.copy(), old.upper_round.copy()
        tight = np.flatnonzero((lower <= upper[:, None]).any(axis=1))
        own = squares(x[tight] - self.entries[code[tight]])  # the upper bound made exact
        computed = len(tight)
        upper[tight] = _lengths(own) * (1 + _SLACK)
        kept_upper[tight], kept_round[tight] = upper[tight], now
        again = lower[tight] <= upper[tight, None]
        best, best_code = np.array(own, dtype=object if own.dtype == object else float), code[tight].copy()
        first, second, first_code = {}, {}, {}
        for g, members in enumerate(self.groups):  # exact rescan of the groups whose bound does not hold
            at = np.flatnonzero(again[:, g])
            if not len(at) or not len(members):
                continue
            d = _distances(x[tight[at]], self.entries[members])
            computed += d.size
            low = d.argmin(axis=1)
            rows = np.arange(len(at))
            first[g], first_code[g] = d[rows, low], members[low]
            rest = d.astype(float)
            rest[rows, low] = np.inf
            second[g] = rest.min(axis=1)
            nearer = (first[g] < best[at]) | ((first[g] == best[at]) & (first_code[g] < best_code[at]))
            best[at[nearer]], best_code[at[nearer]] = first[g][nearer], first_code[g][nearer]
        left = np.flatnonzero(best_code != code[tight])  # the entry that a part leaves is one of the others now
        distance_left = _lengths(own[left]) * (1 - _SLACK)
        for g, members in enumerate(self.groups):
            if g in first:
                at = np.flatnonzero(again[:, g])
                other = np.where(first_code[g] == best_code[at], second[g], first[g].astype(float))
                lower[tight[at], g] = np.sqrt(other) * (1 - _SLACK)
                lower_round[tight[at], g] = now
            if len(left) and len(members):
                was = left[(code[tight[left]] >= members[0]) & (code[tight[left]] <= members[-1])]
                was = was[~again[was, g]]
                if len(was):
                    d = distance_left[np.searchsorted(left, was)]
                    lower[tight[was], g] = np.minimum(lower[tight[was], g], d)
                    lower_round[tight[was], g] = now
        code[tight] = best_code
        kept_upper[tight] = _lengths(best) * (1 + _SLACK)
        untouched = lower_round != now  # these bounds keep the round that they were measured in
        lower = np.where(untouched, old.lower, lower)
        return Bounds(code, kept_upper, kept_round, np.maximum(lower, 0), lower_round), computed


_STATE = "code binary, upper binary, upper_round binary, lower binary, lower_round binary, computed long"


def _down(values: np.ndarray) -> np.ndarray:
    small = values.astype(np.float32)
    return np.where(small.astype(float) > values, np.nextafter(small, np.float32(-np.inf)), small).astype(np.float32)


def _up(values: np.ndarray) -> np.ndarray:
    small = values.astype(np.float32)
    return np.where(small.astype(float) < values, np.nextafter(small, np.float32(np.inf)), small).astype(np.float32)


def _binary(rows: np.ndarray) -> pa.Array:
    rows = np.ascontiguousarray(rows)
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _read(column, dtype, shape) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=dtype).reshape(shape)


def _round(width, parts, groups, shared):
    """Assigns a batch anew; columns that are not the state's go through."""
    cuts = _cuts(width, parts)

    def rows(batches):
        books = [Codebook([book[p] for book in shared.value], groups) for p in range(parts)]
        started = len(shared.value) > 1
        for batch in batches:
            n = batch.num_rows
            x = matrix(batch.column("x"), width)
            if started:
                code, upper_round = (_read(batch.column(c), np.uint8, (n, parts)) for c in ("code", "upper_round"))
                upper, lower = _read(batch.column("upper"), np.float32, (n, parts)), _read(batch.column("lower"), np.float32, (n, parts, groups))
                lower_round = _read(batch.column("lower_round"), np.uint8, (n, parts, groups))
            found, computed = [], 0
            for p, cut in enumerate(cuts):
                old = (Bounds(code[:, p].astype(np.int64), upper[:, p].astype(float), upper_round[:, p], lower[:, p].astype(float), lower_round[:, p])
                       if started else Bounds.unknown(n, groups))
                state, k = books[p].assign(x[:, cut], old)
                found.append(state)
                computed += k
            of = lambda f: np.stack([f(s) for s in found], axis=1)
            done = np.zeros(n, dtype=np.int64)
            done[:1] = computed  # the batch's distances, in its first row
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("vec_id", "label", "x")]
                + [_binary(of(lambda s: s.code.astype(np.uint8))), _binary(of(lambda s: _up(s.upper))), _binary(of(lambda s: s.upper_round)),
                   _binary(of(lambda s: _down(s.lower))), _binary(of(lambda s: s.lower_round)), pa.array(done)],
                names=["vec_id", "label", "x", "code", "upper", "upper_round", "lower", "lower_round", "computed"])
    return rows


def _entry_sums(width, parts, entries):
    """(part, entry, n, sums) of a task's vectors; the sums as text, of any size."""
    cuts = _cuts(width, parts)

    def rows(batches):
        n = np.zeros((parts, entries), dtype=np.int64)
        sums = [np.zeros((entries, c.stop - c.start), dtype=object) for c in cuts]
        for batch in batches:
            if not batch.num_rows:
                continue
            x, code = matrix(batch.column("x"), width), _read(batch.column("code"), np.uint8, (batch.num_rows, parts))
            for p, cut in enumerate(cuts):
                n[p] += np.bincount(code[:, p], minlength=entries)
                part = np.zeros((entries, cut.stop - cut.start), dtype=np.int64)
                np.add.at(part, code[:, p], x[:, cut])  # entries keep within 2 ** 41, so a batch within a long
                sums[p] += part
        p, e = np.nonzero(n)
        if len(p):
            yield pa.RecordBatch.from_arrays(
                [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(n[p, e]), pa.array([[str(v) for v in sums[i][j]] for i, j in zip(p, e)], pa.list_(pa.string()))],
                names=["part", "entry", "n", "sums"])
    return rows


def _moved(state: DataFrame, book: list[np.ndarray], width: int) -> list[np.ndarray]:
    """The codebooks after a round: each entry is the floor of its parts' mean; unused ones stay."""
    parts, entries = len(book), len(book[0])
    longest = max(b.shape[1] for b in book)
    sums = state.select("x", "code").mapInArrow(_entry_sums(width, parts, entries), "part int, entry int, n long, sums array<string>")
    total = lambda i: F.sum(F.get("sums", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}")
    table = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[total(i) for i in range(longest)]).collect()  # parts x entries rows
    new = [b.copy() for b in book]
    for r in table:
        new[r.part][r.entry] = [int(r[f"s{i}"]) // r.n for i in range(new[r.part].shape[1])]
    return new


def _coded(width, parts, shared):
    """(vec_id, label, code, error) under the final codebooks."""
    cuts = _cuts(width, parts)

    def rows(batches):
        for batch in batches:
            x, code = matrix(batch.column("x"), width), _read(batch.column("code"), np.uint8, (batch.num_rows, parts))
            error = sum(squares(x[:, cut] - shared.value[p][code[:, p]]) for p, cut in enumerate(cuts)) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array([c.tobytes().hex() for c in code], pa.string()), pa.array(as_long(error), pa.int64())],
                names=["vec_id", "label", "code", "error"])
    return rows


def codebooks_text(book: list[np.ndarray]) -> str:
    return ",".join(str(int(v)) for part in book for entry in part for v in entry)


def _label_sums(coded: DataFrame, largest: int) -> DataFrame:
    """``coded`` with the sum of ``error`` over its label, nulls together."""
    sums = coded.groupBy("label").agg(F.when(F.count("error") == F.count("*"), F.try_sum("error")).alias("label_error"))
    if sums.limit(largest + 1).count() <= largest:
        small = F.broadcast(sums.withColumnRenamed("label", "_l"))  # checked
        return coded.join(small, F.col("label").eqNullSafe(F.col("_l"))).drop("_l")
    spread = sums.select(F.col("label").alias("_l"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_s"))
    salted = coded.withColumn("_salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
    return salted.join(spread, F.col("label").eqNullSafe(F.col("_l")) & (F.col("_salt") == F.col("_s"))).drop("_l", "_s", "_salt")


def fit_codes(rows: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
              groups: int = GROUPS) -> tuple[DataFrame, list[np.ndarray], list[int]]:
    """(state with the final codes, final codebooks, distances computed in each round) for
    ``rows`` (vec_id, label, x). The first codebooks are the rows of smallest vec_id."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    spark = ship(rows.sparkSession)
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "x").limit(entries).select("x").collect()
    start = np.array([r.x for r in first], dtype=np.int64).reshape(-1, width)
    history = [[start[:, c] for c in _cuts(width, parts)]]
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("vec_id", "label"))
    state, computed = rows.select("vec_id", "label", "x"), []
    for k in range(rounds + 1):
        step = _round(width, parts, groups, spark.sparkContext.broadcast(history))
        new = stored(state.mapInArrow(step, f"{kinds}, x array<long>, {_STATE}"), "codes-state")
        if k:
            discard(state)
        state = new
        computed.append(state.agg(F.sum("computed").alias("n")).first().n)
        if k < rounds:
            history.append(_moved(state, history[-1], width))
    return state, history[-1], computed


def vector_codes(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
                 largest: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """One row per kept vector: vec_id, code, error, label_error, codebooks_sha256.

    Vectors that are null, empty or hold null or non-finite entries are dropped, as
    are those of another length than most. Repeated rows are coded alike, each
    counts; with equal vec_ids the smaller vector starts first, null vec_ids start
    last. Fewer vectors than ``entries`` give as many entries. Ties go to the lower
    index. ``error`` and ``label_error`` are null where a long cannot hold them.
    Null labels are one label. An empty table gives an empty result. Other columns
    are ignored.
    """
    spark = ship(vectors.sparkSession)
    rows, width = whole_vectors(vectors.select("vec_id", "label", "embedding"), scale)
    kinds = ", ".join(f"{c} {vectors.schema[c].dataType.simpleString()}" for c in ("vec_id", "label"))
    if not width:
        return spark.createDataFrame([], f"vec_id {vectors.schema['vec_id'].dataType.simpleString()}, code string, error long, label_error long, codebooks_sha256 string")
    state, book, _ = fit_codes(rows, width, parts, entries, rounds)
    final = state.select("vec_id", "label", "x", "code").mapInArrow(_coded(width, parts, spark.sparkContext.broadcast(book)), f"{kinds}, code string, error long")
    coded = stored(final, "codes")
    discard(state)
    digest = hashlib.sha256(codebooks_text(book).encode()).hexdigest()
    return _label_sums(coded, largest).select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op12_vector_codes(spark, sf_dir: str) -> DataFrame:
    return vector_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same codes by comparing every part with every entry in every round."""
    ctes = [
        f"""kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) AS row, vec_id, label,
            list_transform(embedding, lambda c: CAST(floor({scale} * CAST(c AS DOUBLE)) AS BIGINT)) AS x
          FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0)""",
        f"""v AS MATERIALIZED (SELECT row, (pos - 1) // (len(x) // {parts}) AS part, (pos - 1) % (len(x) // {parts}) AS pos, x[pos] AS value
          FROM (SELECT row, x, unnest(range(1, len(x) + 1)) AS pos FROM kept))""",
        f"b0 AS MATERIALIZED (SELECT row - 1 AS entry, part, pos, value FROM v WHERE row <= {entries})",
    ]
    for k in range(rounds + 1):
        ctes.append(f"""a{k} AS MATERIALIZED (SELECT row, part, arg_min(entry, d * {entries} + entry) AS entry, min(d) AS d FROM (
            SELECT v.row, v.part, b.entry, CAST(sum((v.value - b.value) * (v.value - b.value)) AS BIGINT) AS d
            FROM v JOIN b{k} b ON v.part = b.part AND v.pos = b.pos GROUP BY ALL) GROUP BY row, part)""")
        if k < rounds:
            ctes.append(f"""m{k} AS MATERIALIZED (SELECT a.part, a.entry, v.pos, CAST(sum(v.value) AS BIGINT) AS total, count(*) AS n
              FROM a{k} a JOIN v ON v.row = a.row AND v.part = a.part GROUP BY ALL)""")
            ctes.append(f"""b{k + 1} AS MATERIALIZED (SELECT b.entry, b.part, b.pos,
                CASE WHEN m.n IS NULL THEN b.value ELSE (m.total - ((m.total % m.n) + m.n) % m.n) // m.n END AS value
              FROM b{k} b LEFT JOIN m{k} m ON m.part = b.part AND m.entry = b.entry AND m.pos = b.pos)""")
    ctes.append(f"""coded AS (SELECT k.vec_id, k.label, string_agg(printf('%02x', a.entry), '' ORDER BY a.part) AS code, CAST(sum(a.d) AS BIGINT) AS error
      FROM kept k JOIN a{rounds} a ON a.row = k.row GROUP BY k.row, k.vec_id, k.label)""")
    return f"""WITH {', '.join(ctes)}
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
      (SELECT sha256(string_agg(CAST(value AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM b{rounds}) AS codebooks_sha256
    FROM coded"""


OP12_SQL = _sql()
