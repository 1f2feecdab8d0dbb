"""Mixing sources to target weights: capped water-filling and seeded sampling.

The shares of all sources are proportional to their weights. A source whose
share is above ``max_epochs`` times its size is clamped there, and what it
leaves goes to the others by weight, until none is above. A document is then
repeated as often as its source's target holds the whole source, and the rest
of the target is filled with documents in a seeded order, class by class from
large to small ones: a class fills up to its share, counting what the classes
before it have taken, so that the sum ends within about half a small document of
the target.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.guards import broadcast_if_small
from .common import WORD, running, stored

MAX_EPOCHS = 3
SEED = "mix-1"
#: Size classes: documents above 1/4, 1/16, 1/64 and 1/256 of what their source has left to fill, and smaller ones.
PARTS = (4, 16, 64, 256)
#: Tables with a row per source are broadcast up to this size, and shuffled beyond.
MAX_SOURCES = 100_000


def water_fill(sources: DataFrame, max_epochs: int) -> DataFrame:
    """Add ``target`` (double) to ``sources`` (columns _size, _weight, one row per source).

    Only sums over the sources come to the driver. The level is a fraction of
    integers, so that clamping is exact; it rises from step to step, and each
    step clamps one source more at least, or is the last.
    """
    exact = "decimal(38,0)"
    cap = F.col("_size") * max_epochs
    total, weights = sources.agg(F.sum("_size"), F.sum("_weight")).first()
    num, den, n_clamped = total or 0, weights or 1, 0
    while True:
        above = F.col("_weight").cast(exact) * F.lit(num).cast(exact) > cap.cast(exact) * F.lit(den).cast(exact)
        clamped, used, free = sources.agg(
            F.count(F.when(above, 1)), F.sum(F.when(above, cap)), F.sum(F.when(~above, F.col("_weight")))).first()
        if clamped == n_clamped or not free:
            break
        n_clamped, num, den = clamped, total - used, free
    level = (F.col("_weight") * F.lit(num)).cast("double") / F.lit(float(den))
    return sources.withColumn("target", F.when(above, cap.cast("double")).otherwise(level))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken.

    Size is the number of words; a null text has none. Sources are ranked by
    code point, null last, and weigh ``weights`` in turn. Taken is a multiple
    of the document's size. The seeded order is by md5 of seed and doc_id, so
    reruns agree; documents that tie there are ordered by size, and equal rows
    are interchangeable. An empty table gives an empty result, a source
    without words a target of 0. Other columns are ignored.
    """
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    base = stored(docs.select("doc_id", "source", words.alias("size")), "mix-base")
    per_source = base.groupBy("source").agg(F.sum("size").alias("_size")).withColumn("_one", F.lit(1).cast("long"))
    ranked = running(per_source, [F.col("source").asc_nulls_last()], "_one", "_rank", "mix-sources")
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("_rank") - 1) % len(weights) + 1).cast("int"))
    sources = stored(ranked.withColumn("_weight", weight.cast("long")).drop("_one", "_rank"), "mix-weights")
    targets = stored(water_fill(sources, max_epochs), "mix-targets")

    shares = broadcast_if_small(targets.select(F.col("source").alias("_source"), F.col("_size").alias("source_size"), "target"), MAX_SOURCES)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    order_key = F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string")).cast("binary"))
    keyed = (base.join(shares, F.col("source").eqNullSafe(F.col("_source")))
             .withColumn("_epochs", epochs).withColumn("_rest", F.col("target") - F.col("_epochs") * F.col("source_size"))
             .withColumn("_class", sum((F.col("size") * part <= F.col("_rest")).cast("int") for part in PARTS)).withColumn("_order", order_key))
    in_order = [F.col("source").asc_nulls_last(), F.col("_class"), F.col("_order"), F.col("size")]
    summed = stored(running(keyed, in_order, "size", "_end", "mix-order"), "mix-sums")
    # where each size class of a source begins in the running sum, and its source's words up to its end
    parts = summed.groupBy("source", "_class").agg(F.sum("size").alias("_part"), F.max("_end").alias("_stop"), F.max("_rest").alias("_rest"),
                                                   F.max("source_size").alias("_all"))
    upto = F.sum("_part").over(Window.partitionBy("source").orderBy("_class"))  # len(PARTS) + 1 rows a source
    parts = stored(parts.select(F.col("source").alias("_of"), F.col("_class").alias("_kind"), (F.col("_stop") - F.col("_part")).alias("_start"),
                                (F.col("_rest") * F.coalesce(F.try_divide(upto, "_all"), F.lit(0.0))).alias("_goal")), "mix-parts")
    same = F.col("source").eqNullSafe(F.col("_of")) & (F.col("_class") == F.col("_kind"))
    middle = F.col("_end") - F.col("_start") - F.col("size") / 2
    so_far, goals = None, []
    for k in range(len(PARTS) + 1):  # what the classes of larger documents have taken is taken off
        goal = parts.where(F.col("_kind") == k)
        if so_far is not None:
            goal = goal.join(broadcast_if_small(so_far, MAX_SOURCES), F.col("_of").eqNullSafe(F.col("_by")), "left").withColumn(
                "_goal", F.col("_goal") - F.coalesce("_taken", F.lit(0))).drop("_by", "_taken")
        goals.append(stored(goal, "mix-goals"))
        took = summed.where(F.col("_class") == k).join(broadcast_if_small(goals[-1], MAX_SOURCES), same).where(middle <= F.col("_goal")).select("source", "size")
        if so_far is not None:
            took = took.union(so_far.select(F.col("_by").alias("source"), F.col("_taken").alias("size")))
        so_far = stored(took.groupBy(F.col("source").alias("_by")).agg(F.sum("size").alias("_taken")), "mix-taken")
    all_goals = goals[0]
    for g in goals[1:]:
        all_goals = all_goals.union(g)
    taken = (F.col("_epochs") + F.when(middle <= F.col("_goal"), 1).otherwise(0)) * F.col("size")
    return (summed.join(broadcast_if_small(all_goals, len(goals) * MAX_SOURCES), same)
            .select("doc_id", "source", "size", F.col("source_size").cast("long").alias("source_size"), "target",
                    taken.cast("long").alias("taken")))


def op8_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def mix_sql(documents: str = "documents") -> str:
    return f"""
WITH base AS (
  SELECT doc_id, source, text, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM {documents}
), src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS s, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
  FROM base GROUP BY source
), ordered AS (
  SELECT *, CAST(sum(3 * s) OVER o AS HUGEINT) - 3 * s AS cap_before, CAST(sum(w) OVER () - sum(w) OVER o + w AS HUGEINT) AS w_left,
         (SELECT CAST(sum(s) AS HUGEINT) FROM src) AS t
  FROM src WINDOW o AS (ORDER BY s / w, source NULLS LAST)
), flagged AS (
  SELECT *, w * (t - cap_before) > 3 * s * w_left AS clamped FROM ordered
), level AS (
  SELECT max(t) - coalesce(sum(3 * s) FILTER (clamped), 0) AS num, sum(w) FILTER (NOT clamped) AS den FROM flagged
), targets AS (
  SELECT source, s, CASE WHEN clamped THEN CAST(3 * s AS DOUBLE) ELSE CAST(w * num AS DOUBLE) / CAST(den AS DOUBLE) END AS target
  FROM flagged, level
), keyed AS (
  SELECT b.*, t.s, t.target, CASE WHEN t.s > 0 THEN floor(t.target / t.s) ELSE 0 END AS epochs,
         t.target - CASE WHEN t.s > 0 THEN floor(t.target / t.s) ELSE 0 END * t.s AS rest,
         {' + '.join(f'CAST(size * {part} <= rest AS INTEGER)' for part in PARTS)} AS class
  FROM base b JOIN targets t ON b.source IS NOT DISTINCT FROM t.source
), summed AS (
  SELECT *, sum(size) OVER (PARTITION BY source, class ORDER BY md5(concat('{SEED}:', doc_id)), size ROWS UNBOUNDED PRECEDING) - size / 2 AS middle,
         CASE WHEN s > 0 THEN rest * (sum(size) OVER (PARTITION BY source ORDER BY class) / s) ELSE 0 END AS share
  FROM keyed
){''.join(f"""
, step{k} AS (
  SELECT *, class = {k} AND middle <= share{f' - (taken{k - 1})' if k else ''} AS now{k},
         {f'taken{k - 1} + ' if k else ''}coalesce(sum(size) FILTER (class = {k} AND middle <= share{f' - (taken{k - 1})' if k else ''}) OVER (PARTITION BY source), 0) AS taken{k}
  FROM {f'step{k - 1}' if k else 'summed'}
)""" for k in range(len(PARTS) + 1))}
SELECT doc_id, source, size, s AS source_size, target,
       CAST((epochs + CASE WHEN {' OR '.join(f'now{k}' for k in range(len(PARTS) + 1))} THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM step{len(PARTS)}
"""


OP8_SQL = mix_sql()
