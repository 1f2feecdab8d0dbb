"""The corpus pipeline: five stages over ``documents``, each written and read again.

Quality rules, near-duplicate removal, benchmark decontamination, mixing of the
sources, sharding. Every stage works on all that the one before has kept. All but
the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retentio.llm import decontamination, jaccard_join, mixing, perplexity, sharding
from retentio.llm.common import stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
N_SHARDS = 40


def _numbered(docs: DataFrame) -> DataFrame:
    """The documents with a number of their own beside doc_id, because operators answer
    per doc_id: doc_id itself if no two rows share it and none is null, else a new
    number, stored with the rows."""
    docs = docs.select(*COLUMNS)
    odd = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 or doc_id is null")
    if not odd.limit(1).count():
        return docs.withColumn("_row", F.col("doc_id"))
    return stored(docs.withColumn("_row", F.monotonically_increasing_id()), "pipeline-docs")


def _keep(docs: DataFrame, rows: DataFrame) -> DataFrame:
    return docs.join(rows, "_row", "left_semi").select(*COLUMNS)


def _by_row(docs: DataFrame) -> DataFrame:
    return docs.drop("doc_id").withColumnRenamed("_row", "doc_id")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie within the bands of their language."""
    docs = _numbered(docs)
    return _keep(docs, perplexity.perplexity_rules(_by_row(docs)).where("kept").select(F.col("doc_id").alias("_row")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones: the one with the smallest doc_id."""
    docs = _numbered(docs)
    linked = jaccard_join.jaccard_components(_by_row(docs)).select(F.col("doc_id").alias("_row"), "component_id")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "_row")
    first = linked.join(docs.select("doc_id", "_row"), "_row").groupBy("component_id").agg(F.min(order).alias("one"))
    return _keep(docs, first.select(F.col("one._row").alias("_row")))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    docs = _numbered(docs)
    found = decontamination.scan_documents(_by_row(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _keep(docs, found.where("not contaminated").select(F.col("doc_id").alias("_row")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: a row per repetition. A document
    without words takes nothing from the mix's target and stays once."""
    docs = _numbered(docs)
    mixed = mixing.mix(docs.select(F.col("_row").alias("doc_id"), "text", "source"))
    times = mixed.select(F.col("doc_id").alias("_row"), F.coalesce(F.try_divide("taken", "size"), F.lit(1)).cast("int").alias("_times"))
    copies = F.explode(F.sequence(F.lit(1), F.col("_times")))
    return docs.join(times.where("_times > 0"), "_row").withColumn("_copy", copies).select(*COLUMNS)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row of the mix."""
    return sharding.shard_documents(docs, N_SHARDS)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing sources", mix_sources),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; what one returns is stored, and the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: The perplexity model has no form in SQL; tests hold the stages against brute force.
ORACLE_SQL = None
