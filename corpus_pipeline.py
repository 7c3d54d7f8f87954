"""From raw documents to sharded training data, each stage stored before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from plumbline.llm import decontaminate, histogram_sort, mixing, parity_join, repetition
from plumbline.llm.tables import row_hash, stored, table

SHARDS = 24


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the repetition rules reject."""
    return repetition.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies stays, the one with the least id."""
    return parity_join.keep_one(docs, size=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts benchmark passages; drops a document if they make up half of its words.

    ``n_chars`` follows the text.
    """
    scanned = decontaminate.scan(docs, table(spark, sf_dir, "benchmark"))
    cleaned = decontaminate.clean(scanned)
    if "n_chars" not in docs.columns:
        return cleaned
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    changed = F.when(F.col("text").isNotNull(), length).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", changed).select(*docs.columns)


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Samples or repeats sources to their target weights."""
    return mixing.mix(docs, "source", mixing.n_words(F.col("text")))


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the shard and the slot in it, in hashed order; shards have near equal bytes."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 8
    placed = docs.withColumn("__cp_place", row_hash("doc_id", "text", seed=11))
    return histogram_sort.histogram_sort(placed, "__cp_place", size, SHARDS).drop("__cp_place")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing_weights),
    ("sharding", sharding),
]

# Mixing draws by hash, which SQL of another engine cannot repeat; the tests
# hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
