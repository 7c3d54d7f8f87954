"""The operators over the whole test tables, one query each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from plumbline.llm import (
    backoff,
    byte_bpe,
    decontaminate,
    disclosure,
    histogram_sort,
    importance,
    lexical_search,
    licences,
    mixing,
    parity_join,
    repetition,
    run_length_dedup,
    secret_scan,
)
from plumbline.llm.tables import row_hash, stored, table


def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    narrow = stored(
        docs.select(
            "doc_id", "source", mixing.n_words(F.col("text")).alias("size"), row_hash("doc_id", "text").alias("key")
        ),
        "mix-documents",
    )
    return mixing.mix_report(narrow, "source", F.col("size")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies", "shards"
    )


def op2_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return decontaminate.report(decontaminate.scan(docs, table(spark, folder, "benchmark")))


def op3_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return secret_scan.scan(docs, path="source")


def op4_run_length_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return run_length_dedup.remove_repeats(docs, keep_bytes=False)


def op5_repetition(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return repetition.assess(docs).drop("text", "longest_repeat")


def op6_backoff_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Trigrams and their backoff, the setting for production."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return backoff.score(docs, order=3).withColumn("score", F.round("score", 6))


def op6_backoff_scores_order2(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return backoff.score(docs, order=2).withColumn("score", F.round("score", 6))


def op7_disclosure(spark: SparkSession, folder: str) -> DataFrame:
    return disclosure.sanitise(table(spark, folder, "documents"), everywhere=True).drop("sanitised")


def op8_licences(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return licences.scan(docs).drop("text")


def op9_parity_join(spark: SparkSession, folder: str) -> DataFrame:
    return parity_join.similar(table(spark, folder, "documents"))


def op10_histogram_sort(spark: SparkSession, folder: str) -> DataFrame:
    narrow = table(spark, folder, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("bigint").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
    )
    dealt = histogram_sort.histogram_sort(narrow, "doc_id", F.col("size"), 24)
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return lexical_search.search(docs, table(spark, folder, "benchmark"))


def op12_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = table(spark, folder, "documents").select("doc_id", "text")
    tokens = byte_bpe.encode(docs, ranks, packed_ids=True, keep_text=False)
    return byte_bpe.decode(tokens, ranks).select(
        "doc_id",
        F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_importance(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = importance.score(docs, table(spark, folder, "benchmark"), keep=["doc_id"])
    return importance.resample(scored).select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_decontaminate": op2_decontaminate,
    "op3_secret_scan": op3_secret_scan,
    "op4_run_length_dedup": op4_run_length_dedup,
    "op5_repetition": op5_repetition,
    "op6_backoff_scores": op6_backoff_scores,
    "op6_backoff_scores_order2": op6_backoff_scores_order2,
    "op7_disclosure": op7_disclosure,
    "op8_licences": op8_licences,
    "op9_parity_join": op9_parity_join,
    "op10_histogram_sort": op10_histogram_sort,
    "op11_lexical_search": op11_lexical_search,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_importance": op13_importance,
}
