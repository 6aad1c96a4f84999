"""The registered queries of the corpus operators and their DuckDB text."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arlark.llm import (bpe_codec, collocations, embeddings, line_index, minhash, mixing, quality, repeats, sharding, token_count,
                        token_files, warc, whitening)
from arlark.llm.common import documents

BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(documents(spark, sf_dir))
    return mixing.in_training_order(mixed, "first_position", "doc_id").select(
        "doc_id", "size", "source_size", "target", "taken")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(documents(spark, sf_dir), public_tokenizers.path(BYTE_BPE))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return warc.page_records(warc.read_warc(warc.write_warc(pages), with_payload=False)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(documents(spark, sf_dir), shards=8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(documents(spark, sf_dir))


def op9_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.round_trip(documents(spark, sf_dir), public_tokenizers.path(BYTE_BPE))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = token_files.write_token_files(documents(spark, sf_dir), public_tokenizers.path(WORD_BPE), end_id=2)
    return token_files.read_token_digests(written)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    # beyond 64 bits there is no long to return
    return white.withColumn("deviation", F.col("deviation").try_cast("long"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_index.remove_repeated_lines(documents(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {
    "op1_minhash": op1_minhash,
    "op2_mixing": op2_mixing,
    "op3_quality_rules": op3_quality_rules,
    "op4_embeddings": op4_embeddings,
    "op5_token_counts": op5_token_counts,
    "op6_warc": op6_warc,
    "op7_sharding": op7_sharding,
    "op8_repeats": op8_repeats,
    "op9_bpe_codec": op9_bpe_codec,
    "op10_token_files": op10_token_files,
    "op11_collocations": op11_collocations,
    "op12_whitening": op12_whitening,
    "op13_line_dedup": op13_line_dedup,
}

#: SQL for the queries that whole tables in SQL can express; the others are held to brute force in tests/llm.
ORACLE = {
    "op1_minhash": minhash.oracle_sql(),
    "op4_embeddings": embeddings.oracle_sql(),
    "op6_warc": warc.oracle_sql(),
    "op2_mixing": mixing.oracle_sql(),
    "op3_quality_rules": quality.oracle_sql(),
    "op11_collocations": collocations.oracle_sql(),
    "op13_line_dedup": line_index.oracle_sql(),
}
