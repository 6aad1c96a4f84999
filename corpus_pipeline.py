"""The corpus pipeline: quality rules, near-duplicates, repeated passages, source mix, BPE ids.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
stage's ``docs``.  All stages but the last return the columns of ``documents``;
``n_chars`` keeps telling the length of the original text.

The training order is the order of the files that ``mixing_sources`` is written to, and of the rows in
them.  Spark's readers do not keep it, so the last stage takes each row's place from the
reader's metadata and returns it as ``position``.

Rows: null and empty texts fail the quality rules; rows without an id are no near-duplicates and lose no
passage; repeated rows are judged each, and copies of one id are one document to the near-duplicate stage (rows
of the kept id stay); an empty table gives empty stages; further columns, whatever their names, travel
along to the last stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arlark.llm import bpe_codec, minhash, mixing, quality, repeats
from arlark.llm.common import documents, staged

BYTE_BPE = "byte_bpe_50k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the base limits or the threshold table reject."""
    return quality.apply_rules(docs)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each group of near-duplicates."""
    return minhash.without_near_duplicates(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts out passages of 50 bytes or more that a document of smaller id holds too; all documents stay."""
    return repeats.trimmed_documents(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training sequence: each document as often as the mix takes it, range-sorted by training position."""
    return mixing.training_documents(docs)


def file_position() -> Column:
    """Grows along a table written in order: the number of a row's file, then its place in the file."""
    name = F.col("_metadata.file_name")
    part, cut = (F.coalesce(F.regexp_extract(name, p, 1).try_cast("long"), F.lit(0)) for p in (r"^part-(\d+)", r"-c(\d+)\."))
    return (part * (1 << 42) + cut * (1 << 32) + F.col("_metadata.row_index")).alias("position")


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, position, n_tokens, ids_sha256, decoded_sha256) for every copy of the training sequence, in any order;
    ``position`` grows along the sequence."""
    placed = docs.select(F.struct(F.col("doc_id"), file_position()).alias("copy"), "text")
    return bpe_codec.round_trip(placed, public_tokenizers.path(BYTE_BPE), id_col="copy").select(
        "copy.doc_id", "copy.position", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality_rules", quality_rules),
    ("minhash_near_dedup", minhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("mixing_sources", mixing_sources),
    ("bpe_encoding", bpe_encoding),
]

#: Near-duplicate search, suffix ordering and BPE cannot be written in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` table."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
