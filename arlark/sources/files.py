"""File sources: ERP CSV exports, JSON-array payment / event files, JSON message values.

Schemas are always explicit (all text for CSV exports).  A missing source
file is an empty DataFrame with the right schema, not an error.
"""

from __future__ import annotations

import csv
import os
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arlark.operators.normalize import CORRUPT, with_corrupt
from arlark.schemas import erp_source_schema


def _paths(spark: SparkSession, path: str) -> list[str]:
    """The files behind a path, folder or glob on whatever storage it names; none if it does not exist.

    Listed by Spark's file source, so local, HDFS and object-store paths (with or without a scheme) behave alike.
    """
    try:
        files = spark.read.format("binaryFile").load(path).inputFiles()
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return []
        raise
    return sorted(unquote(f) for f in files)


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def with_input_order(df: DataFrame, name: str = "_input_seq") -> DataFrame:
    """File path and a per-row sequence, an explicit input order for first-wins dedupe."""
    return df.withColumn("_source_file", F.col("_metadata.file_path")).withColumn(
        name, F.monotonically_increasing_id())


#: Files up to which each header is read by a small job of its own (of the first bytes only).
FEW_FILES = 8


def _by_header(spark: SparkSession, files: list[str]) -> dict[tuple, list[str]]:
    """Files by their header's column names; a name that a header holds twice is an error.

    Many files are one job: the first line of every file, grouped by its text.
    """
    filled = F.trim("value") != ""
    if len(files) <= FEW_FILES:
        headers = [(r.value, file) for file in files for r in spark.read.text(file).where(filled).limit(1).collect()]
    else:
        lines = spark.read.text(files).where(filled & (F.col("_metadata.file_block_start") == 0)).select(
            F.col("_metadata.file_path").alias("file"), "value", F.monotonically_increasing_id().alias("at"))
        first = lines.groupBy("file").agg(F.min_by("value", "at").alias("header"))
        grouped = first.groupBy("header").agg(F.collect_list("file").alias("files")).collect()      # the file names, listed already
        headers = [(r.header, unquote(file)) for r in grouped for file in sorted(r.files)]
    groups: dict[tuple, list[str]] = {}
    for header, file in headers:
        names = tuple(next(csv.reader([header.removeprefix("\ufeff")])))
        twice = sorted({n for n in names if names.count(n) > 1})
        if twice:
            raise ValueError(f"{file}: the header names {', '.join(twice)} more than once")
        groups.setdefault(names, []).append(file)
    return groups


def read_erp_csv(spark: SparkSession, path: str, source_system: str, multiline: bool = False) -> DataFrame:
    """ERP export with header rows, columns matched by header name in every file, every value text.

    Standard CSV quoting: a quote inside a quoted field is doubled.  Quoted
    line breaks need ``multiline``, which makes a file unsplittable, so it is the caller's
    choice.  Files are grouped by header line (one job for many files, see ``_by_header``) and
    each group is read with its own; extra columns are left out, columns a file lacks are NULL; a
    name that a header holds twice is an error.
    """
    schema = erp_source_schema(source_system)
    names = [f.name for f in schema.fields]
    files = _paths(spark, path)
    if not files:
        return _empty(spark, T.StructType(schema.fields + [T.StructField("_source_file", T.StringType()),
                                                           T.StructField("_input_seq", T.LongType())]))
    reader = spark.read.option("header", True).option("inferSchema", False).option("encoding", "UTF-8").option(
        "quote", '"').option("escape", '"').option("multiLine", multiline)
    groups = _by_header(spark, files)
    parts = []
    for columns, members in groups.items():
        df = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns])).csv(members)
        parts.append(df.select(*[F.col(f"`{n}`") if n in columns else F.lit(None).cast("string").alias(n) for n in names],
                               F.col("_metadata.file_path").alias("_source_file")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumn("_input_seq", F.monotonically_increasing_id())


def read_json_records(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = True,
                      payload: str = "payload") -> DataFrame:
    """JSON file(s) holding an array of objects (or JSON lines) -> one ``payload`` struct per record.

    What cannot be parsed (a file, or a line of JSON lines) is one record with its text in the payload's ``_corrupt_record``.
    """
    schema = with_corrupt(schema)
    if not _paths(spark, path):
        return spark.createDataFrame([], T.StructType([T.StructField(payload, schema),
                                                        T.StructField("_source_file", T.StringType()),
                                                        T.StructField("_input_seq", T.LongType())]))
    df = spark.read.option("multiLine", multiline).option("columnNameOfCorruptRecord", CORRUPT).schema(schema).json(path)
    cols = [F.col(c) for c in df.columns]
    return with_input_order(df).select(F.struct(*cols).alias(payload), "_source_file", "_input_seq")


def list_sample_files(sample_dir: str) -> dict[str, str]:
    """Conventional layout of a sample drop: erp/<source>_invoices.csv, payments/*.json, product_events/*.json."""
    return {
        "netsuite": os.path.join(sample_dir, "erp", "netsuite_invoices.csv"),
        "quickbooks": os.path.join(sample_dir, "erp", "quickbooks_invoices.csv"),
        "sap": os.path.join(sample_dir, "erp", "sap_invoices.csv"),
        "payments": os.path.join(sample_dir, "payments", "*.json"),
        "product_events": os.path.join(sample_dir, "product_events", "*.json"),
    }
