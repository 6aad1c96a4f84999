"""Shared helpers: input columns, shared-storage staging, files on shared storage, size-derived counts."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that separate words, everywhere in this package: space and tab to carriage return.
SPACE_CLASS = r"[\x20\x09-\x0D]"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ``documents`` table."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_uri(spark: SparkSession, tag: str) -> str:
    """A fresh path under ``spark.checkpoint.dir``, the folder that driver and executors share.

    The setting is read from the session.  Only a local master (tests) may run
    without it; a scratch folder is then set as the session's own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="corpus-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def staged(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written to shared storage and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_uri(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucket_count(rows: int, per_bucket: int, least: int = 1) -> int:
    """Buckets so that each holds about ``per_bucket`` rows; follows the input, without an upper limit."""
    return max(least, math.ceil(rows / per_bucket))


def shuffle_width(df: DataFrame, rows: int, per_task: int) -> int:
    """Partitions for a shuffle of ``rows`` rows: the session's number, more when tasks would exceed ``per_task``."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / per_task))


def byte_length(text: Column) -> Column:
    """UTF-8 bytes of a text (null: 0)."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


class SharedFiles:
    """Opens files on the storage behind a URI (local, HDFS or object store) from driver or executors."""

    def __init__(self, uri: str):
        from pyarrow import fs

        uri = "file://" + uri[len("file:"):] if uri.startswith("file:/") and not uri.startswith("file://") else uri
        if "://" not in uri:
            uri = "file://" + uri
        self.fs, self.root = fs.FileSystem.from_uri(uri)

    def make(self) -> None:
        self.fs.create_dir(self.root, recursive=True)

    def write(self, name: str):
        return self.fs.open_output_stream(f"{self.root}/{name}", compression=None)

    def read(self, name: str):
        return self.fs.open_input_file(f"{self.root}/{name}")

    def files(self, folder: str) -> list:
        """The files right in a folder (a full path); none if it does not exist."""
        from pyarrow import fs

        return [f for f in self.fs.get_file_info(fs.FileSelector(folder, allow_not_found=True)) if f.is_file]
