"""Table sinks: full-replace writes with observed row counts, lineage, snapshots, upserts.

Paths are plain directories (local, HDFS or object store).  A path that is
being read is never overwritten in place; published marts switch with one
appended row.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from arlark.plans.bucket_store import CODEC
from arlark.schemas import FEATURE_SCHEMA, INVOICE_SCHEMA, LINEAGE_SCHEMA


#: Text (one message a line) is an eighth of its size so; as many files as tasks wrote are read by as many tasks.
TEXT_CODEC = "gzip"


@contextmanager
def open_together(spark: SparkSession, files: int) -> Iterator[None]:
    """Tasks that write to folders by value keep so many files open, instead of sorting their rows by folder first."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    old = spark.conf.get(key, None)
    spark.conf.set(key, str(files))
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def write_messages(lines: DataFrame, path: str) -> None:
    """Message lines as compressed text files."""
    lines.write.option("compression", TEXT_CODEC).text(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None,
                fmt: str = "parquet", **options: str) -> int:
    """Write ``df`` and return its row count, counted while writing (``observe``), not by a second scan."""
    return write_observed(df, path, {}, mode, partition_by, fmt, **options)["rows"]


def write_observed(df: DataFrame, path: str, measures: dict[str, Column], mode: str = "overwrite",
                   partition_by: list[str] | None = None, fmt: str = "parquet", **options: str) -> dict:
    """Write ``df`` and return ``rows`` and the aggregate ``measures`` of its rows, all observed while writing."""
    obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
    seen = df.observe(obs, F.count(F.lit(1)).alias("rows"), *[c.alias(name) for name, c in measures.items()])
    writer = seen.write.mode(mode).format(fmt).options(**({"compression": CODEC} if fmt == "parquet" else {}) | options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return obs.get


def lineage_frame(spark: SparkSession, run_id: str, entries: list[tuple[str, str, int, str]]) -> DataFrame:
    """Lineage rows (run_id, recorded_at, source_name, target_table, row_count, transformation)."""
    now = dt.datetime.now(dt.timezone.utc).isoformat()
    rows = [(run_id, now, source, target, int(count), transformation)
            for source, target, count, transformation in entries]
    return spark.createDataFrame(rows, LINEAGE_SCHEMA)


def append_lineage(spark: SparkSession, path: str, run_id: str, entries: list[tuple[str, str, int, str]]) -> None:
    lineage_frame(spark, run_id, entries).coalesce(1).write.mode("append").parquet(path)


def read_lineage(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    df = spark.read.schema(LINEAGE_SCHEMA).parquet(path)
    return df if run_id is None else df.where(F.col("run_id") == run_id)


def write_feature_snapshot(features: DataFrame, path: str) -> int:
    """Point-in-time snapshot under ``as_of_date=YYYY-MM-DD/``; a rerun replaces only its own day."""
    return write_table(features, path, mode="overwrite", partition_by=["as_of_date"], partitionOverwriteMode="dynamic")


def read_feature_snapshot(spark: SparkSession, path: str, as_of=None) -> DataFrame:
    """Read snapshots with the partition column pinned to DATE; ``as_of`` prunes to one partition."""
    df = spark.read.schema(FEATURE_SCHEMA).option("basePath", path).parquet(path)
    if as_of is not None:
        if isinstance(as_of, str):
            as_of = dt.date.fromisoformat(as_of)
        df = df.where(F.col("as_of_date") == F.lit(as_of))
    return df.select(*[f.name for f in FEATURE_SCHEMA.fields])


UPSERT_KEYS = ["invoice_id", "source_system"]
UPSERT_UPDATED = ["customer_id", "due_date", "amount_usd", "status", "_loaded_at"]


def upsert_invoices(target: DataFrame, source: DataFrame, keys: list[str] = UPSERT_KEYS,
                    updated: list[str] = UPSERT_UPDATED) -> DataFrame:
    """MERGE semantics without a table format: match on ``keys``; matched rows take ``updated``
    columns from the source and keep the rest; unmatched source rows are inserted whole.

    One full outer join on the keys (both sides hash-partitioned once); the
    source must hold at most one row per key, as MERGE requires.
    """
    cols = [f.name for f in INVOICE_SCHEMA.fields]
    t = target.select(*cols, F.lit(True).alias("__t"))
    s = source.select(*[F.col(c).alias(f"__s_{c}") for c in cols], F.lit(True).alias("__s"))
    cond = [t[k].eqNullSafe(s[f"__s_{k}"]) for k in keys]
    j = t.join(s, cond, "full_outer")
    matched, src_only = F.col("__t").isNotNull() & F.col("__s").isNotNull(), F.col("__t").isNull()
    out = []
    for c in cols:
        if c in keys:
            out.append(F.coalesce(F.col(c), F.col(f"__s_{c}")).alias(c))
        elif c in updated:
            out.append(F.when(matched | src_only, F.col(f"__s_{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.when(src_only, F.col(f"__s_{c}")).otherwise(F.col(c)).alias(c))
    return j.select(*out)


def read_mart(spark: SparkSession, location: str) -> DataFrame:
    """A mart by location: a path (it has a ``/`` or ends in ``.parquet`` / ``.csv``), else a catalog table."""
    if location.endswith(".csv"):
        return spark.read.option("header", True).option("inferSchema", False).csv(location)
    if "/" in location or location.endswith(".parquet"):
        return spark.read.parquet(location)
    return spark.table(location)


def publish(spark: SparkSession, build_dir: str, published_dir: str, run_id: str, names: list[str]) -> None:
    """Publish the tables of ``build_dir`` together.

    Their copies go to a folder of this run; readers follow the last row of
    ``current``, appended last, so they see the run whole or not at all.
    """
    for name in names:
        write_table(spark.read.parquet(os.path.join(build_dir, name)), os.path.join(published_dir, "runs", run_id, name),
                    mode="errorifexists")
    row = spark.range(1).select(F.lit(run_id).alias("run_id"), F.current_timestamp().alias("published_at"))
    row.write.mode("append").parquet(os.path.join(published_dir, "current"))


def read_published(spark: SparkSession, published_dir: str, name: str) -> DataFrame:
    """A table of the run published last."""
    run_id = spark.read.parquet(os.path.join(published_dir, "current")).orderBy(F.desc("published_at")).first()["run_id"]
    return spark.read.parquet(os.path.join(published_dir, "runs", run_id, name))
