"""Keyed tables that change by batches: buckets of files behind a manifest.

A table is cut into buckets by hash of its keys.  A batch either adds files to the
buckets it touches (``append``) or replaces them (``rewrite``); other buckets are neither read nor written.  What
belongs to the table is told by its manifest, one small table for each version; a version
counts once its folder is complete, so readers see a batch whole or not at all, and files
of a writer that died are never read.  The manifest also holds the last batch of every source: a
batch that is delivered again changes nothing.  There is one writer at a time; a commit that finds a
newer version than the one it started from fails.  A bucket's part of a batch is written by one
task as one file, so the number of buckets is chosen for buckets of some hundred MB at most, and for
``rewrite`` well above the number of keys that a batch changes.

Layout under ``path``: ``data/attempt=<id>/_bucket=<n>/`` and ``manifest/version=<n>/``.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET = "_bucket"
#: A third smaller than the default; buckets are written once and read by many.
CODEC = "zstd"
MANIFEST = "kind string, bucket int, attempt string, base boolean, source string, batch long"


class Files:
    """Folders on the storage that a path names."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self._path, self._conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
        self._fs = self._path(path).getFileSystem(self._conf)

    def names(self, folder: str) -> list[str]:
        """Names in a folder; none if it does not exist."""
        at = self._path(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def size(self, file: str) -> int:
        """Bytes of a file, which may be named as a URI with escapes (as ``inputFiles`` does)."""
        uri = self._jvm.java.net.URI
        return self._fs.getFileStatus(self._path(uri(file) if ":" in file else file)).getLen()

    def complete(self, folder: str) -> bool:
        return self._fs.exists(self._path(os.path.join(folder, "_SUCCESS")))

    def remove(self, folder: str) -> None:
        self._fs.delete(self._path(folder), True)

    def move(self, folder: str, to: str) -> None:
        """The folder in place of ``to``, which may be on another storage; one that does not exist is an empty one."""
        conf = self._conf
        there = self._path(to).getFileSystem(conf)
        there.delete(self._path(to), True)
        there.mkdirs(self._path(to).getParent())
        if not self._fs.exists(self._path(folder)):
            there.mkdirs(self._path(to))
        elif there.getUri().equals(self._fs.getUri()):
            if not self._fs.rename(self._path(folder), self._path(to)):
                raise OSError(f"{folder} could not be moved to {to}")
        else:
            self._jvm.org.apache.hadoop.fs.FileUtil.copy(self._fs, self._path(folder), there, self._path(to), True, conf)


class BucketStore:
    """A table of ``schema`` in ``buckets`` buckets of its ``keys``."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int = 64):
        self.spark, self.path, self.schema, self.keys, self.buckets = spark, path, schema, list(keys), buckets
        self.files = Files(spark, path)

    def bucket(self) -> Column:
        """The bucket of a row; rows with a null key are in one, too."""
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(self.buckets)).cast("int")

    # ---- versions

    def _manifest(self, version: int) -> str:
        return os.path.join(self.path, "manifest", f"version={version}")

    def _versions(self) -> list[int]:
        return sorted(int(n.split("=")[1]) for n in self.files.names(os.path.join(self.path, "manifest")) if n.startswith("version="))

    def version(self) -> int:
        """The last complete version; 0 for a table without any."""
        return max((v for v in self._versions() if self.files.complete(self._manifest(v))), default=0)

    def entries(self, version: int | None = None) -> list:
        """Manifest rows: the live files by bucket in the order they were added, and the last batch of each source."""
        version = self.version() if version is None else version
        if not version:
            return []
        return self.spark.read.schema(MANIFEST + ", position int").parquet(self._manifest(version)).orderBy("position").collect()

    def last_batch(self, source: str) -> int:
        return max((e.batch for e in self.entries() if e.kind == "applied" and e.source == source), default=-1)

    def _commit(self, version: int, entries: list[tuple]) -> int:
        if self.version() != version:
            raise RuntimeError(f"{self.path}: version {version} was replaced by {self.version()} meanwhile")
        new = max(self._versions(), default=0) + 1
        rows = self.spark.createDataFrame([(*e, k) for k, e in enumerate(entries)], MANIFEST + ", position int")
        rows.coalesce(1).write.mode("errorifexists").parquet(self._manifest(new))
        return new

    # ---- reading

    def _paths(self, entries: list, buckets: Sequence[int] | None) -> list[str]:
        wanted = None if buckets is None else set(buckets)
        return [os.path.join(self.path, "data", f"attempt={e.attempt}", f"{BUCKET}={e.bucket}")
                for e in entries if e.kind == "file" and (wanted is None or e.bucket in wanted)]

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """The table's rows, or those of some buckets."""
        paths = self._paths(self.entries(), buckets)
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    # ---- writing

    def dealt(self, rows: DataFrame) -> DataFrame:
        """Rows with their ``_bucket``, those of a bucket in one task."""
        width = min(self.buckets, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        return rows.withColumn(BUCKET, self.bucket()).repartition(width, BUCKET)

    def stage(self, rows: DataFrame, as_they_lie: bool = False) -> tuple[DataFrame, str, list[int]]:
        """(rows as written, attempt, touched buckets): one folder for each bucket, visible to no reader yet.

        ``as_they_lie`` leaves out the deal, for rows that are dealt already or for files that are read once and never listed:
        a bucket then has a file for every task that holds some of it.
        """
        attempt = uuid.uuid4().hex
        folder = os.path.join(self.path, "data", f"attempt={attempt}")
        named = rows.select(*[f.name for f in self.schema.fields])
        named = named.withColumn(BUCKET, self.bucket()) if as_they_lie else self.dealt(named)
        named.write.partitionBy(BUCKET).option("compression", CODEC).parquet(folder)
        touched = [int(n.split("=")[1]) for n in self.files.names(folder) if n.startswith(f"{BUCKET}=")]
        paths = [os.path.join(folder, f"{BUCKET}={b}") for b in touched]
        stored = self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)
        return stored, attempt, touched

    def _applied(self, entries: list, source: str | None, batch: int) -> list[tuple]:
        kept = [tuple(e)[:6] for e in entries if e.kind == "applied" and e.source != source]
        return kept + ([("applied", None, None, None, source, batch)] if source is not None else [])

    def append(self, rows: DataFrame, source: str | None = None, batch: int = 0, as_they_lie: bool = False) -> int:
        """Adds rows to their buckets; returns the table's version.  A batch at or before the source's last one is skipped.

        ``as_they_lie``: the rows are dealt by bucket already (see ``dealt``).
        """
        version = self.version()
        entries = self.entries(version)
        if source is not None and any(e.kind == "applied" and e.source == source and e.batch >= batch for e in entries):
            return version
        _, attempt, touched = self.stage(rows, as_they_lie)
        old = [tuple(e)[:6] for e in entries if e.kind == "file"]
        new = [("file", b, attempt, False, None, None) for b in touched]
        return self._commit(version, old + new + self._applied(entries, source, batch))

    def rewrite(self, incoming: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], source: str | None = None,
                batch: int = 0, as_they_lie: bool = False) -> int:
        """Replaces the buckets that ``incoming`` touches by ``merge(their rows, incoming)``, which must keep rows in their buckets.

        ``as_they_lie``: ``merge`` returns rows that are dealt by bucket already.
        """
        version = self.version()
        entries = self.entries(version)
        if source is not None and any(e.kind == "applied" and e.source == source and e.batch >= batch for e in entries):
            return version
        stored, _, touched = self.stage(incoming, as_they_lie=True)
        return self._replace(version, entries, touched, merge(self.read(touched), stored), source, batch, as_they_lie)

    def _replace(self, version, entries, touched, rows, source=None, batch=0, as_they_lie=False) -> int:
        _, attempt, written = self.stage(rows, as_they_lie)
        if not set(written) <= set(touched):
            raise ValueError("the merged rows left their buckets")
        gone = set(touched)
        old = [tuple(e)[:6] for e in entries if e.kind == "file" and e.bucket not in gone]
        new = [("file", b, attempt, True, None, None) for b in written]
        applied = self._applied(entries, source, batch) if source is not None else [tuple(e)[:6] for e in entries if e.kind == "applied"]
        return self._commit(version, old + new + applied)

    def compact(self, merge: Callable[[DataFrame], DataFrame] | None = None, most_files: int = 8) -> int:
        """Replaces the files of every bucket with more than ``most_files`` by one, through ``merge`` if it is given."""
        version = self.version()
        entries = self.entries(version)
        number: dict[int, int] = {}
        for e in entries:
            if e.kind == "file":
                number[e.bucket] = number.get(e.bucket, 0) + 1
        full = [b for b, n in number.items() if n > most_files]
        if not full:
            return version
        rows = self.read(full)
        return self._replace(version, entries, full, merge(rows) if merge else rows)

    def vacuum(self, keep_versions: int = 2) -> int:
        """Removes data that none of the last ``keep_versions`` versions names, and older manifests; returns the folders removed.

        Not while a writer or a reader of an older version is at work.
        """
        complete = [v for v in self._versions() if self.files.complete(self._manifest(v))]
        kept = complete[-keep_versions:]
        live = {e.attempt for v in kept for e in self.entries(v) if e.kind == "file"}
        gone = [os.path.join(self.path, "data", n) for n in self.files.names(os.path.join(self.path, "data"))
                if n.startswith("attempt=") and n.split("=")[1] not in live]
        gone += [self._manifest(v) for v in self._versions() if v not in kept and (not kept or v < kept[-1])]
        for folder in gone:
            self.files.remove(folder)
        return len(gone)
