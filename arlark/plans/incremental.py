"""Incremental forms of first-wins, running counts, upsert and latest-per-key over a ``BucketStore``.

The cost of a batch follows the batch and the buckets it touches:

* ``add_firsts``: ids that the table lacks are added; only the key columns of the touched buckets
  are read, nothing stored is rewritten, and reading the table needs no ranking.
* ``add_touch_counts``: a batch adds its partial counts; every ``COMPACT_AFTER`` batches a bucket's partials become one.
* ``upsert``: matched rows take the listed columns, others are inserted; touched buckets are rewritten.
* ``merge_latest``: the latest load of each key; touched buckets are rewritten, and loading a batch twice changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arlark.operators.dedupe import keep_first, keep_latest
from arlark.operators.matching import touches_per_invoice
from arlark.plans.bucket_store import BUCKET, BucketStore
from arlark.plans.sinks import UPSERT_KEYS, UPSERT_UPDATED, upsert_invoices
from arlark.schemas import COLLECTION_EVENT_TYPES, INVOICE_SCHEMA, PAYMENT_SCHEMA, TS

#: Files of a bucket above which a batch compacts it.
COMPACT_AFTER = 8
FIRST_ORDER = ("_loaded_at", "_source_event", "amount_usd")


def _same_keys(a: DataFrame, b: DataFrame, keys: Sequence[str]):
    same = [a[k].eqNullSafe(b[k]) for k in keys]
    out = same[0]
    for s in same[1:]:
        out &= s
    return out


def payment_store(spark: SparkSession, path: str, buckets: int = 64) -> BucketStore:
    return BucketStore(spark, path, PAYMENT_SCHEMA, ["payment_id"], buckets)


def invoice_store(spark: SparkSession, path: str, buckets: int = 64) -> BucketStore:
    return BucketStore(spark, path, INVOICE_SCHEMA, UPSERT_KEYS, buckets)


TOUCH_SCHEMA = T.StructType([T.StructField("invoice_id", T.StringType()), T.StructField("collection_attempt_count", T.LongType()),
                             T.StructField("last_outreach_at", TS)])


def touch_store(spark: SparkSession, path: str, buckets: int = 64) -> BucketStore:
    return BucketStore(spark, path, TOUCH_SCHEMA, ["invoice_id"], buckets)


def add_firsts(store: BucketStore, batch: DataFrame, source: str | None = None, number: int = 0,
               order: Sequence[str] = FIRST_ORDER) -> int:
    """Adds the first row (by ``order``) of every key that the table does not hold yet; returns the version."""
    if source is not None and store.last_batch(source) >= number:
        return store.version()
    # staged once: its folders name the touched buckets, and the batch is not computed twice
    firsts, _, touched = store.stage(keep_first(batch, store.keys, order), as_they_lie=True)
    firsts, known = store.dealt(firsts), store.dealt(store.read(touched).select(*store.keys))
    # joined where the buckets lie, and written from there: a batch moves once for this
    same = _same_keys(firsts, known, store.keys) & (firsts[BUCKET] == known[BUCKET])
    return store.append(firsts.join(known, same, "left_anti"), source, number, as_they_lie=True)


def add_touch_counts(store: BucketStore, batch: DataFrame, source: str | None = None, number: int = 0,
                     event_types: Sequence[str] | None = COLLECTION_EVENT_TYPES) -> int:
    """Adds the batch's (count, last outreach) for each invoice, then compacts buckets with many files."""
    partial = touches_per_invoice(batch.withColumn("event_type", F.lower("event_type")), event_types)
    store.append(partial.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TOUCH_SCHEMA.fields]), source, number)
    return store.compact(sum_touches, COMPACT_AFTER)


def sum_touches(partials: DataFrame) -> DataFrame:
    return partials.groupBy("invoice_id").agg(F.sum("collection_attempt_count").alias("collection_attempt_count"),
                                              F.max("last_outreach_at").alias("last_outreach_at"))


def touch_counts(store: BucketStore) -> DataFrame:
    """Touch count and last outreach per invoice: at most ``COMPACT_AFTER`` partials of each are added up."""
    return sum_touches(store.read())


def upsert(store: BucketStore, changes: DataFrame, source: str | None = None, number: int = 0,
           updated: Sequence[str] = UPSERT_UPDATED) -> int:
    """MERGE of ``changes`` (at most one row for each key) into the table; returns the version."""
    return store.rewrite(changes, lambda rows, new: upsert_invoices(rows, new, store.keys, list(updated)), source, number)


def merge_latest(store: BucketStore, loads: DataFrame, source: str | None = None, number: int = 0, loaded_at: str = "_loaded_at",
                 tiebreak: Sequence[str] = ()) -> int:
    """The latest row of each key over the table and ``loads``; returns the version."""
    newest = keep_latest(loads, store.keys, loaded_at, tiebreak)

    def latest(rows: DataFrame, new: DataFrame) -> DataFrame:
        # at most two rows of a key are left: ranked within their buckets, where they are written
        return keep_latest(store.dealt(rows.unionByName(new)), [BUCKET, *store.keys], loaded_at, tiebreak)

    return store.rewrite(newest, latest, source, number, as_they_lie=True)
