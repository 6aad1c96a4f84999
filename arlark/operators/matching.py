"""Payment-to-invoice matching and touch counts (pre-aggregated before any join)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arlark.schemas import COLLECTION_EVENT_TYPES, MONEY
from arlark.session import unique_dir


def matched_payments(payments: DataFrame, loaded_at: str = "loaded_at") -> DataFrame:
    """Per (invoice, customer): count, first/last date, amount, last load, ordered id list.

    A hash aggregate with a map-side partial step.  The id list of one invoice
    is one value, so it does land in one task; callers that do not select it do not pay for it, and
    ``payment_id_chunks`` gives it in pieces.
    """
    return payments.where(F.col("invoice_id").isNotNull()).groupBy("invoice_id", "customer_id").agg(
        F.count(F.lit(1)).alias("payment_count"),
        F.min("payment_date").alias("first_payment_date"),
        F.max("payment_date").alias("last_payment_date"),
        F.sum("amount_usd").cast(MONEY).alias("amount_paid_usd"),
        F.max(loaded_at).alias("last_payment_loaded_at"),
        F.expr("listagg(payment_id, ',') WITHIN GROUP "
               "(ORDER BY payment_date ASC NULLS LAST, payment_id ASC NULLS LAST)").alias("payment_ids"),
    )


def payment_id_chunks(payments: DataFrame, chunk: int = 10_000, partitions: int | None = None) -> DataFrame:
    """The id lists of ``matched_payments`` in pieces: (invoice_id, customer_id, chunk, payment_count, payment_ids).

    Chunk k holds the payments k * ``chunk`` + 1 to (k + 1) * ``chunk`` of an invoice by date and id, so no value and
    no task holds all payments of a hot invoice.  Payments are dealt by range of (invoice, customer, date, id), which
    cuts a hot invoice over partitions; a row's rank is its place within the partition plus what
    earlier partitions hold of the invoice.  ``payments`` is written once: ranges are drawn from a sample and may
    differ between two evaluations.
    """
    spark = payments.sparkSession
    key, order = ["invoice_id", "customer_id"], ["payment_date", "payment_id"]
    matched = payments.where(F.col("invoice_id").isNotNull()).select(*key, *order)
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = unique_dir(spark, "payment-ranges")
    ordered = [F.col(k).asc_nulls_last() for k in order]
    matched.repartitionByRange(parts, *[F.col(k) for k in key], *ordered).withColumn("part", F.spark_partition_id()).write.parquet(path)
    ranged = spark.read.schema(f"{matched._jdf.schema().toDDL()}, part int").parquet(path)
    sizes = ranged.groupBy(*key, "part").agg(F.count(F.lit(1)).alias("size"))
    earlier = Window.partitionBy(*key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)      # a row for each partition of an invoice
    offsets = sizes.select(*key, "part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy(*key, "part").orderBy(*ordered))
    ranked = ranged.withColumn("inside", inside)
    same = [ranked[k].eqNullSafe(offsets[k]) for k in (*key, "part")]
    placed = ranked.join(offsets, same[0] & same[1] & same[2]).select(
        *[ranked[k] for k in (*key, *order)], F.floor((F.col("offset") + F.col("inside") - 1) / chunk).cast("long").alias("chunk"))
    return placed.groupBy(*key, "chunk").agg(
        F.count(F.lit(1)).alias("payment_count"),
        F.expr("listagg(payment_id, ',') WITHIN GROUP (ORDER BY payment_date ASC NULLS LAST, payment_id ASC NULLS LAST)").alias("payment_ids"))


def unapplied_cash(payments: DataFrame) -> DataFrame:
    """Cash received without an invoice, per customer."""
    return (
        payments.where(F.col("invoice_id").isNull())
        .groupBy("customer_id")
        .agg(F.sum("amount_usd").cast(MONEY).alias("unapplied_cash_usd"))
    )


def payment_matching(payments: DataFrame, loaded_at: str = "loaded_at") -> DataFrame:
    """Matched payments with the customer's unapplied cash attached.

    The matched side drives the join: a customer whose payments are all
    unapplied does not appear, and the unapplied amount repeats on every
    matched invoice of the customer (never sum it over invoices).  The unapplied side is
    grouped by the join key alone, so Spark knows it is unique and drops
    the join where the amount is not used.  ``payments`` is read twice: pass a
    written table where it is costly to derive.
    """
    return (
        matched_payments(payments, loaded_at).join(unapplied_cash(payments), "customer_id", "left")
        .select(
            "invoice_id", "customer_id", "payment_count", "first_payment_date",
            "last_payment_date", "amount_paid_usd", "last_payment_loaded_at", "payment_ids",
            F.coalesce(F.col("unapplied_cash_usd"), F.lit(0).cast(MONEY)).alias("customer_unapplied_cash_usd"),
        )
    )


def touches_per_invoice(events: DataFrame, event_types: Sequence[str] | None = COLLECTION_EVENT_TYPES) -> DataFrame:
    """Collection touches per invoice: count and last time.  ``event_types=None`` counts every event."""
    if event_types is not None:
        events = events.where(F.col("event_type").isin(list(event_types)))
    return events.groupBy("invoice_id").agg(
        F.count(F.lit(1)).alias("collection_attempt_count"),
        F.max("occurred_at").alias("last_outreach_at"),
    )
