"""Staging models: typed, case-folded, latest row per key.

The partition keys of the dedupe are the raw, unfolded columns, so
``'NetSuite'`` and ``'netsuite'`` rows are distinct keys -- as in the
warehouse models.  Equal load times are settled by a fixed tie-break so the
result is deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arlark.functions.aging import days_outstanding
from arlark.functions.cleaning import blank_to_null
from arlark.operators.dedupe import keep_latest
from arlark.schemas import MONEY, TS

INVOICE_TIEBREAK = ("_source_file", "amount_usd", "status")
PAYMENT_TIEBREAK = ("_source_event", "amount_usd")
EVENT_TIEBREAK = ("_source_event",)


def stg_erp_invoices(raw: DataFrame, as_of=None) -> DataFrame:
    return invoice_columns(keep_latest(raw, ["invoice_id", "source_system"], tiebreak=INVOICE_TIEBREAK), as_of)


def invoice_columns(latest: DataFrame, as_of=None) -> DataFrame:
    """The staging columns of raw invoices that hold one row for each key."""
    return latest.select(
        F.col("invoice_id").cast("string").alias("invoice_id"),
        F.col("customer_id").cast("string").alias("customer_id"),
        blank_to_null(F.col("customer_name").cast("string")).alias("customer_name"),
        F.col("invoice_date").cast("date").alias("invoice_date"),
        F.col("due_date").cast("date").alias("due_date"),
        F.col("amount_usd").cast(MONEY).alias("amount_usd"),
        F.upper(F.col("currency").cast("string")).alias("currency"),
        F.upper(F.col("status").cast("string")).alias("status"),
        F.lower(F.col("source_system").cast("string")).alias("source_system"),
        blank_to_null(F.col("po_number").cast("string")).alias("po_number"),
        F.col("line_items").cast("int").alias("line_items"),
        days_outstanding(F.col("invoice_date").cast("date"), as_of).alias("days_outstanding"),
        F.col("_loaded_at").cast(TS).alias("loaded_at"),
        blank_to_null(F.col("_source_file").cast("string")).alias("source_file"),
    )


def stg_payments(raw: DataFrame) -> DataFrame:
    return payment_columns(keep_latest(raw, ["payment_id"], tiebreak=PAYMENT_TIEBREAK))


def payment_columns(latest: DataFrame) -> DataFrame:
    """The staging columns of raw payments that hold one row for each key."""
    return latest.select(
        F.col("payment_id").cast("string").alias("payment_id"),
        F.col("invoice_id").cast("string").alias("invoice_id"),
        F.col("customer_id").cast("string").alias("customer_id"),
        F.col("payment_date").cast("date").alias("payment_date"),
        F.col("amount_usd").cast(MONEY).alias("amount_usd"),
        F.upper(F.col("currency").cast("string")).alias("currency"),
        F.lower(F.col("payment_method").cast("string")).alias("payment_method"),
        F.lower(F.col("processor").cast("string")).alias("processor"),
        F.col("is_partial").cast("boolean").alias("is_partial"),
        blank_to_null(F.col("reference_number").cast("string")).alias("reference_number"),
        blank_to_null(F.col("notes").cast("string")).alias("notes"),
        F.col("_loaded_at").cast(TS).alias("loaded_at"),
        blank_to_null(F.col("_source_event").cast("string")).alias("source_event"),
    )


def stg_product_events(raw: DataFrame) -> DataFrame:
    return event_columns(keep_latest(raw, ["event_id"], tiebreak=EVENT_TIEBREAK))


def event_columns(latest: DataFrame) -> DataFrame:
    """The staging columns of raw events that hold one row for each key."""
    return latest.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("invoice_id").cast("string").alias("invoice_id"),
        F.col("customer_id").cast("string").alias("customer_id"),
        F.lower(F.col("event_type").cast("string")).alias("event_type"),
        F.col("occurred_at").cast(TS).alias("occurred_at"),
        F.col("actor").cast("string").alias("actor"),
        blank_to_null(F.lower(F.col("outcome").cast("string"))).alias("outcome"),
        F.col("_loaded_at").cast(TS).alias("loaded_at"),
        blank_to_null(F.col("_source_event").cast("string")).alias("source_event"),
    )
