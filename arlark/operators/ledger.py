"""Invoice-grain AR ledger.

Two published forms differ in several rules; both are one function with
explicit options (see ``LEDGER_FORMS``):

=================  ===============================  ==============================
option             ``dbt``                          ``local``
=================  ===============================  ==============================
overdue_rule       due < as_of and source status    due < as_of and paid < amount
                   is not PAID
touch_event_types  the four collection types        every event
unapplied          matched / unapplied split,        payments without invoice are
                   customer's unapplied cash         dropped (they can never match)
money              decimal(18,2)                    double (exact decimal sums,
                                                    converted at the end)
columns            23                               18
=================  ===============================  ==============================

Both sides of each join are aggregated to one row per join key first, so the
joins are one-to-one on invoice keys and cannot fan out or skew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arlark.functions.aging import aging_bucket, days_outstanding, is_overdue_by_status, is_overdue_unpaid
from arlark.operators.matching import matched_payments, touches_per_invoice, unapplied_cash
from arlark.schemas import COLLECTION_EVENT_TYPES, MONEY

DBT_COLUMNS = [
    "invoice_id", "customer_id", "customer_name", "invoice_date", "due_date", "amount_usd",
    "amount_paid_usd", "amount_outstanding_usd", "currency", "status", "days_outstanding",
    "aging_bucket", "is_overdue", "collection_attempt_count", "last_outreach_at",
    "first_payment_date", "last_payment_date", "payment_count", "customer_unapplied_cash_usd",
    "source_system", "po_number", "line_items", "loaded_at",
]
LOCAL_COLUMNS = [
    "invoice_id", "customer_id", "customer_name", "invoice_date", "due_date", "amount_usd",
    "amount_paid_usd", "amount_outstanding_usd", "status", "days_outstanding", "aging_bucket",
    "is_overdue", "collection_attempt_count", "last_outreach_at", "first_payment_date",
    "last_payment_date", "payment_count", "source_system",
]

LEDGER_FORMS = {
    "dbt": dict(overdue_rule="status", touch_event_types=COLLECTION_EVENT_TYPES,
                separate_unapplied=True, money="decimal", columns=DBT_COLUMNS),
    "local": dict(overdue_rule="unpaid", touch_event_types=None,
                  separate_unapplied=False, money="double", columns=LOCAL_COLUMNS),
}


def invoice_aging(stg_invoices: DataFrame, as_of=None) -> DataFrame:
    """Staged invoices plus aging bucket and the status-based overdue flag."""
    inv = stg_invoices
    if "days_outstanding" not in inv.columns:
        inv = inv.withColumn("days_outstanding", days_outstanding("invoice_date", as_of))
    return inv.select(
        "invoice_id", "customer_id", "customer_name", "invoice_date", "due_date", "amount_usd",
        "currency", "status", "source_system", "po_number", "line_items", "days_outstanding",
        aging_bucket("days_outstanding").alias("aging_bucket"),
        is_overdue_by_status("due_date", "status", as_of).alias("is_overdue"),
        "loaded_at", "source_file",
    )


def build_ledger(invoices: DataFrame, payments: DataFrame, events: DataFrame, as_of=None,
                 form: str = "dbt", *, overdue_rule: str | None = None,
                 touch_event_types: Sequence[str] | None | str = "form",
                 separate_unapplied: bool | None = None, money: str | None = None,
                 columns: Sequence[str] | None = None) -> DataFrame:
    """Join invoices with their payment and touch aggregates.

    ``invoices``: canonical invoice rows (staged or raw; ``loaded_at`` or
    ``_loaded_at``).  ``payments``/``events``: canonical rows, already
    deduplicated as the caller wants.  ``as_of`` is a date (default today).
    """
    opts = dict(LEDGER_FORMS[form])
    if overdue_rule is not None:
        opts["overdue_rule"] = overdue_rule
    if touch_event_types != "form":
        opts["touch_event_types"] = touch_event_types
    if separate_unapplied is not None:
        opts["separate_unapplied"] = separate_unapplied
    if money is not None:
        opts["money"] = money
    if columns is not None:
        opts["columns"] = list(columns)

    inv = invoices
    if "loaded_at" not in inv.columns and "_loaded_at" in inv.columns:
        inv = inv.withColumnRenamed("_loaded_at", "loaded_at")
    inv = inv.withColumn("days_outstanding", days_outstanding("invoice_date", as_of))

    pay_loaded = "loaded_at" if "loaded_at" in payments.columns else "_loaded_at"
    pay = matched_payments(payments, pay_loaded).select(
        "invoice_id", "customer_id", "payment_count", "first_payment_date", "last_payment_date", "amount_paid_usd")
    touches = touches_per_invoice(events, opts["touch_event_types"])

    joined = (
        inv.join(pay, ["invoice_id", "customer_id"], "left")
        .join(touches, "invoice_id", "left")
    )
    free_cash = F.lit(0).cast(MONEY)
    if opts["separate_unapplied"]:
        # last, so that everything by invoice lies together until then; only matched invoices show it
        joined = joined.join(unapplied_cash(payments), "customer_id", "left")
        free_cash = F.when(F.col("payment_count").isNotNull(), F.col("unapplied_cash_usd"))
    paid = F.coalesce(F.col("amount_paid_usd"), F.lit(0).cast(MONEY))
    amount = F.col("amount_usd").cast(MONEY)
    outstanding = F.greatest(amount - paid, F.lit(0).cast(MONEY)).cast(MONEY)
    if opts["overdue_rule"] == "status":
        overdue = is_overdue_by_status("due_date", "status", as_of)
    else:
        overdue = is_overdue_unpaid("due_date", paid, amount, as_of)

    def money_out(c):
        return c.cast("double") if opts["money"] == "double" else c.cast(MONEY)

    ledger = joined.select(
        "invoice_id", "customer_id", "customer_name", "invoice_date", "due_date",
        money_out(amount).alias("amount_usd"),
        money_out(paid).alias("amount_paid_usd"),
        money_out(outstanding).alias("amount_outstanding_usd"),
        *([F.col("currency")] if "currency" in inv.columns else [F.lit(None).cast("string").alias("currency")]),
        F.when(paid >= amount, F.lit("PAID"))
        .when(paid > 0, F.lit("PARTIAL"))
        .otherwise(F.col("status")).alias("status"),
        "days_outstanding",
        aging_bucket("days_outstanding").alias("aging_bucket"),
        overdue.alias("is_overdue"),
        F.coalesce(F.col("collection_attempt_count"), F.lit(0).cast("bigint")).alias("collection_attempt_count"),
        "last_outreach_at",
        "first_payment_date",
        "last_payment_date",
        F.coalesce(F.col("payment_count"), F.lit(0).cast("bigint")).alias("payment_count"),
        money_out(F.coalesce(free_cash, F.lit(0).cast(MONEY)))
        .alias("customer_unapplied_cash_usd"),
        "source_system",
        *[F.col(c) if c in inv.columns else F.lit(None).alias(c) for c in ("po_number", "line_items", "loaded_at")],
    )
    return ledger.select(*opts["columns"])


def negative_outstanding(ledger: DataFrame) -> DataFrame:
    """Rows that break the non-negative balance rule (expected: none)."""
    return ledger.where(F.col("amount_outstanding_usd") < 0).select("invoice_id", "amount_outstanding_usd")
