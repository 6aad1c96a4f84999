"""Invoice age, aging bucket and overdue flag, always against an explicit as-of date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_of_literal(as_of) -> Column:
    """``as_of`` may be a date, an ISO string, or a Column; None means today."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, str):
        as_of = dt.date.fromisoformat(as_of)
    return F.lit(as_of)


def days_outstanding(invoice_date, as_of) -> Column:
    """Whole days from the invoice date (not the due date) to ``as_of``."""
    d = F.col(invoice_date) if isinstance(invoice_date, str) else invoice_date
    return F.datediff(as_of_literal(as_of), d)


def aging_bucket(days) -> Column:
    """0-30 / 31-60 / 61-90 / 90+; negative ages land in 0-30, NULL in 90+."""
    d = F.col(days) if isinstance(days, str) else days
    return (
        F.when(d <= 30, "0-30")
        .when(d <= 60, "31-60")
        .when(d <= 90, "61-90")
        .otherwise("90+")
    )


def is_overdue_by_status(due_date, status, as_of) -> Column:
    """Staging rule: past due and the *source* status is not PAID."""
    due = F.col(due_date) if isinstance(due_date, str) else due_date
    st = F.col(status) if isinstance(status, str) else status
    return (due < as_of_literal(as_of)) & (st != "PAID")


def is_overdue_unpaid(due_date, amount_paid, amount, as_of) -> Column:
    """Local rule: past due and paid less than the invoice amount."""
    due = F.col(due_date) if isinstance(due_date, str) else due_date
    return (due < as_of_literal(as_of)) & (amount_paid < amount)
