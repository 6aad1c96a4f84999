"""Deterministic record keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def idempotency_key(source_system="source_system", invoice_id="invoice_id",
                    customer_id="customer_id", invoice_date="invoice_date") -> Column:
    """sha256 hex of ``source|invoice|customer|YYYY-MM-DD``."""
    def c(x):
        return F.col(x) if isinstance(x, str) else x

    return F.sha2(
        F.concat_ws(
            "|",
            c(source_system),
            c(invoice_id),
            c(customer_id),
            F.date_format(c(invoice_date), "yyyy-MM-dd"),
        ),
        256,
    )
