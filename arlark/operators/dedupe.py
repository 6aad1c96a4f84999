"""Keep-one-row-per-key operators.

Staging keeps the *latest* row per key (``row_number() = 1`` ordered by load
time descending); ingestion keeps the *first* row per key in input order.
Both are one window with a rank filter, which Catalyst plans as a partial
``WindowGroupLimit`` before the shuffle: every map task forwards at most one
row per key, so a key that holds a third of the input does not land whole on
one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arlark.functions.keys import idempotency_key

_RN = "__rn"


def _order(spec: Sequence) -> list[Column]:
    """Strings sort ascending NULLS LAST; Columns are used as given."""
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in spec]


def keep_one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*_order(order))
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)


def keep_latest(df: DataFrame, keys: Sequence[str], loaded_at: str = "_loaded_at",
                tiebreak: Sequence[str] = ()) -> DataFrame:
    """Latest ``loaded_at`` per key; ``tiebreak`` columns (ascending) settle equal times."""
    return keep_one_per_key(df, keys, [F.col(loaded_at).desc_nulls_last(), *tiebreak])


def keep_first(df: DataFrame, keys: Sequence[str], sequence: Sequence) -> DataFrame:
    """First row per key in the order given by ``sequence`` (an explicit input order)."""
    return keep_one_per_key(df, keys, sequence)


def with_idempotency_key(invoices: DataFrame, name: str = "idempotency_key") -> DataFrame:
    return invoices.withColumn(name, idempotency_key())


def dedupe_invoices(invoices: DataFrame, sequence: Sequence = ("_loaded_at", "_source_file", "amount_usd")) -> DataFrame:
    """First invoice per idempotency key (source, invoice, customer, invoice date)."""
    keyed = with_idempotency_key(invoices, "__key")
    return keep_first(keyed, ["__key"], sequence).drop("__key")


def dedupe_payments(payments: DataFrame,
                    sequence: Sequence = ("_loaded_at", "_source_event", "amount_usd")) -> DataFrame:
    """First payment per ``payment_id``."""
    return keep_first(payments, ["payment_id"], sequence)
