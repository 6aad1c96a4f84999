"""Semantic metric layer over the invoice ledger.

Measures and metrics are declared as data; ``metric_query`` turns any set of
them into one ``groupBy(dimensions).agg(...)``.  Metric filters become
conditional aggregates (``avg(when(filter, x))``) so several metrics with
different filters still cost a single pass and a single shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arlark.functions.aging import as_of_literal
from arlark.schemas import MONEY, MONEY_TOTAL


@dataclass(frozen=True)
class Measure:
    agg: str          # sum | average
    expr: Column
    money: bool = False


@dataclass(frozen=True)
class Metric:
    kind: str                      # simple | ratio
    measure: str = ""
    numerator: str = ""
    denominator: str = ""
    filter: Column | None = None


def _measures() -> dict[str, Measure]:
    return {
        "total_invoiced_usd": Measure("sum", F.col("amount_usd"), money=True),
        "total_paid_usd": Measure("sum", F.col("amount_paid_usd"), money=True),
        "total_outstanding_usd": Measure("sum", F.col("amount_outstanding_usd"), money=True),
        "avg_days_outstanding": Measure("average", F.col("days_outstanding")),
        "overdue_invoice_count": Measure("sum", F.when(F.col("is_overdue"), 1).otherwise(0)),
    }


def _metrics() -> dict[str, Metric]:
    return {
        "days_sales_outstanding": Metric("simple", measure="avg_days_outstanding",
                                         filter=F.col("status") != "PAID"),
        "collection_rate": Metric("ratio", numerator="total_paid_usd", denominator="total_invoiced_usd"),
        "ar_outstanding": Metric("simple", measure="total_outstanding_usd"),
        "overdue_invoice_count": Metric("simple", measure="overdue_invoice_count"),
    }


DIMENSIONS = ["status", "aging_bucket", "source_system", "customer_id"]
TIME_GRAINS = ["day", "week", "month", "quarter", "year"]


def _measure_column(m: Measure, where: Column | None, as_double: bool = False) -> Column:
    x = m.expr.cast(MONEY) if m.money else m.expr
    if where is not None:
        x = F.when(where, x)
    if m.agg == "average":
        return F.avg(x)
    s = F.sum(x)
    if as_double:
        return s.cast("double")
    return s.cast(MONEY_TOTAL) if m.money else s.cast("bigint")


def metric_column(name: str) -> Column:
    """Aggregate expression of a metric or a bare measure."""
    measures, metrics = _measures(), _metrics()
    if name in metrics:
        mt = metrics[name]
        if mt.kind == "ratio":
            num = _measure_column(measures[mt.numerator], mt.filter)
            den = _measure_column(measures[mt.denominator], mt.filter)
            return (num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))).alias(name)
        return _measure_column(measures[mt.measure], mt.filter).alias(name)
    if name in measures:
        return _measure_column(measures[name], None).alias(name)
    raise ValueError(f"unknown metric or measure '{name}'")


def metric_query(ledger: DataFrame, metrics: Sequence[str], dimensions: Sequence[str] = (),
                 time_grain: str | None = None, time_dimension: str = "invoice_date") -> DataFrame:
    """``metrics`` grouped by ``dimensions`` and optionally a truncated time dimension."""
    keys: list[Column] = [F.col(d) for d in dimensions]
    if time_grain is not None:
        if time_grain not in TIME_GRAINS:
            raise ValueError(f"unknown grain '{time_grain}'")
        col = F.col(time_dimension)
        if time_grain != "day":
            col = F.date_trunc(time_grain, col).cast("date")
        keys.append(col.alias(f"{time_dimension}__{time_grain}"))
    aggs = [metric_column(m) for m in metrics]
    return ledger.groupBy(*keys).agg(*aggs) if keys else ledger.agg(*aggs)


def metric_cuts(ledger: DataFrame, metrics: Sequence[str], cuts: dict[str, tuple[Sequence[str], str | None]],
                time_dimension: str = "invoice_date") -> DataFrame:
    """Several cuts of the same metrics in one pass: (cut, its dimensions, period, metrics).

    ``cuts`` names (dimensions, time grain or None).  All cuts are grouping sets of
    one aggregate, so the ledger is built and read once; rows are combined before
    the shuffle.  Dimensions that a cut does not use are NULL in its rows, and so is ``period`` without a grain.
    """
    dims = list(dict.fromkeys(d for used, _ in cuts.values() for d in used))
    grains = list(dict.fromkeys(g for _, g in cuts.values() if g))
    unknown = [g for g in grains if g not in TIME_GRAINS]
    if unknown:
        raise ValueError(f"unknown grain '{unknown[0]}'")
    day = F.col(time_dimension)
    periods = {g: f"__period_{g}" for g in grains}
    rows = ledger.withColumns({name: day if g == "day" else F.date_trunc(g, day).cast("date") for g, name in periods.items()})
    keys = [*dims, *periods.values()]
    sets = [[*used, *([periods[g]] if g else [])] for used, g in cuts.values()]
    # bit k of the id, from the left, is set where key k is left out
    ids = [sum((k not in used) << (len(keys) - 1 - i) for i, k in enumerate(keys)) for used in sets]
    if len(set(ids)) < len(ids):
        raise ValueError("two cuts have the same dimensions and grain")
    grouped = rows.groupingSets([[F.col(k) for k in used] for used in sets], *[F.col(k) for k in keys]).agg(
        F.grouping_id().alias("__id"), *[metric_column(m) for m in metrics])
    name = F.lit(None).cast("string")
    for cut, number in zip(cuts, ids):
        name = F.when(F.col("__id") == number, F.lit(cut)).otherwise(name)
    period = F.coalesce(*[F.col(p) for p in periods.values()]) if periods else F.lit(None).cast("date")
    return grouped.select(name.alias("cut"), *dims, period.alias("period"), *metrics)


def collection_rate_30d(invoices: DataFrame, payments: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    """Cash collected in (as_of - days, as_of] over invoice amounts falling due in the same span.

    The upstream documents name this metric without defining its measures;
    this is our definition.  One global row from one aggregate over the union
    of both filtered inputs (no join).
    """
    end = as_of_literal(as_of)
    start = F.date_sub(end, days)
    amount = F.col("amount_usd").cast(MONEY)
    none = F.lit(None).cast(MONEY)
    collected = payments.where((F.col("payment_date") > start) & (F.col("payment_date") <= end)).select(
        amount.alias("collected"), none.alias("due"))
    due = invoices.where((F.col("due_date") > start) & (F.col("due_date") <= end)).select(
        none.alias("collected"), amount.alias("due"))
    totals = collected.unionByName(due).agg(
        F.coalesce(F.sum("collected"), F.lit(0)).cast(MONEY_TOTAL).alias("amount_collected_30d"),
        F.coalesce(F.sum("due"), F.lit(0)).cast(MONEY_TOTAL).alias("amount_due_30d"),
    )
    return totals.withColumn(
        "collection_rate_30d",
        F.col("amount_collected_30d").cast("double") / F.nullif(F.col("amount_due_30d").cast("double"), F.lit(0.0)),
    )
