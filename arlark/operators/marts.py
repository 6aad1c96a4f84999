"""Customer dimension and the collections-health mart.

The warehouse mart joins the customer dimension back to the ledger it was
aggregated from and groups again by nine carried columns.  For every
non-NULL customer that equals a single ``groupBy(customer_id)`` over the
ledger, which is what is planned here: one shuffle instead of two
aggregates and a join.  The inner join of the warehouse form drops the
NULL customer, so that form filters it out first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arlark.schemas import MONEY, MONEY_TOTAL


def _money_sum(c: Column, money: str) -> Column:
    """Exact decimal sum; a double-money ledger gets the sum back as double."""
    s = F.sum(c.cast(MONEY)).cast(MONEY_TOTAL)
    return s.cast("double") if money == "double" else s


def _money_type(ledger: DataFrame) -> str:
    return "double" if dict(ledger.dtypes)["amount_usd"] == "double" else "decimal"


def risk_band(total_outstanding: Column, overdue_count: Column, outstanding_90_plus: Column) -> Column:
    return (
        F.when(total_outstanding == 0, "low")
        .when((overdue_count >= 3) | (outstanding_90_plus > 0), "high")
        .when(overdue_count > 0, "medium")
        .otherwise("low")
    )


def _customer_aggregates(ledger: DataFrame, money: str) -> list[Column]:
    out = F.col("amount_outstanding_usd")
    overdue = F.col("is_overdue")
    bucket = F.col("aging_bucket")
    zero = F.lit(0).cast(MONEY)
    return [
        F.max("customer_name").alias("customer_name"),
        F.min("invoice_date").alias("first_invoice_date"),
        F.max("invoice_date").alias("last_invoice_date"),
        F.count(F.lit(1)).alias("invoice_count"),
        _money_sum(F.col("amount_usd"), money).alias("lifetime_invoiced_usd"),
        _money_sum(F.col("amount_paid_usd"), money).alias("lifetime_paid_usd"),
        _money_sum(out, money).alias("total_outstanding_usd"),
        F.avg("days_outstanding").alias("avg_days_outstanding"),
        _money_sum(F.when(overdue, out).otherwise(zero), money).alias("overdue_outstanding_usd"),
        F.sum(F.when(overdue, 1).otherwise(0)).cast("bigint").alias("overdue_invoice_count"),
        F.max("last_outreach_at").alias("last_outreach_at"),
        F.max("source_system").alias("primary_source_system"),
        F.sum("collection_attempt_count").cast("bigint").alias("collection_attempt_count"),
        _money_sum(F.when(bucket == "0-30", out).otherwise(zero), money).alias("outstanding_0_30_usd"),
        _money_sum(F.when(bucket == "31-60", out).otherwise(zero), money).alias("outstanding_31_60_usd"),
        _money_sum(F.when(bucket == "61-90", out).otherwise(zero), money).alias("outstanding_61_90_usd"),
        _money_sum(F.when(bucket == "90+", out).otherwise(zero), money).alias("outstanding_90_plus_usd"),
        # exact sums, divided in double at the end
        (_money_sum(F.col("amount_paid_usd"), "decimal").cast("double")
         / F.nullif(_money_sum(F.col("amount_usd"), "decimal").cast("double"), F.lit(0.0)))
        .alias("lifetime_collection_rate"),
        (F.sum(F.when((F.col("status") == "PAID")
                      & (F.col("last_payment_date") <= F.date_add("invoice_date", 30)), 1).otherwise(0))
         / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("paid_within_30d_rate"),
    ]


def _rollup(ledger: DataFrame) -> DataFrame:
    money = _money_type(ledger)
    agg = ledger.groupBy("customer_id").agg(*_customer_aggregates(ledger, money))
    return agg.withColumn(
        "ar_risk_band",
        risk_band(F.col("total_outstanding_usd"), F.col("overdue_invoice_count"),
                  F.col("outstanding_90_plus_usd")),
    )


DIM_CUSTOMER_COLUMNS = [
    "customer_id", "customer_name", "first_invoice_date", "last_invoice_date", "invoice_count",
    "lifetime_invoiced_usd", "lifetime_paid_usd", "total_outstanding_usd", "avg_days_outstanding",
    "overdue_outstanding_usd", "overdue_invoice_count", "last_outreach_at", "primary_source_system",
    "ar_risk_band",
]
HEALTH_DBT_COLUMNS = [
    "customer_id", "customer_name", "ar_risk_band", "invoice_count", "total_outstanding_usd",
    "overdue_outstanding_usd", "overdue_invoice_count", "avg_days_outstanding", "last_outreach_at",
    "outstanding_0_30_usd", "outstanding_31_60_usd", "outstanding_61_90_usd", "outstanding_90_plus_usd",
    "collection_attempt_count", "lifetime_collection_rate", "paid_within_30d_rate",
]
HEALTH_LOCAL_COLUMNS = [
    "customer_id", "customer_name", "invoice_count", "lifetime_invoiced_usd", "lifetime_paid_usd",
    "total_outstanding_usd", "overdue_outstanding_usd", "overdue_invoice_count", "avg_days_outstanding",
    "last_outreach_at", "collection_attempt_count", "outstanding_0_30_usd", "outstanding_31_60_usd",
    "outstanding_61_90_usd", "outstanding_90_plus_usd", "lifetime_collection_rate",
    "paid_within_30d_rate", "ar_risk_band",
]


def dim_customers(ledger: DataFrame) -> DataFrame:
    """Customer dimension with lifetime AR attributes and risk band."""
    return _rollup(ledger).select(*DIM_CUSTOMER_COLUMNS)


def collections_health(ledger: DataFrame, form: str = "dbt") -> DataFrame:
    """Customer collections-health mart (``dbt``: 16 columns, ``local``: 18)."""
    if form == "dbt":
        return _rollup(ledger.where(F.col("customer_id").isNotNull())).select(*HEALTH_DBT_COLUMNS)
    return _rollup(ledger).select(*HEALTH_LOCAL_COLUMNS)
