"""Dashboard report tables over the collections-health mart and the ledger.

Each chart of the dashboard is one small aggregate here; global aggregates
are single-pass ``agg`` calls (partial per task, one final row), never a
collect-and-compute on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arlark.schemas import MONEY, MONEY_TOTAL

BUCKET_COLUMNS = ["outstanding_0_30_usd", "outstanding_31_60_usd", "outstanding_61_90_usd",
                  "outstanding_90_plus_usd"]
PRIORITY_COLUMNS = ["customer_name", "ar_risk_band", "total_outstanding_usd", "overdue_outstanding_usd",
                    "overdue_invoice_count", "collection_attempt_count", "paid_within_30d_rate"]


def _money_sum(c) -> F.Column:
    return F.sum((F.col(c) if isinstance(c, str) else c).cast(MONEY)).cast(MONEY_TOTAL)


def filter_bands(mart: DataFrame, bands: Sequence[str] | None = None) -> DataFrame:
    """Risk-band multi-select; ``None`` keeps every band."""
    return mart if bands is None else mart.where(F.col("ar_risk_band").isin(list(bands)))


def risk_band_list(mart: DataFrame) -> DataFrame:
    """Distinct bands, sorted (the choices of the band filter)."""
    return mart.select("ar_risk_band").where(F.col("ar_risk_band").isNotNull()).distinct().orderBy("ar_risk_band")


def kpi_tiles(mart: DataFrame, bands: Sequence[str] | None = None) -> DataFrame:
    """Outstanding, share overdue (0 when nothing is outstanding), unweighted mean age, mean rate."""
    m = filter_bands(mart, bands)
    totals = m.agg(
        _money_sum("total_outstanding_usd").alias("ar_outstanding_usd"),
        _money_sum("overdue_outstanding_usd").alias("overdue_outstanding_usd"),
        F.avg("avg_days_outstanding").alias("avg_invoice_age_days"),
        F.avg("lifetime_collection_rate").alias("collection_rate"),
    )
    out = F.col("ar_outstanding_usd").cast("double")
    return totals.select(
        "ar_outstanding_usd",
        F.when(F.coalesce(out, F.lit(0.0)) == 0, F.lit(0.0))
        .otherwise(F.col("overdue_outstanding_usd").cast("double") / out).alias("pct_overdue"),
        "avg_invoice_age_days",
        "collection_rate",
    )


def aging_summary(mart: DataFrame, bands: Sequence[str] | None = None) -> DataFrame:
    """Outstanding by bucket, unpivoted to (bucket, amount_usd); labels 0-30 .. 90-plus."""
    sums = filter_bands(mart, bands).agg(*[_money_sum(c).alias(c) for c in BUCKET_COLUMNS])
    long = sums.unpivot([], BUCKET_COLUMNS, "bucket", "amount_usd")
    label = F.regexp_replace(F.regexp_replace(F.regexp_replace("bucket", "outstanding_", ""), "_usd", ""), "_", "-")
    return long.select(label.alias("bucket"), "amount_usd")


def risk_mix(mart: DataFrame, bands: Sequence[str] | None = None) -> DataFrame:
    """Outstanding by risk band, largest first."""
    return (filter_bands(mart, bands).groupBy("ar_risk_band")
            .agg(_money_sum("total_outstanding_usd").alias("total_outstanding_usd"))
            .orderBy(F.col("total_outstanding_usd").desc()))


def health_table(mart: DataFrame, bands: Sequence[str] | None = None) -> DataFrame:
    """The mart ordered by band (as text) then overdue dollars, largest first."""
    return filter_bands(mart, bands).orderBy(
        F.col("ar_risk_band").asc(), F.col("overdue_outstanding_usd").desc(), F.col("customer_id").asc())


def funnel(mart: DataFrame, bands: Sequence[str] | None = None) -> DataFrame:
    """Four stages; 'Invoiced' is outstanding / mean(max(rate, 0.01)) with NULL rates skipped."""
    m = filter_bands(mart, bands)
    rate = F.col("lifetime_collection_rate")
    totals = m.agg(
        _money_sum("total_outstanding_usd").alias("outstanding"),
        _money_sum("overdue_outstanding_usd").alias("overdue"),
        _money_sum(F.when(F.col("collection_attempt_count") > 0, F.col("total_outstanding_usd"))).alias("active"),
        F.avg(F.when(rate.isNotNull(), F.greatest(rate, F.lit(0.01)))).alias("mean_rate"),
    )
    stages = totals.select(
        (F.col("outstanding").cast("double") / F.col("mean_rate")).alias("Invoiced"),
        F.coalesce(F.col("outstanding"), F.lit(0).cast(MONEY)).cast("double").alias("Outstanding"),
        F.coalesce(F.col("overdue"), F.lit(0).cast(MONEY)).cast("double").alias("Overdue"),
        F.coalesce(F.col("active"), F.lit(0).cast(MONEY)).cast("double").alias("In Active Collections"),
    )
    return stages.unpivot([], ["Invoiced", "Outstanding", "Overdue", "In Active Collections"], "stage", "amount")


def priority_top(mart: DataFrame, n: int = 10, bands: Sequence[str] | None = None) -> DataFrame:
    """Customers to prioritise: top ``n`` by band then overdue dollars (customer id breaks ties)."""
    return (filter_bands(mart, bands)
            .orderBy(F.col("ar_risk_band").asc(), F.col("overdue_outstanding_usd").desc(),
                     F.col("customer_id").asc())
            .limit(n)
            .select("customer_id", *PRIORITY_COLUMNS))


def status_flow(ledger: DataFrame) -> DataFrame:
    """Invoice flow by derived status: count, invoiced, paid and outstanding dollars."""
    return ledger.groupBy("status").agg(
        F.count(F.lit(1)).alias("invoice_count"),
        _money_sum("amount_usd").alias("amount_usd"),
        _money_sum("amount_paid_usd").alias("amount_paid_usd"),
        _money_sum("amount_outstanding_usd").alias("amount_outstanding_usd"),
    )
