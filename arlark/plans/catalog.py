"""Registered queries over the driver tables: name -> (spark, sf_dir) -> DataFrame.

Every query reads whole driver tables through ``arlark.sources.driver_tables``
and runs the library operators on them; ``arlark.plans.oracle`` holds the
matching DuckDB text.  Doubles that come out of divisions or averages are
rounded to 6 places on both sides (summation order differs between engines).
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arlark.operators import quality, reports
from arlark.operators.dedupe import dedupe_invoices, dedupe_payments, keep_latest, with_idempotency_key
from arlark.operators.features import customer_features, strict_features
from arlark.operators.ledger import build_ledger, invoice_aging
from arlark.operators.ledger import negative_outstanding as negative_outstanding_rows
from arlark.operators.marts import collections_health, dim_customers
from arlark.operators.matching import payment_id_chunks, payment_matching, touches_per_invoice, unapplied_cash
from arlark.operators.metrics import collection_rate_30d, metric_query
from arlark.operators.metrics import metric_cuts as metric_cuts_of
from arlark.operators.normalize import (
    canonicalize_invoices, normalize_erp, normalize_payments, normalize_product_events, parse_json_payloads,
    split_quarantine, with_invoice_derivations,
)
from arlark.operators.staging import (
    INVOICE_TIEBREAK, PAYMENT_TIEBREAK, invoice_columns, payment_columns, stg_erp_invoices, stg_payments, stg_product_events,
)
from arlark.plans import incremental, jobs, replay, sinks
from arlark.plans.bucket_store import CODEC
from arlark.schemas import EVENT_PAYLOAD_SCHEMA, FLAT_PAYMENT_PAYLOAD_SCHEMA, STRIPE_PAYLOAD_SCHEMA, VALID_SOURCES
from arlark.session import prepare, unique_dir
from arlark.sources import driver_tables as src
from arlark.sources import messages
from arlark.sources.files import read_erp_csv, read_json_records
from arlark.streaming import streams

AS_OF = dt.date.fromisoformat(src.AS_OF)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return run


def r6(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), 6) for c in cols})


# --------------------------------------------------------------------------- building blocks

class staged:
    """Staging tables, each built only when a query asks for it (also unpacks as a 3-tuple)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @property
    def invoices(self) -> DataFrame:
        return stg_erp_invoices(src.raw_invoices(self.spark, self.sf_dir), AS_OF)

    @property
    def payments(self) -> DataFrame:
        return stg_payments(src.raw_payments(self.spark, self.sf_dir))

    def stored_payments(self) -> DataFrame:
        """The deduplicated payments written once to the shared folder: for plans that read them twice."""
        path = os.path.join(unique_dir(self.spark, "staged"), "payments")
        payments = self.payments
        payments.write.option("compression", CODEC).parquet(path)
        return self.spark.read.schema(payments.schema).parquet(path)

    @property
    def events(self) -> DataFrame:
        return stg_product_events(src.raw_product_events(self.spark, self.sf_dir))

    def __getitem__(self, i: int) -> DataFrame:
        return getattr(self, ("invoices", "payments", "events")[i])

    def __iter__(self):
        return iter((self.invoices, self.payments, self.events))


def ledger_dbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    inv, pay, ev = staged(spark, sf_dir)
    return build_ledger(inv, pay, ev, AS_OF, form="dbt")


def local_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Ingestion path: cleaned invoices and payments, first row per key wins; events as loaded."""
    inv, pay, ev = src.raw_tables(spark, sf_dir)
    valid, _ = split_quarantine(canonicalize_invoices(inv))
    return dedupe_invoices(valid), dedupe_payments(pay), ev


def ledger_local(spark: SparkSession, sf_dir: str) -> DataFrame:
    inv, pay, ev = local_inputs(spark, sf_dir)
    return build_ledger(inv, pay, ev, AS_OF, form="local")


# --------------------------------------------------------------------------- staging and matching

@query
def stg_erp_invoices_q(spark, sf_dir):
    return staged(spark, sf_dir)[0]


@query
def stg_payments_q(spark, sf_dir):
    return staged(spark, sf_dir)[1]


@query
def stg_product_events_q(spark, sf_dir):
    return staged(spark, sf_dir)[2]


@query
def invoice_aging_q(spark, sf_dir):
    return invoice_aging(staged(spark, sf_dir)[0], AS_OF)


@query
def payment_matching_q(spark, sf_dir):
    return payment_matching(staged(spark, sf_dir).stored_payments())


@query
def payment_id_chunks_q(spark, sf_dir):
    """Payment ids of each invoice in lists of three."""
    return payment_id_chunks(staged(spark, sf_dir).payments, chunk=3)


@query
def unapplied_cash_q(spark, sf_dir):
    return unapplied_cash(staged(spark, sf_dir)[1])


@query
def touches_per_invoice_q(spark, sf_dir):
    return touches_per_invoice(staged(spark, sf_dir)[2])


# --------------------------------------------------------------------------- ledger and marts

@query
def fct_ar_ledger_dbt(spark, sf_dir):
    st = staged(spark, sf_dir)
    return build_ledger(st.invoices, st.stored_payments(), st.events, AS_OF, form="dbt")


@query
def fct_ar_ledger_copartitioned(spark, sf_dir):
    """The same ledger over staging tables in buckets of the invoice id."""
    return jobs.copartitioned_ledger(*src.raw_tables(spark, sf_dir), AS_OF)


@query
def fct_ar_ledger_local(spark, sf_dir):
    return ledger_local(spark, sf_dir)


@query
def dim_customers_q(spark, sf_dir):
    return r6(dim_customers(ledger_dbt(spark, sf_dir)), "avg_days_outstanding")


@query
def mrt_collections_health_dbt(spark, sf_dir):
    mart = collections_health(ledger_dbt(spark, sf_dir), form="dbt")
    return r6(mart, "avg_days_outstanding", "lifetime_collection_rate", "paid_within_30d_rate")


@query
def mrt_collections_health_local(spark, sf_dir):
    mart = collections_health(ledger_local(spark, sf_dir), form="local")
    return r6(mart, "avg_days_outstanding", "lifetime_collection_rate", "paid_within_30d_rate")


# --------------------------------------------------------------------------- metric layer

@query
def metric_dso_by_bucket(spark, sf_dir):
    return r6(metric_query(ledger_dbt(spark, sf_dir), ["days_sales_outstanding"], ["aging_bucket"]),
              "days_sales_outstanding")


@query
def metric_collection_rate_by_source(spark, sf_dir):
    m = metric_query(ledger_dbt(spark, sf_dir),
                     ["collection_rate", "total_paid_usd", "total_invoiced_usd"], ["source_system"])
    return r6(m, "collection_rate")


@query
def metric_ar_outstanding_by_status(spark, sf_dir):
    return metric_query(ledger_dbt(spark, sf_dir), ["ar_outstanding", "overdue_invoice_count"], ["status"])


@query
def metric_overdue_by_month(spark, sf_dir):
    return metric_query(ledger_dbt(spark, sf_dir), ["overdue_invoice_count", "ar_outstanding"],
                        time_grain="month")


def _by_grain(spark, sf_dir, grain):
    return metric_query(ledger_dbt(spark, sf_dir), ["total_invoiced_usd", "ar_outstanding"], ["source_system"], time_grain=grain)


@query
def metric_by_day(spark, sf_dir):
    return _by_grain(spark, sf_dir, "day")


@query
def metric_by_week(spark, sf_dir):
    return _by_grain(spark, sf_dir, "week")


@query
def metric_by_quarter(spark, sf_dir):
    return _by_grain(spark, sf_dir, "quarter")


METRIC_CUTS = {
    "by_bucket": (["aging_bucket"], None), "by_source": (["source_system"], None), "by_status": (["status"], None), "by_month": ([], "month"),
    "by_source_day": (["source_system"], "day"), "by_source_week": (["source_system"], "week"), "by_source_quarter": (["source_system"], "quarter"),
    "all": ([], None),
}


@query
def metric_cuts(spark, sf_dir):
    """All cuts of the metric layer in one pass over one ledger."""
    names = ["days_sales_outstanding", "collection_rate", "ar_outstanding", "overdue_invoice_count", "total_invoiced_usd", "total_paid_usd"]
    return r6(metric_cuts_of(ledger_dbt(spark, sf_dir), names, METRIC_CUTS), "days_sales_outstanding", "collection_rate")


@query
def metric_collection_rate_30d(spark, sf_dir):
    st = staged(spark, sf_dir)
    inv, pay = st.invoices, st.payments
    return r6(collection_rate_30d(inv, pay, AS_OF), "collection_rate_30d")


# --------------------------------------------------------------------------- dashboard reports

def local_mart(spark, sf_dir) -> DataFrame:
    return collections_health(ledger_local(spark, sf_dir), form="local")


@query
def kpi_tiles(spark, sf_dir):
    return r6(reports.kpi_tiles(local_mart(spark, sf_dir)), "pct_overdue", "avg_invoice_age_days", "collection_rate")


@query
def aging_summary(spark, sf_dir):
    return reports.aging_summary(local_mart(spark, sf_dir))


@query
def risk_mix(spark, sf_dir):
    return reports.risk_mix(local_mart(spark, sf_dir))


@query
def health_table(spark, sf_dir):
    t = reports.health_table(local_mart(spark, sf_dir))
    return r6(t, "avg_days_outstanding", "lifetime_collection_rate", "paid_within_30d_rate")


@query
def aging_summary_bands(spark, sf_dir):
    """The band filter: two of the three bands."""
    return reports.aging_summary(local_mart(spark, sf_dir), bands=["high", "medium"])


@query
def health_table_bands(spark, sf_dir):
    t = reports.health_table(local_mart(spark, sf_dir), bands=["low"])
    return r6(t, "avg_days_outstanding", "lifetime_collection_rate", "paid_within_30d_rate")


@query
def funnel(spark, sf_dir):
    return reports.funnel(local_mart(spark, sf_dir)).withColumn("amount", F.round("amount", 2))


@query
def priority_top10(spark, sf_dir):
    return r6(reports.priority_top(local_mart(spark, sf_dir), 10), "paid_within_30d_rate")


@query
def status_flow(spark, sf_dir):
    return reports.status_flow(ledger_dbt(spark, sf_dir))


@query
def risk_band_list(spark, sf_dir):
    return reports.risk_band_list(local_mart(spark, sf_dir))


# --------------------------------------------------------------------------- features

FEATURE_DOUBLES = ["avg_days_to_pay_90d", "payment_velocity_delta", "dispute_rate_12m",
                   "pct_current", "pct_31_60", "pct_61_90", "pct_90_plus"]


def _features_out(df: DataFrame) -> DataFrame:
    # cents / 100000 has exactly 7 decimals, a rounding tie at 6 places that the
    # two engines break differently; 9 places is exact for it
    return r6(df, *FEATURE_DOUBLES).withColumn(
        "outstanding_pct_of_credit", F.round("outstanding_pct_of_credit", 9))


@query
def features_faithful(spark, sf_dir):
    return _features_out(customer_features(ledger_dbt(spark, sf_dir), AS_OF))


@query
def features_strict(spark, sf_dir):
    inv, pay, ev = staged(spark, sf_dir)
    return _features_out(strict_features(inv, pay, ev, AS_OF))


@query
def features_credit_limits(spark, sf_dir):
    """A ledger with its own credit limits (some missing) and some rows without a customer."""
    ledger = ledger_dbt(spark, sf_dir).withColumn(
        "credit_limit_usd", F.when(F.col("line_items") % 2 == 0, F.length("customer_id") * 10000.0)).withColumn(
        "customer_id", F.when(F.col("line_items") != 7, F.col("customer_id")))
    return _features_out(customer_features(ledger, AS_OF))


# --------------------------------------------------------------------------- source normalizers

NON_LOAD_INVOICE = ["invoice_id", "customer_id", "customer_name", "invoice_date", "due_date", "amount_usd",
                    "currency", "status", "source_system", "po_number", "line_items", "_source_file"]
NON_LOAD_PAYMENT = ["payment_id", "invoice_id", "customer_id", "payment_date", "amount_usd", "currency",
                    "payment_method", "processor", "is_partial", "reference_number", "notes", "_source_event"]
NON_LOAD_EVENT = ["event_id", "invoice_id", "customer_id", "event_type", "occurred_at", "actor", "outcome",
                  "_source_event"]


def erp_normalized(spark, sf_dir, source: str) -> DataFrame:
    return normalize_erp(src.erp_export(spark, sf_dir, source), source, source_file=f"{source}.csv")


def _erp_valid(spark, sf_dir, source):
    # load time is the wall clock of the run; everything else is deterministic
    return split_quarantine(erp_normalized(spark, sf_dir, source))[0].select(*NON_LOAD_INVOICE)


@query
def erp_normalize_netsuite(spark, sf_dir):
    return _erp_valid(spark, sf_dir, "netsuite")


@query
def erp_normalize_quickbooks(spark, sf_dir):
    return _erp_valid(spark, sf_dir, "quickbooks")


@query
def erp_normalize_sap(spark, sf_dir):
    return _erp_valid(spark, sf_dir, "sap")


@query
def erp_union(spark, sf_dir):
    parts = [_erp_valid(spark, sf_dir, s) for s in VALID_SOURCES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query
def erp_quarantine(spark, sf_dir):
    parts = [split_quarantine(erp_normalized(spark, sf_dir, s))[1] for s in VALID_SOURCES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("invoice_id", "source_system", F.array_join("_errors", "; ").alias("errors"))


PROCESSORS = ("stripe", "plaid", "manual", "bank")


def message_payments(spark, sf_dir, processor: str) -> DataFrame:
    schema = STRIPE_PAYLOAD_SCHEMA if processor == "stripe" else FLAT_PAYMENT_PAYLOAD_SCHEMA
    return normalize_payments(parse_json_payloads(messages.webhook_messages(spark, sf_dir, processor), schema), processor)


def payments_normalized(spark, sf_dir, processor: str) -> DataFrame:
    schema = STRIPE_PAYLOAD_SCHEMA if processor == "stripe" else FLAT_PAYMENT_PAYLOAD_SCHEMA
    parsed = parse_json_payloads(src.payment_payloads(spark, sf_dir, processor), schema)
    return normalize_payments(parsed, processor)


def _pay_valid(spark, sf_dir, processor):
    return split_quarantine(payments_normalized(spark, sf_dir, processor))[0].select(*NON_LOAD_PAYMENT)


@query
def payment_normalize_stripe(spark, sf_dir):
    return _pay_valid(spark, sf_dir, "stripe")


@query
def payment_normalize_plaid(spark, sf_dir):
    return _pay_valid(spark, sf_dir, "plaid")


@query
def payment_normalize_manual(spark, sf_dir):
    return _pay_valid(spark, sf_dir, "manual")


@query
def payment_normalize_bank(spark, sf_dir):
    return _pay_valid(spark, sf_dir, "bank")


@query
def payment_quarantine(spark, sf_dir):
    """Rejected webhooks of all four processors: every payment rule, broken and unreadable messages, each with its text."""
    out = None
    for processor in PROCESSORS:
        _, rejected = split_quarantine(message_payments(spark, sf_dir, processor))
        out = rejected if out is None else out.unionByName(rejected)
    return out.select("payment_id", "processor", F.array_join("_errors", "; ").alias("errors"), F.col("_raw").alias("raw"))


@query
def payment_quarantine_bank(spark, sf_dir):
    """Rejected payments of the fourth processor, next to those of ``payment_quarantine``."""
    rejected = split_quarantine(payments_normalized(spark, sf_dir, "bank"))[1]
    return rejected.select("payment_id", "processor", F.array_join("_errors", "; ").alias("errors"))


@query
def payment_messages_valid(spark, sf_dir):
    """The valid webhooks between the faulty ones."""
    out = None
    for processor in PROCESSORS:
        valid, _ = split_quarantine(message_payments(spark, sf_dir, processor))
        out = valid if out is None else out.unionByName(valid)
    return out.select("payment_id", "invoice_id", "customer_id", "payment_date", "amount_usd", "payment_method", "processor", "is_partial")


def events_normalized(spark, sf_dir) -> DataFrame:
    return normalize_product_events(parse_json_payloads(src.event_payloads(spark, sf_dir), EVENT_PAYLOAD_SCHEMA))


@query
def event_normalize_fallback(spark, sf_dir):
    return split_quarantine(events_normalized(spark, sf_dir))[0].select(*NON_LOAD_EVENT)


@query
def event_quarantine(spark, sf_dir):
    """Rejected event messages: every event rule and broken messages, each with its text."""
    rows = normalize_product_events(parse_json_payloads(messages.event_messages(spark, sf_dir), EVENT_PAYLOAD_SCHEMA))
    return split_quarantine(rows)[1].select("event_id", F.array_join("_errors", "; ").alias("errors"), F.col("_raw").alias("raw"))


@query
def erp_quarantine_rules(spark, sf_dir):
    """Rejected ERP rows: every invoice rule, each with its source row as JSON."""
    rejected = split_quarantine(canonicalize_invoices(messages.erp_text_rows(spark, sf_dir)))[1]
    return rejected.select("invoice_id", F.array_join("_errors", "; ").alias("errors"), F.col("_raw").alias("raw"))


def _repaired(raw, processor: str):
    """Repairs of the faults that a clerk could mend: empty invoice ids and empty amounts."""
    fixed = F.regexp_replace(raw, '"invoice_id":""', '"invoice_id":"INV-0"')
    return F.regexp_replace(fixed, '"amount_usd":""', '"amount_usd":"1.00"')


@query
def quarantine_replay(spark, sf_dir):
    """Manual webhooks: rejected records are repaired and replayed, twice; (record, payment) rows admitted, and those still open."""
    out = unique_dir(spark, "replay")
    path = os.path.join(out, "quarantine")
    split_quarantine(message_payments(spark, sf_dir, "manual"))[1].write.option("compression", CODEC).parquet(path)
    # stored once: two replays and the list of open records read them five times
    known = os.path.join(out, "records")
    replay.quarantine_records(spark.read.parquet(path), "payments/manual").write.option("compression", CODEC).parquet(known)
    records = spark.read.schema(replay.RECORDS).parquet(known)
    log = replay.ReplayLog(spark, os.path.join(out, "replays"), "payments/manual")
    repairs = records.select("record_id", _repaired(F.col("raw"), "manual").alias("text"))
    log.replay(records, repairs)
    log.replay(records, repairs)
    admitted = log.admitted().select(F.lit("admitted").alias("state"), "payment_id", "invoice_id", "amount_usd", F.lit("").alias("errors"))
    waiting = log.open_records(records).select(F.lit("open").alias("state"), F.lit(None).cast("string").alias("payment_id"),
                                               F.lit(None).cast("string").alias("invoice_id"), F.lit(None).cast("decimal(18,2)").alias("amount_usd"),
                                               F.array_join("errors", "; ").alias("errors"))
    return admitted.unionByName(waiting)


# --------------------------------------------------------------------------- dedupe (ingestion rules)


def canonical_valid(spark, sf_dir) -> DataFrame:
    return split_quarantine(canonicalize_invoices(src.raw_invoices(spark, sf_dir)))[0]


@query
def invoice_idempotency_key(spark, sf_dir):
    return with_idempotency_key(canonical_valid(spark, sf_dir)).select(
        "invoice_id", "source_system", "customer_id", "invoice_date", "idempotency_key")


@query
def invoice_first_wins(spark, sf_dir):
    return dedupe_invoices(canonical_valid(spark, sf_dir))


@query
def payment_first_wins(spark, sf_dir):
    return dedupe_payments(src.raw_payments(spark, sf_dir))


# --------------------------------------------------------------------------- data quality


FRESHNESS_NOW = "2024-01-31 01:00:00"

@query
def quality_invoices(spark, sf_dir):
    return r6(quality.validate_invoices(src.raw_invoices(spark, sf_dir)), "observed")


@query
def quality_payments(spark, sf_dir):
    return r6(quality.validate_payments(src.raw_payments(spark, sf_dir)), "observed")


@query
def quality_invoices_bad_values(spark, sf_dir):
    """Every status outside the set, with its rows."""
    return quality.invoice_bad_values(src.raw_invoices(spark, sf_dir))


@query
def quality_payments_bad_values(spark, sf_dir):
    """Every payment method outside the set, with its rows."""
    return quality.payment_bad_values(src.raw_payments(spark, sf_dir))


@query
def quality_summary(spark, sf_dir):
    """Success and failed checks of each code suite."""
    checks = quality.validate_invoices(src.raw_invoices(spark, sf_dir)).unionByName(
        quality.validate_payments(src.raw_payments(spark, sf_dir)))
    return quality.summarize(checks).withColumn("failures", F.array_join("failures", ", "))


@query
def quality_suite_json(spark, sf_dir):
    st = staged(spark, sf_dir)
    inv, pay = st.invoices, st.payments
    out = quality.run_expectation_suite(inv, "erp_invoices_suite").unionByName(
        quality.run_expectation_suite(pay, "payments_suite"))
    return r6(out, "unexpected_percent")


@query
def dbt_tests_report(spark, sf_dir):
    """Every model is built once, written to the shared folder, and tested there."""
    models = jobs.build_warehouse_models(*staged(spark, sf_dir), AS_OF, unique_dir(spark, "warehouse"))
    return quality.run_warehouse_tests(
        models, tests=[*quality.WAREHOUSE_TESTS, quality.EVENT_PARENT_TEST], observed=models.observed,
        singular={"assert_no_negative_outstanding": models.failures("negative_outstanding"),
                  "assert_no_overpayment": models.failures("overpaid")})


@query
def orphan_events(spark, sf_dir):
    st = staged(spark, sf_dir)
    inv, ev = st.invoices, st.events
    return quality.orphans(ev, inv, "invoice_id").select("event_id", "invoice_id")


def unclamped(ledger: DataFrame) -> DataFrame:
    """The ledger with plain balances: overpaid invoices become negative."""
    return ledger.withColumn("amount_outstanding_usd", F.col("amount_usd") - F.col("amount_paid_usd"))


@query
def negative_outstanding(spark, sf_dir):
    """The rule applied to plain balances, where overpaid invoices break it."""
    return negative_outstanding_rows(unclamped(ledger_dbt(spark, sf_dir)))


@query
def source_freshness(spark, sf_dir):
    inv, pay, ev = src.raw_tables(spark, sf_dir)
    out = quality.source_freshness({"erp_invoices": inv, "payment_events": pay, "product_events": ev},
                                   FRESHNESS_NOW)
    return r6(out, "age_hours")


@query
def volume_anomaly(spark, sf_dir):
    return r6(quality.volume_anomalies(staged(spark, sf_dir)[0]), "rolling_mean", "rolling_stddev")


@query
def currency_codes(spark, sf_dir):
    inv, pay, _ = src.raw_tables(spark, sf_dir)
    return quality.currency_report({"erp_invoices": inv, "payment_events": pay})


@query
def currency_codes_listed(spark, sf_dir):
    """Currencies against a code table: raw values are lower case and not in it, staged ones are."""
    st = staged(spark, sf_dir)
    codes = spark.createDataFrame([("USD",), ("EUR",)], "code string")
    return quality.currency_report({"raw": src.raw_invoices(spark, sf_dir), "staged": st.invoices}, codes)


@query
def invoice_record_derivations(spark, sf_dir):
    return with_invoice_derivations(canonical_valid(spark, sf_dir), AS_OF).select(
        "invoice_id", "source_system", "status", "_loaded_at", "days_outstanding", "is_overdue", "aging_bucket")


@query
def csv_quality_checkpoint(spark, sf_dir):
    """Raw tables exported as CSV to the shared folder, then checked there."""
    out = unique_dir(spark, "csv-export")
    src.raw_invoices(spark, sf_dir).write.option("header", True).csv(os.path.join(out, "invoices"))
    src.raw_payments(spark, sf_dir).write.option("header", True).csv(os.path.join(out, "payments"))
    return r6(jobs.run_local_checkpoint(spark, os.path.join(out, "invoices"), os.path.join(out, "payments")), "observed")


@query
def erp_csv_quoted_names(spark, sf_dir):
    """An ERP export with quoted names (commas, quotes, line breaks) written as CSV, read back and normalized."""
    out = os.path.join(unique_dir(spark, "erp-export"), "netsuite")
    export = src.erp_export(spark, sf_dir, "netsuite").withColumn(
        "entity_name", F.concat(F.col("entity_name"), F.lit(', "AR"\nDept')))
    export.write.option("header", True).option("escape", '"').option("quoteAll", True).csv(out)
    rows = normalize_erp(read_erp_csv(spark, out, "netsuite", multiline=True), "netsuite")
    return split_quarantine(rows)[0].select("invoice_id", "customer_id", "customer_name", "invoice_date", "amount_usd", "status")


@query
def erp_csv_sources(spark, sf_dir):
    """Exports of the two other ERPs as CSV, read back by header name and normalized; a third source has no file yet."""
    out, parts = unique_dir(spark, "erp-exports"), []
    for source in ("quickbooks", "sap"):
        src.erp_export(spark, sf_dir, source).write.option("header", True).option("escape", '"').option("quoteAll", True).csv(os.path.join(out, source))
    for source in VALID_SOURCES:
        rows = read_erp_csv(spark, os.path.join(out, source), source)
        parts.append(split_quarantine(normalize_erp(rows, source))[0])
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select(
        "invoice_id", "customer_id", "customer_name", "invoice_date", "due_date", "amount_usd", "status", "source_system", "line_items")


def _as_arrays(payloads: DataFrame, path: str) -> None:
    """JSON payloads written as text lines that hold an array of a few objects each."""
    # which objects share a line does not matter: four neighbours of a partition
    few = payloads.groupBy(F.floor(F.monotonically_increasing_id() / 4).alias("few")).agg(
        F.concat(F.lit("["), F.array_join(F.collect_list("value"), ","), F.lit("]")).alias("value"))
    sinks.write_messages(few.select("value"), path)


@query
def payment_json_arrays(spark, sf_dir):
    """Manual payments in files of JSON arrays, read and normalized; a folder that does not exist adds no rows."""
    path = os.path.join(unique_dir(spark, "payment-files"), "payments")
    _as_arrays(src.payment_payloads(spark, sf_dir, "manual"), path)
    rows = read_json_records(spark, path, FLAT_PAYMENT_PAYLOAD_SCHEMA, multiline=False).unionByName(
        read_json_records(spark, path + "-of-tomorrow", FLAT_PAYMENT_PAYLOAD_SCHEMA))
    return split_quarantine(normalize_payments(rows, "manual"))[0].select(*NON_LOAD_PAYMENT)


@query
def event_json_arrays(spark, sf_dir):
    """Product events in files of JSON arrays, read and normalized."""
    path = os.path.join(unique_dir(spark, "event-files"), "events")
    _as_arrays(src.event_payloads(spark, sf_dir), path)
    return split_quarantine(normalize_product_events(read_json_records(spark, path, EVENT_PAYLOAD_SCHEMA, multiline=False)))[0].select(*NON_LOAD_EVENT)


@query
def raw_payment_events(spark, sf_dir):
    """The raw payment table as a load stores it."""
    out = unique_dir(spark, "raw-load")
    jobs.load_raw_records(spark, *local_inputs(spark, sf_dir), out, as_of=AS_OF)
    return sinks.read_mart(spark, jobs.table_path(out, jobs.RAW_TABLES[1]))


@query
def staging_views(spark, sf_dir):
    """The staging models as session views over the raw tables: rows and keys of each."""
    out = unique_dir(spark, "raw-load")
    jobs.load_raw_records(spark, *local_inputs(spark, sf_dir), out, as_of=AS_OF)
    keys = {"stg_erp_invoices": "invoice_id", "stg_payments": "payment_id", "stg_product_events": "event_id"}
    parts = [spark.table(view).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(keys[view]).alias("keys")).select(
        F.lit(view).alias("view"), "rows", "keys") for view in jobs.create_staging_views(spark, out, AS_OF)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def publish_gate(spark, sf_dir):
    """The gated build over freshly loaded raw tables, as (stage, item) rows: what stopped it."""
    inv, pay, ev = local_inputs(spark, sf_dir)
    return _gate_rows(spark, *(freshly_loaded(t) for t in (inv, pay, ev)))


@query
def publish_gate_passed(spark, sf_dir):
    """The gated build over clean, freshly loaded tables: the mart that it publishes."""
    invoices = canonical_valid(spark, sf_dir)
    payments = split_quarantine(message_payments(spark, sf_dir, "bank"))[0]
    events = split_quarantine(normalize_product_events(parse_json_payloads(messages.event_messages(spark, sf_dir), EVENT_PAYLOAD_SCHEMA)))[0]
    latest = keep_latest(invoices, ["invoice_id", "source_system"], tiebreak=INVOICE_TIEBREAK)
    out = unique_dir(spark, "gated-build")
    jobs.load_raw_records(spark, *(freshly_loaded(t) for t in (latest, payments, events)), out, as_of=AS_OF)
    result = jobs.run_warehouse_build(spark, out, os.path.join(out, "warehouse"), AS_OF, now=FRESHNESS_NOW)
    if not result["published"]:
        raise RuntimeError(f"the clean build was stopped: {result}")
    mart = sinks.read_published(spark, os.path.join(out, "warehouse", "published"), "mrt_collections_health")
    return r6(mart, "avg_days_outstanding", "lifetime_collection_rate", "paid_within_30d_rate")


@query
def publish_gate_stale(spark, sf_dir):
    """The gated build with the real limits, which the driver tables' old loads do not keep."""
    return _gate_rows(spark, *local_inputs(spark, sf_dir))


def freshly_loaded(raw: DataFrame) -> DataFrame:
    """The rows as loaded an hour before ``FRESHNESS_NOW``: the driver tables' own load times lie between 1992 and 2024."""
    return raw.withColumn("_loaded_at", (F.lit(FRESHNESS_NOW).cast("timestamp_ntz") - F.expr("INTERVAL 1 HOUR")).cast("timestamp_ntz"))


def _gate_rows(spark, inv, pay, ev) -> DataFrame:
    out = unique_dir(spark, "gated-build")
    jobs.load_raw_records(spark, inv, pay, ev, out, as_of=AS_OF)
    result = jobs.run_warehouse_build(spark, out, os.path.join(out, "warehouse"), AS_OF, now=FRESHNESS_NOW)
    rows = [(result["stage"], str(result["published"]).lower(), f"{k}:{item}") for k, items in result.items()
            if isinstance(items, list) for item in items] or [(result["stage"], str(result["published"]).lower(), None)]
    found = spark.createDataFrame(rows, "stage string, published string, failed string")
    if "bad_values" not in result:
        return found
    return found.unionByName(spark.read.parquet(result["bad_values"]).select(
        F.lit(result["stage"]).alias("stage"), F.lit(str(result["published"]).lower()).alias("published"),
        F.concat(F.lit("bad_values:"), F.concat_ws(".", "suite", "column", "value")).alias("failed")))


# --------------------------------------------------------------------------- sinks


@query
def feature_snapshot_roundtrip(spark, sf_dir):
    """Features written as an ``as_of_date`` partition and read back with partition pruning."""
    path = unique_dir(spark, "feature-snapshots")
    sinks.write_feature_snapshot(customer_features(ledger_dbt(spark, sf_dir), AS_OF), path)
    return _features_out(sinks.read_feature_snapshot(spark, path, AS_OF))


@query
def invoice_upsert(spark, sf_dir):
    """First loads of two ERPs as the target; every second load and the third ERP's rows merged into it."""
    canon = canonical_valid(spark, sf_dir)
    loaded = (F.col("_loaded_at") == F.lit(src.FIRST_LOAD_AT).cast("timestamp_ntz")) & (F.col("source_system") != "sap")
    source = keep_latest(canon.where(~loaded), ["invoice_id", "source_system"],
                         tiebreak=["_source_file", "amount_usd", "status"])
    return sinks.upsert_invoices(canon.where(loaded), source)


#: Buckets of the incremental tables: the driver tables are small.
STORE_BUCKETS = 16


@query
def invoice_upsert_incremental(spark, sf_dir):
    """A stored table of two ERPs' first loads; second loads of some invoices and the third ERP are merged into the buckets they touch."""
    store = incremental.invoice_store(spark, os.path.join(unique_dir(spark, "invoice-store"), "invoices"), STORE_BUCKETS)
    canon = canonical_valid(spark, sf_dir)
    first = F.col("_loaded_at") == F.lit(src.FIRST_LOAD_AT).cast("timestamp_ntz")
    sap = F.col("source_system") == "sap"
    number = F.split("invoice_id", "-")[1].cast("bigint")
    incremental.upsert(store, canon.where(first & ~sap), "load", 0)
    incremental.upsert(store, canon.where(~first & ~sap & (number % 100 == 0)), "load", 1)
    incremental.upsert(store, canon.where(first & sap), "load", 2)
    incremental.upsert(store, canon.where(first & sap), "load", 2)      # a delivery that is repeated
    return store.read()


@query
def stg_invoices_incremental(spark, sf_dir):
    """The latest invoice of each key, kept up to date load by load; one load comes twice."""
    raw = src.raw_invoices(spark, sf_dir)
    store = incremental.invoice_store(spark, os.path.join(unique_dir(spark, "invoice-current"), "invoices"), STORE_BUCKETS)
    first = F.col("_loaded_at") == F.lit(src.FIRST_LOAD_AT).cast("timestamp_ntz")
    for load in (raw.where(~first), raw.where(first), raw.where(~first)):
        incremental.merge_latest(store, load, tiebreak=INVOICE_TIEBREAK)
    return invoice_columns(store.read(), AS_OF)


@query
def stg_payments_incremental(spark, sf_dir):
    """The latest payment of each id, kept up to date over loads by year."""
    raw = src.raw_payments(spark, sf_dir)
    store = incremental.payment_store(spark, os.path.join(unique_dir(spark, "payment-current"), "payments"), STORE_BUCKETS)
    late = F.year("_loaded_at") >= 1995
    for load in (raw.where(~late), raw.where(late), raw.where(~late)):
        incremental.merge_latest(store, load, tiebreak=PAYMENT_TIEBREAK)
    return payment_columns(store.read())


@query
def pipeline_lineage(spark, sf_dir):
    """Run the raw load and mart build on driver data; the run's lineage rows (stable columns)."""
    out = unique_dir(spark, "pipeline")
    inv, pay, ev = local_inputs(spark, sf_dir)
    run_id = jobs.load_raw_records(spark, inv, pay, ev, out, as_of=AS_OF)
    jobs.build_dashboard_marts(spark, out, AS_OF, run_id)
    return sinks.read_lineage(spark, jobs.lineage_path(out), run_id).select(
        "source_name", "target_table", "row_count", "transformation")


# --------------------------------------------------------------------------- streaming


def _stream_of(spark, sf_dir, name):
    """A driver table as a file stream (the source watches the folder, filtered to the table's file)."""
    schema = src.table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


@query
def stream_payment_dedupe(spark, sf_dir):
    """Payments arriving in three batches: the first copy of each id to arrive is kept, whole rows."""
    out = unique_dir(spark, "stream-payments")
    inbox, table, checkpoint = (os.path.join(out, d) for d in ("inbox", "table", "_checkpoint"))
    payments = src.raw_payments(spark, sf_dir)
    stream = spark.readStream.schema(payments.schema).parquet(os.path.join(inbox, "*"))
    supplier = F.split("_source_event", "/")[1].cast("bigint")
    for part in range(3):
        payments.where(supplier % 3 == part).write.option("compression", CODEC).parquet(os.path.join(inbox, f"part-{part}"))
        streams.run_available_now(stream, checkpoint, foreach_batch=streams.first_wins_batches(table, checkpoint, STORE_BUCKETS))
    return incremental.payment_store(spark, table, STORE_BUCKETS).read()


@query
def stream_payment_copies(spark, sf_dir):
    """Every payment delivered three times, each time with another amount, through the thinning stream: the first delivery stays."""
    out = unique_dir(spark, "stream-copies")
    inbox, table, checkpoint = (os.path.join(out, d) for d in ("inbox", "table", "_checkpoint"))
    payments = dedupe_payments(src.raw_payments(spark, sf_dir))
    stream = streams.dedupe_payment_stream(spark.readStream.schema(payments.schema).parquet(os.path.join(inbox, "*")))
    for part in range(3):
        # a delivery holds two thirds of the payments, so every payment arrives twice, first in delivery 0 or 1
        line = F.element_at(F.split("payment_id", "-"), -1).cast("int")
        delivery = payments.where(F.pmod(line - part, F.lit(3)) != 2).withColumn("amount_usd", (F.col("amount_usd") + part).cast("decimal(18,2)"))
        delivery.write.option("compression", CODEC).parquet(os.path.join(inbox, f"part-{part}"))
        streams.run_available_now(stream, checkpoint, foreach_batch=streams.first_wins_batches(table, checkpoint, STORE_BUCKETS))
    return incremental.payment_store(spark, table, STORE_BUCKETS).read().select("payment_id", "invoice_id", "amount_usd")


@query
def stream_touch_counts(spark, sf_dir):
    """Touch counts over three batches: a batch adds its partial counts, reading adds up a few partials."""
    out = unique_dir(spark, "stream-touches")
    inbox, table, checkpoint = (os.path.join(out, d) for d in ("inbox", "table", "_checkpoint"))
    events = src.raw_product_events(spark, sf_dir)
    stream = spark.readStream.schema(events.schema).parquet(os.path.join(inbox, "*"))
    for part in range(3):
        events.where(F.pmod(F.xxhash64("event_id"), F.lit(3)) == part).write.parquet(os.path.join(inbox, f"part-{part}"))
        streams.run_available_now(stream, checkpoint, foreach_batch=streams.touch_count_batches(table, checkpoint, STORE_BUCKETS))
    return incremental.touch_counts(incremental.touch_store(spark, table, STORE_BUCKETS))


def _event_sinks(spark, sf_dir, rendering=src.event_payloads) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine) of event JSON lines normalized as a stream."""
    out = unique_dir(spark, "stream-events")
    inbox, checkpoint = os.path.join(out, "inbox"), os.path.join(out, "_checkpoint")
    sinks.write_messages(rendering(spark, sf_dir), inbox)
    rows = streams.normalized_event_stream(streams.json_message_stream(spark, inbox))
    return streams.run_split(rows, os.path.join(out, "valid"), os.path.join(out, "quarantine"), checkpoint)


@query
def stream_event_normalize(spark, sf_dir):
    return _event_sinks(spark, sf_dir)[0].select(*NON_LOAD_EVENT)


@query
def stream_event_quarantine(spark, sf_dir):
    """Rejected event messages of a stream, each with its text."""
    return _event_sinks(spark, sf_dir, messages.event_messages)[1].select(
        "event_id", F.array_join("_errors", "; ").alias("errors"), F.col("_raw").alias("raw"))


@query
def stream_payment_normalize(spark, sf_dir):
    """Manual payment webhooks through the payment stream: (sink, payment) of both sinks."""
    out = unique_dir(spark, "stream-webhooks")
    inbox, checkpoint = os.path.join(out, "inbox"), os.path.join(out, "_checkpoint")
    sinks.write_messages(src.payment_payloads(spark, sf_dir, "manual"), inbox)
    rows = streams.normalized_payment_stream(streams.json_message_stream(spark, inbox), "manual")
    valid, bad = streams.run_split(rows, os.path.join(out, "valid"), os.path.join(out, "quarantine"), checkpoint)
    return valid.select(F.lit("valid").alias("sink"), "payment_id", "amount_usd", F.lit("").alias("errors")).unionByName(
        bad.select(F.lit("quarantine").alias("sink"), "payment_id", "amount_usd", F.array_join("_errors", "; ").alias("errors")))


@query
def stream_payment_messages(spark, sf_dir):
    """Faulty webhooks of all four processors through the payment stream: both sinks, rejected messages with their text."""
    out = None
    for processor in PROCESSORS:
        at = unique_dir(spark, f"stream-{processor}")
        inbox = os.path.join(at, "inbox")
        sinks.write_messages(messages.webhook_messages(spark, sf_dir, processor), inbox)
        rows = streams.normalized_payment_stream(streams.json_message_stream(spark, inbox), processor)
        valid, bad = streams.run_split(rows, os.path.join(at, "valid"), os.path.join(at, "quarantine"), os.path.join(at, "_checkpoint"))
        kept = valid.select(F.lit("valid").alias("sink"), "payment_id", F.lit(processor).alias("processor"), F.lit("").alias("errors"),
                            F.lit(None).cast("string").alias("raw"))
        part = kept.unionByName(bad.select(F.lit("quarantine").alias("sink"), "payment_id", F.lit(processor).alias("processor"),
                                           F.array_join("_errors", "; ").alias("errors"), F.col("_raw").alias("raw")))
        out = part if out is None else out.unionByName(part)
    return out


def registered() -> dict[str, Query]:
    """Public names (the ``_q`` suffix only avoids clashing with operator names)."""
    return {name[:-2] if name.endswith("_q") else name: fn for name, fn in QUERIES.items()}
