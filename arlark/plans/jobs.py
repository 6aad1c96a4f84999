"""End-to-end jobs.

``run_local_pipeline``: source files -> normalize (quarantine split) -> first
wins dedupe -> raw tables -> local-rule ledger and mart, five lineage rows.

``run_warehouse_build``: raw tables -> freshness gate -> staging -> ledger ->
dimension and marts -> warehouse tests and quality suites -> publish only if
every gate passed.

Intermediate results are written tables in the output folder (a shared
location on a cluster), which also cuts lineage between stages so a lost
executor only recomputes the current stage.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arlark.operators.dedupe import dedupe_invoices, keep_first
from arlark.operators.ledger import build_ledger, negative_outstanding
from arlark.operators.marts import collections_health, dim_customers
from arlark.operators.normalize import (
    normalize_erp, normalize_payments, normalize_product_events, split_quarantine, with_invoice_derivations,
)
from arlark.operators.quality import (
    FRESHNESS_HOURS, currency_report, invoice_bad_values, payment_bad_values, row_test_measures, run_expectation_suite,
    run_warehouse_tests, source_freshness, validate_invoices, validate_payments, volume_anomalies,
)
from arlark.operators.staging import stg_erp_invoices, stg_payments, stg_product_events
from arlark.plans.bucket_store import CODEC, Files
from arlark.plans.sinks import append_lineage, publish, write_observed, write_table
from arlark.schemas import (
    EVENT_PAYLOAD_SCHEMA, EVENT_SCHEMA, FLAT_PAYMENT_PAYLOAD_SCHEMA, INVOICE_SCHEMA, PAYMENT_SCHEMA,
)
from arlark.session import prepare, unique_dir
from arlark.sources.files import list_sample_files, read_erp_csv, read_json_records

RAW_TABLES = ["raw.erp_invoices", "raw.payment_events", "raw.product_events"]
MART_TABLES = ["analytics_marts.fct_ar_ledger", "analytics_marts.mrt_collections_health"]


def table_path(out_dir: str, name: str) -> str:
    return os.path.join(out_dir, *name.split("."))


def lineage_path(out_dir: str) -> str:
    return os.path.join(out_dir, "metadata", "pipeline_lineage")


def load_raw_records(spark: SparkSession, invoices: DataFrame, payments: DataFrame, events: DataFrame,
                     out_dir: str, run_id: str | None = None, source_name: str = "local_sample_data",
                     as_of=None) -> str:
    """Full-replace load of the three raw tables under one run id, one lineage row each.

    Invoices carry the record's derived fields (days outstanding, overdue,
    bucket) as of ``as_of`` next to the canonical columns.
    """
    run_id = run_id or str(uuid.uuid4())
    entries = []
    inv_cols = [f.name for f in INVOICE_SCHEMA.fields] + ["days_outstanding", "is_overdue", "aging_bucket"]
    inv = with_invoice_derivations(invoices.select(*[f.name for f in INVOICE_SCHEMA.fields]), as_of)
    for name, df, cols in [(RAW_TABLES[0], inv, inv_cols),
                           (RAW_TABLES[1], payments, [f.name for f in PAYMENT_SCHEMA.fields]),
                           (RAW_TABLES[2], events, [f.name for f in EVENT_SCHEMA.fields])]:
        n = write_table(df.select(*cols), table_path(out_dir, name))
        entries.append((source_name, name, n, "normalize_source_payloads"))
    append_lineage(spark, lineage_path(out_dir), run_id, entries)
    return run_id


def build_dashboard_marts(spark: SparkSession, out_dir: str, as_of=None, run_id: str | None = None) -> str:
    """Local-rule ledger and customer mart from the raw tables, one lineage row each."""
    run_id = run_id or str(uuid.uuid4())
    inv = spark.read.schema(INVOICE_SCHEMA).parquet(table_path(out_dir, RAW_TABLES[0]))
    pay = spark.read.schema(PAYMENT_SCHEMA).parquet(table_path(out_dir, RAW_TABLES[1]))
    ev = spark.read.schema(EVENT_SCHEMA).parquet(table_path(out_dir, RAW_TABLES[2]))
    ledger_path = table_path(out_dir, MART_TABLES[0])
    n_ledger = write_table(build_ledger(inv, pay, ev, as_of, form="local"), ledger_path)
    ledger = spark.read.parquet(ledger_path)
    n_mart = write_table(collections_health(ledger, form="local"), table_path(out_dir, MART_TABLES[1]))
    append_lineage(spark, lineage_path(out_dir), run_id, [
        ("raw.*", MART_TABLES[0], n_ledger, "build_dashboard_marts"),
        ("raw.*", MART_TABLES[1], n_mart, "build_dashboard_marts"),
    ])
    return run_id


def _stored_split(spark: SparkSession, rows: DataFrame, out_dir: str, name: str) -> tuple[DataFrame, int]:
    """Write the normalized rows once, then the quarantine; (valid rows as stored, number quarantined)."""
    path = os.path.join(out_dir, "normalized", name)
    write_table(rows, path)
    valid, bad = split_quarantine(spark.read.schema(rows.schema).parquet(path))
    return valid, write_table(bad, os.path.join(out_dir, "quarantine", name))


def run_local_pipeline(spark: SparkSession, sample_dir: str, out_dir: str, as_of=None,
                       strict: bool = True) -> str:
    """Sample files -> raw tables -> marts.  ``strict`` fails on any quarantined record, after storing them all.

    First wins is decided by an explicit input order: source (netsuite,
    quickbooks, sap), then file and position within the file.
    """
    prepare(spark)
    files = list_sample_files(sample_dir)
    keep = ["_src_order", "_input_seq"]
    erp_parts = []
    for order, source in enumerate(["netsuite", "quickbooks", "sap"]):
        rows = read_erp_csv(spark, files[source], source).withColumn("_src_order", F.lit(order))
        erp_parts.append(normalize_erp(rows, source, source_file=F.col("_source_file"), keep=keep))
    invoices = erp_parts[0]
    for p in erp_parts[1:]:
        invoices = invoices.unionByName(p)
    inv_valid, inv_bad = _stored_split(spark, invoices, out_dir, "erp_invoices")

    pay_rows = read_json_records(spark, files["payments"], FLAT_PAYMENT_PAYLOAD_SCHEMA)
    pay_valid, pay_bad = _stored_split(
        spark, normalize_payments(pay_rows, "manual", keep=["_source_file", "_input_seq"]), out_dir, "payment_events")
    ev_rows = read_json_records(spark, files["product_events"], EVENT_PAYLOAD_SCHEMA)
    ev_valid, ev_bad = _stored_split(spark, normalize_product_events(ev_rows), out_dir, "product_events")
    if strict and inv_bad + pay_bad + ev_bad:
        raise ValueError(f"quarantine is not empty: {inv_bad} invoices, {pay_bad} payments, {ev_bad} events "
                         f"under {os.path.join(out_dir, 'quarantine')}")

    run_id = load_raw_records(
        spark,
        dedupe_invoices(inv_valid, sequence=("_src_order", "_source_file", "_input_seq")),
        keep_first(pay_valid, ["payment_id"], ["_source_file", "_input_seq"]),
        ev_valid,                      # product events are loaded as received, not deduplicated
        out_dir,
        as_of=as_of,
    )
    build_dashboard_marts(spark, out_dir, as_of, run_id)
    return run_id


MODELS = ["fct_ar_ledger", "dim_customers", "mrt_collections_health"]


class WarehouseModels(dict):
    """The models by name; ``observed`` holds the row-level tests of each, counted while it was written."""

    def __init__(self):
        super().__init__()
        self.observed: dict[str, dict] = {}

    def failures(self, name: str) -> int:
        """A further measure of the ledger that was observed."""
        return self.observed["fct_ar_ledger"][name]


def build_warehouse_models(invoices: DataFrame, payments: DataFrame, events: DataFrame, as_of, build_dir: str) -> WarehouseModels:
    """All models, each written once under ``build_dir`` and read back: staging, ledger, dimension, mart.

    Row-level tests are observed in the writes, so testing reads models for ``unique`` and ``relationships`` only.
    """
    spark = invoices.sparkSession
    models = WarehouseModels()

    def build(name: str, df: DataFrame, **more: Column) -> DataFrame:
        path = os.path.join(build_dir, name)
        models.observed[name] = write_observed(df, path, {**row_test_measures(name), **more})
        models[name] = spark.read.schema(df.schema).parquet(path)
        return models[name]

    inv, pay, ev = build("stg_erp_invoices", invoices), build("stg_payments", payments), build("stg_product_events", events)
    ledger = build("fct_ar_ledger", build_ledger(inv, pay, ev, as_of, form="dbt"),
                   negative_outstanding=F.count_if(F.col("amount_outstanding_usd") < 0),
                   overpaid=F.count_if(F.col("amount_usd") < F.col("amount_paid_usd")))
    build("dim_customers", dim_customers(ledger))
    build("mrt_collections_health", collections_health(ledger, form="dbt"))
    return models


#: Bytes of source files for each bucket: a row is several times as large in a staging table as in a columnar source.
BUCKET_SOURCE_BYTES = 16 << 20


def _buckets_for(*frames: DataFrame) -> int:
    """Buckets that grow with the files behind the frames; at least the shuffle partitions."""
    spark = frames[0].sparkSession
    files = {f for df in frames for f in df.inputFiles()}
    size = sum(Files(spark, f).size(f) for f in files)
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_SOURCE_BYTES))


def copartitioned_ledger(invoices: DataFrame, payments: DataFrame, events: DataFrame, as_of=None, buckets: int | None = None,
                         name: str = "arlark") -> DataFrame:
    """The ledger (dbt form) over staging tables that are stored in buckets of ``invoice_id``.

    Raw tables are deduplicated and stored as external tables ``<name>_<model>_<run>`` of the session's catalog, one file
    for each bucket.  Payment and touch aggregates and both ledger joins then need no exchange: only the customer's unapplied cash moves rows.
    """
    spark = prepare(invoices.sparkSession)
    buckets = buckets or _buckets_for(payments, invoices, events)
    run = uuid.uuid4().hex[:12]

    def store(model: str, df: DataFrame) -> DataFrame:
        table = f"{name}_{model}_{run}"
        # dealt like the buckets: every task writes one file
        df.repartition(buckets, "invoice_id").write.bucketBy(buckets, "invoice_id").sortBy("invoice_id").option("compression", CODEC).option(
            "path", os.path.join(unique_dir(spark, "bucketed"), model)).saveAsTable(table)
        return spark.table(table)

    inv = store("stg_erp_invoices", stg_erp_invoices(invoices, as_of))
    pay, ev = store("stg_payments", stg_payments(payments)), store("stg_product_events", stg_product_events(events))
    return build_ledger(inv, pay, ev, as_of, form="dbt")


def create_staging_views(spark: SparkSession, raw_dir: str, as_of=None) -> list[str]:
    """The staging models as session views over the raw tables, by their model names."""
    raw = _raw_tables(spark, raw_dir)
    views = {"stg_erp_invoices": stg_erp_invoices(raw["erp_invoices"], as_of), "stg_payments": stg_payments(raw["payment_events"]),
             "stg_product_events": stg_product_events(raw["product_events"])}
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)


def _raw_tables(spark: SparkSession, raw_dir: str) -> dict[str, DataFrame]:
    return {name.split(".")[1]: spark.read.schema(schema).parquet(table_path(raw_dir, name))
            for name, schema in zip(RAW_TABLES, (INVOICE_SCHEMA, PAYMENT_SCHEMA, EVENT_SCHEMA))}


def gate_findings(raw: dict[str, DataFrame], models: dict[str, DataFrame], iso_codes: DataFrame | None = None,
                  check_volume: bool = True) -> dict[str, list[str]]:
    """Everything that stops a publish, by kind (every list has at most one entry for each declared check).

    Warehouse tests, the code checks, the declared expectation suites,
    the last day's volume by source, and currencies that are not of the form or, given a
    code table, not in it.
    """
    observed = getattr(models, "observed", None)
    negative = models.failures("negative_outstanding") if observed else negative_outstanding(models["fct_ar_ledger"])
    tests = run_warehouse_tests(models, singular={"assert_no_negative_outstanding": negative}, observed=observed)
    checks = validate_invoices(raw["erp_invoices"]).unionByName(validate_payments(raw["payment_events"]))
    suites = run_expectation_suite(models["stg_erp_invoices"], "erp_invoices_suite").unionByName(
        run_expectation_suite(models["stg_payments"], "payments_suite"))
    volume = volume_anomalies(models["stg_erp_invoices"])
    last = volume.groupBy("source_system").agg(F.max_by("is_anomaly", "invoice_date").alias("odd")).where("odd")
    currency = currency_report({"stg_erp_invoices": models["stg_erp_invoices"], "stg_payments": models["stg_payments"]}, iso_codes)
    wrong = ~F.col("iso_like") if iso_codes is None else ~(F.col("iso_like") & F.col("in_code_list"))

    def names(df: DataFrame, *columns: str) -> list[str]:
        return sorted(r[0] for r in df.select(F.concat_ws(".", *columns)).collect())

    return {"failed_tests": names(tests.where("status = 'fail'"), "model", "column", "test"),
            "failed_checks": names(checks.where("not passed"), "suite", "check"),
            "failed_suites": names(suites.where("not success"), "suite", "expectation_type", "column"),
            "odd_volume": names(last, "source_system") if check_volume else [],
            "wrong_currency": names(currency.where(wrong).select("table_name").distinct(), "table_name")}


def run_warehouse_build(spark: SparkSession, raw_dir: str, out_dir: str, as_of=None, now=None,
                        freshness: dict | None = None, iso_codes: DataFrame | None = None, check_volume: bool = True) -> dict:
    """Freshness -> build -> tests and quality -> publish; a failed gate stops before publishing.

    Returns the gate results; marts are published under ``out_dir/published``
    (see ``sinks.read_published``) only when every gate passed.  A build that the checks stop stores
    every value outside its set as (suite, column, value, rows); ``bad_values`` is that table's path.  ``check_volume=False`` is
    for sources without enough history for the three-sigma rule.
    """
    prepare(spark)
    now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    raw = _raw_tables(spark, raw_dir)
    fresh_rows = source_freshness(raw, now, thresholds=freshness or FRESHNESS_HOURS).collect()    # one row per source
    stale = sorted(r.source for r in fresh_rows if r.status == "error")
    if stale:
        return {"published": False, "stage": "freshness", "stale": stale}

    run_id = uuid.uuid4().hex
    build = os.path.join(out_dir, "build", run_id)
    models = build_warehouse_models(
        stg_erp_invoices(raw["erp_invoices"], as_of), stg_payments(raw["payment_events"]),
        stg_product_events(raw["product_events"]), as_of, build)
    findings = gate_findings(raw, models, iso_codes, check_volume)
    if any(findings.values()):
        bad = os.path.join(out_dir, "bad_values", run_id)
        write_table(invoice_bad_values(raw["erp_invoices"]).unionByName(payment_bad_values(raw["payment_events"])), bad)
        return {"published": False, "stage": "checks", **findings, "bad_values": bad}
    publish(spark, build, os.path.join(out_dir, "published"), run_id, MODELS)
    return {"published": True, "stage": "publish", "run_id": run_id}


def run_local_checkpoint(spark: SparkSession, erp_csv: str | None = None,
                         payments_csv: str | None = None) -> DataFrame | None:
    """Quality suites over exported CSV files (canonical column names, header row).

    Amount columns are read as decimals (a malformed number is NULL, so it is
    neither negative nor positive); everything else as text.
    """
    return _over_csv(spark, (erp_csv, validate_invoices), (payments_csv, validate_payments))


def local_bad_values(spark: SparkSession, erp_csv: str | None = None,
                     payments_csv: str | None = None) -> DataFrame | None:
    """(suite, column, value, rows) of every value outside its set, over the files of ``run_local_checkpoint``."""
    return _over_csv(spark, (erp_csv, invoice_bad_values), (payments_csv, payment_bad_values))


def _over_csv(spark: SparkSession, *checks) -> DataFrame | None:
    """Union of ``check(rows)`` over the files that are given."""
    prepare(spark)
    parts = []
    for path, check in checks:
        if path:
            rows = spark.read.option("header", True).option("inferSchema", False).option("escape", '"').csv(path)
            parts.append(check(rows.withColumn("amount_usd", F.col("amount_usd").try_cast("decimal(18,2)"))))
    if not parts:
        return None
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
