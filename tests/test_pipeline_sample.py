"""End-to-end run on a small drop of our own, as of 2025-09-15; expected values worked out by hand."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from arlark.operators.features import customer_features
from arlark.operators.ledger import build_ledger
from arlark.operators.marts import collections_health
from arlark.operators.metrics import metric_query
from arlark.operators import reports
from arlark.operators.staging import stg_erp_invoices, stg_payments, stg_product_events
from arlark.plans.jobs import MART_TABLES, RAW_TABLES, lineage_path, run_local_pipeline, table_path
from arlark.plans.sinks import lineage_frame, read_lineage, read_mart, read_published

AS_OF = dt.date(2025, 9, 15)

NETSUITE = """tranid,entity_id,entity_name,trandate,duedate,amount,currency,status,otherrefnum,line_count
N-11,C-81,Blue Kiln,2025-06-10,2025-07-10,900.50,usd,Open,A-1,2
N-12,C-82,"Otter, Reed & Sons",2025-08-20,2025-09-19,1200,usd,Open,,1
N-13,C-81,Blue Kiln,2025-09-01,2025-10-01,300,usd,Disputed,A-3,5
"""
QUICKBOOKS = """doc_number,customer_ref,customer_name,txn_date,due_date,total_amt,currency,status,po_number,line_count
Q-5,C-83,"Fern ""Hill"" Co",2025-07-05,2025-08-04,640,USD,Past Due,B-9,3
Q-6,C-82,"Otter, Reed & Sons",2025-05-01,2025-05-31,75.25,USD,Closed,,1
"""


def _payment(k, invoice, customer, day, amount, method):
    return {"event_id": f"hook-{k}", "payment_id": f"P-{k}", "invoice_id": invoice, "customer_id": customer, "payment_date": day,
            "amount_usd": amount, "currency": "USD", "payment_method": method, "reference_number": f"ref-{k}", "is_partial": k == 1}


def _event(k, invoice, customer, kind, at):
    return {"event_id": f"E-{k}", "invoice_id": invoice, "customer_id": customer, "event_type": kind, "occurred_at": at,
            "actor": "desk", "outcome": "opened"}


PAYMENTS = [_payment(1, "N-11", "C-81", "2025-07-20", "400.50", "ach"), _payment(2, "N-12", "C-82", "2025-09-10", "1200", "wire"),
            _payment(3, "Q-5", "C-83", "2025-08-14", "640", "check")]
EVENTS = [_event(1, "N-11", "C-81", "email_sent", "2025-08-20T10:00:00"), _event(2, "Q-5", "C-83", "call_logged", "2025-08-10T08:15:00"),
          _event(3, "N-11", "C-81", "reminder_triggered", "2025-09-12T07:00:00")]


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("sample")
    (root / "erp").mkdir()
    (root / "payments").mkdir()
    (root / "product_events").mkdir()
    (root / "erp" / "netsuite_invoices.csv").write_text(NETSUITE)
    (root / "erp" / "quickbooks_invoices.csv").write_text(QUICKBOOKS)
    (root / "payments" / "manual_payments.json").write_text(json.dumps(PAYMENTS))
    (root / "product_events" / "collection_events.json").write_text(json.dumps(EVENTS))
    out = str(tmp_path_factory.mktemp("out"))
    run_id = run_local_pipeline(spark, str(root), out, as_of=AS_OF)
    return out, run_id


def test_local_ledger(spark, run):
    out, _ = run
    ledger = {r.invoice_id: r for r in spark.read.parquet(table_path(out, MART_TABLES[0])).collect()}
    expect = {  # paid, outstanding, days, bucket, status, overdue, attempts
        "N-11": (400.5, 500, 97, "90+", "PARTIAL", True, 2),
        "N-12": (1200, 0, 26, "0-30", "PAID", False, 0),
        "N-13": (0, 300, 14, "0-30", "DISPUTED", False, 0),
        "Q-5": (640, 0, 72, "61-90", "PAID", False, 1),
        "Q-6": (0, 75.25, 137, "90+", "PAID", True, 0),
    }
    assert set(ledger) == set(expect)
    for inv, values in expect.items():
        r = ledger[inv]
        assert (r.amount_paid_usd, r.amount_outstanding_usd, r.days_outstanding, r.aging_bucket, r.status,
                r.is_overdue, r.collection_attempt_count) == values
    assert ledger["N-11"].last_outreach_at == dt.datetime(2025, 9, 12, 7)
    assert ledger["N-12"].customer_name == "Otter, Reed & Sons" and ledger["Q-5"].customer_name == 'Fern "Hill" Co'


def test_local_mart_and_lineage(spark, run):
    out, run_id = run
    mart = {r.customer_id: r for r in read_mart(spark, table_path(out, MART_TABLES[1])).collect()}
    c = mart["C-81"]
    assert (c.invoice_count, c.lifetime_invoiced_usd, c.lifetime_paid_usd, c.total_outstanding_usd) == (2, 1200.5, 400.5, 800)
    assert (c.overdue_invoice_count, c.avg_days_outstanding, c.ar_risk_band) == (1, 55.5, "high")
    assert round(c.lifetime_collection_rate, 6) == 0.333611
    assert (mart["C-83"].ar_risk_band, mart["C-83"].paid_within_30d_rate) == ("low", 0.0)
    assert (mart["C-82"].ar_risk_band, mart["C-82"].paid_within_30d_rate) == ("high", 0.5)
    assert sum(r.total_outstanding_usd for r in mart.values()) == 875.25
    lineage = read_lineage(spark, lineage_path(out), run_id).collect()
    assert {r.target_table: r.row_count for r in lineage} == {
        RAW_TABLES[0]: 5, RAW_TABLES[1]: 3, RAW_TABLES[2]: 3, MART_TABLES[0]: 5, MART_TABLES[1]: 3}


def test_lineage_counts_beyond_32_bits(spark):
    assert lineage_frame(spark, "r", [("s", "t", 3_000_000_000, "x")]).first().row_count == 3_000_000_000


def test_mart_reader_takes_paths_and_tables(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "m"))
    spark.range(2).write.option("header", True).csv(str(tmp_path / "m.csv"))
    spark.range(4).createOrReplaceTempView("some_mart")
    assert [read_mart(spark, x).count() for x in (str(tmp_path / "m"), str(tmp_path / "m.csv"), "some_mart")] == [3, 2, 4]


def test_dbt_form_differs_on_paid_invoice(spark, run):
    out, _ = run
    raw = [spark.read.parquet(table_path(out, t)) for t in RAW_TABLES]
    ledger = build_ledger(stg_erp_invoices(raw[0], AS_OF), stg_payments(raw[1]), stg_product_events(raw[2]),
                          AS_OF, form="dbt")
    r = ledger.where(F.col("invoice_id") == "Q-5").first()
    assert (r.status, r.is_overdue) == ("PAID", True)   # source status was OVERDUE
    assert len(ledger.columns) == 23
    m = metric_query(ledger, ["days_sales_outstanding", "collection_rate", "ar_outstanding",
                              "overdue_invoice_count"]).first()
    assert m.days_sales_outstanding == 55.5 and round(m.collection_rate, 6) == 0.719089
    assert float(m.ar_outstanding) == 875.25 and m.overdue_invoice_count == 2


def test_reports_and_features(spark, run):
    out, _ = run
    mart = spark.read.parquet(table_path(out, MART_TABLES[1]))
    tiles = reports.kpi_tiles(mart).first()
    assert float(tiles.ar_outstanding_usd) == 875.25 and round(tiles.pct_overdue, 6) == 0.657241
    assert round(tiles.avg_invoice_age_days, 4) == 69.6667 and round(tiles.collection_rate, 6) == 0.758201
    funnel = {r.stage: r.amount for r in reports.funnel(mart).collect()}
    assert round(funnel["Invoiced"], 1) == 1154.4 and funnel["In Active Collections"] == 800
    aging = {r.bucket: float(r.amount_usd) for r in reports.aging_summary(mart).collect()}
    assert aging == {"0-30": 300, "31-60": 0, "61-90": 0, "90-plus": 575.25}
    assert {r.customer_id for r in reports.health_table(mart, bands=["low"]).collect()} == {"C-83"}
    ledger = spark.read.parquet(table_path(out, MART_TABLES[0]))
    f = {r.customer_id: r for r in customer_features(ledger, AS_OF).collect()}
    assert (f["C-81"].avg_days_to_pay_90d, f["C-81"].days_since_last_payment, f["C-81"].collection_attempts_30d) == (40.0, 57, 2)
    assert (round(f["C-81"].outstanding_pct_of_credit, 6), f["C-81"].pct_90_plus, f["C-81"].pct_current) == (0.008, 0.625, 0.375)
    assert f["C-82"].pct_90_plus == 1.0 and f["C-82"].days_since_last_payment == 5


def test_raw_invoices_carry_record_derivations(spark, run):
    out, _ = run
    r = spark.read.parquet(table_path(out, RAW_TABLES[0])).where(F.col("invoice_id") == "Q-5").first()
    assert (r.days_outstanding, r.aging_bucket, r.is_overdue) == (72, "61-90", True)


def test_staging_views(spark, run):
    from arlark.plans.jobs import create_staging_views

    out, _ = run
    assert create_staging_views(spark, out, AS_OF) == ["stg_erp_invoices", "stg_payments", "stg_product_events"]
    assert spark.sql("select count(*) n from stg_erp_invoices join stg_payments using (invoice_id)").first().n == 3


def test_publish_gate(spark, run, tmp_path):
    from arlark.plans.jobs import run_warehouse_build

    out, _ = run
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    target = str(tmp_path / "ok")
    for _ in range(2):
        done = run_warehouse_build(spark, out, target, as_of=AS_OF, now=now, check_volume=False)
        assert done["published"] is True
    mart = read_published(spark, str(tmp_path / "ok" / "published"), "mrt_collections_health")
    assert mart.count() == 3 and done["run_id"] in mart.inputFiles()[0]
    odd = run_warehouse_build(spark, out, str(tmp_path / "odd"), as_of=AS_OF, now=now)
    assert odd["stage"] == "checks" and odd["odd_volume"] and not odd["failed_tests"]
    codes = spark.createDataFrame([("EUR",)], "code string")
    foreign = run_warehouse_build(spark, out, str(tmp_path / "eur"), as_of=AS_OF, now=now, iso_codes=codes, check_volume=False)
    assert foreign["wrong_currency"] == ["stg_erp_invoices", "stg_payments"]
    stale = run_warehouse_build(spark, out, str(tmp_path / "stale"), as_of=AS_OF, now=dt.datetime(2099, 1, 1))
    assert (stale["published"], stale["stage"], len(stale["stale"])) == (False, "freshness", 3)
    assert not (tmp_path / "stale" / "published").exists() and not (tmp_path / "odd" / "published").exists()


def test_strict_run_stores_the_quarantine_before_it_fails(spark, tmp_path):
    (tmp_path / "in" / "erp").mkdir(parents=True)
    (tmp_path / "in" / "erp" / "netsuite_invoices.csv").write_text(NETSUITE + "N-14,,Nobody,2025-09-01,2025-10-01,5,usd,Open,,1\n")
    with pytest.raises(ValueError, match="1 invoices, 0 payments"):
        run_local_pipeline(spark, str(tmp_path / "in"), str(tmp_path / "out"), as_of=AS_OF)
    assert spark.read.parquet(str(tmp_path / "out" / "quarantine" / "erp_invoices")).first()._errors == ["missing customer_id"]


def test_local_checkpoint_on_csv(spark, tmp_path):
    from arlark.plans.jobs import run_local_checkpoint

    p = tmp_path / "inv.csv"
    p.write_text("invoice_id,customer_id,amount_usd,status,currency\nA,C,10,OPEN,USD\nB,C,-1,void,usd\n")
    res = {r.check: r.passed for r in run_local_checkpoint(spark, erp_csv=str(p)).collect()}
    assert res == {"invoice_id_not_null": True, "customer_id_null_rate": True, "amount_non_negative": False,
                   "status_in_set": False, "currency_iso_like": False}


def test_gate_names_every_failed_check(spark):
    from arlark.operators.quality import assert_passed

    rows = [("s", f"check_{k:02d}", k % 2 == 0) for k in range(60)]
    with pytest.raises(RuntimeError) as error:
        assert_passed(spark.createDataFrame(rows, "suite string, check string, passed boolean"))
    assert all(f"s.check_{k:02d}" in str(error.value) for k in range(1, 60, 2))


def test_bad_values_are_grouped_rows(spark):
    from arlark.operators.quality import bad_values

    df = spark.createDataFrame([("void",), ("VOID",), ("open",), (None,), ("gone",)], "status string")
    assert {(r.value, r.rows) for r in bad_values(df, "status", ["OPEN"], F.upper).collect()} == {("VOID", 2), ("GONE", 1)}


def test_every_bad_value_is_reported(spark, run, tmp_path):
    from arlark.plans.jobs import _raw_tables, local_bad_values, run_warehouse_build
    from arlark.plans.sinks import write_table

    inv, pay = tmp_path / "inv.csv", tmp_path / "pay.csv"
    inv.write_text("invoice_id,customer_id,amount_usd,status,currency\nA,C,1,OPEN,USD\nB,C,1,void,USD\nD,C,1,Gone,USD\nE,C,1,VOID,USD\n")
    pay.write_text("payment_id,amount_usd,payment_method\nA,1,ach\nB,1,Cash\nC,1,card\n")
    assert {tuple(r) for r in local_bad_values(spark, str(inv), str(pay)).collect()} == {
        ("erp_invoices", "status", "VOID", 2), ("erp_invoices", "status", "GONE", 1),
        ("payments", "payment_method", "cash", 1), ("payments", "payment_method", "card", 1)}

    raw = str(tmp_path / "raw")
    tables = _raw_tables(spark, run[0])
    first = tables["erp_invoices"].agg(F.min("invoice_id")).first()[0]
    status = F.when(F.col("invoice_id") == first, "VOID").otherwise("GONE")
    for name, df in {**tables, "erp_invoices": tables["erp_invoices"].withColumn("status", status)}.items():
        write_table(df, table_path(raw, f"raw.{name}"))
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    done = run_warehouse_build(spark, raw, str(tmp_path / "out"), as_of=AS_OF, now=now, check_volume=False)
    assert "erp_invoices.status_in_set" in done["failed_checks"]
    assert {r.value for r in spark.read.parquet(done["bad_values"]).where("suite = 'erp_invoices'").collect()} == {"VOID", "GONE"}


def test_erp_csv_headers_quotes_and_paths(spark, tmp_path):
    from arlark.operators.normalize import normalize_erp
    from arlark.sources.files import read_erp_csv

    folder = tmp_path / "sap"
    folder.mkdir()
    (folder / "a.csv").write_text("net_value,extra,billing_document,sold_to_party,billing_date,net_due_date,status,customer_name\n"
                                  '41.5,x,D-1,C-9,2025-03-01,2025-03-31,Closed,"Moss ""M"", Ltd\nDept 4"\n')
    (folder / "b.csv").write_text("sold_to_party,billing_document,billing_date,net_due_date,status,net_value\n"
                                  "C-8,D-2,2025-03-02,2025-04-01,Open,7\n")
    rows = {r.invoice_id: r for r in normalize_erp(read_erp_csv(spark, str(folder), "sap", multiline=True), "sap").collect()}
    assert set(rows) == {"D-1", "D-2"} and all(r._errors == [] for r in rows.values())
    assert rows["D-1"].customer_name == 'Moss "M", Ltd\nDept 4' and rows["D-1"].status == "PAID"
    assert (rows["D-2"].customer_id, float(rows["D-2"].amount_usd), rows["D-2"].customer_name) == ("C-8", 7.0, None)
    assert rows["D-1"]._source_file.endswith("/sap/a.csv") and rows["D-1"]._source_file.startswith("file:")
    for missing in (str(tmp_path / "none.csv"), "file://" + str(tmp_path / "none" / "*.csv")):
        empty = read_erp_csv(spark, missing, "sap")
        assert empty.count() == 0 and "billing_document" in empty.columns


def test_load_filters_reach_the_scan(spark, run):
    from arlark.operators.normalize import canonicalize_invoices, split_quarantine

    out, _ = run
    raw = spark.read.parquet(table_path(out, RAW_TABLES[0]))
    cut = split_quarantine(canonicalize_invoices(raw))[0].where(F.col("_loaded_at") >= F.lit("2025-01-01").cast("timestamp_ntz"))
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(_loaded_at" in plan[plan.index("PushedFilters"):]


def test_headers_of_many_files_are_one_job(spark, tmp_path):
    """Files in two column orders, one with a byte-order mark, one empty: rows by name; a name given twice is an error."""
    from arlark.sources import files as src_files

    a = "tranid,entity_id,entity_name,trandate,duedate,amount,currency,status,otherrefnum,line_count"
    b = 'status,"tranid",amount,entity_id,extra'
    for k in range(src_files.FEW_FILES + 6):
        text = f"{a}\nT{k},C{k},N,2025-01-01,2025-02-01,{k},USD,Open,R,1\n" if k % 2 else f"﻿{b}\nOpen,T{k},{k},C{k},x\n"
        (tmp_path / f"n {k:02d}.csv").write_text(text, encoding="utf-8")
    (tmp_path / "n none.csv").write_text("")
    rows = src_files.read_erp_csv(spark, str(tmp_path / "*.csv"), "netsuite").collect()
    assert {(r.tranid, r.entity_id, r.amount, r.status) for r in rows} == {(f"T{k}", f"C{k}", str(k), "Open") for k in range(src_files.FEW_FILES + 6)}
    assert {r.currency for r in rows} == {"USD", None}
    (tmp_path / "n zz.csv").write_text("tranid,amount,tranid\nT,1,U\n")
    with pytest.raises(ValueError, match="tranid more than once"):
        src_files.read_erp_csv(spark, str(tmp_path / "*.csv"), "netsuite")
    with pytest.raises(ValueError, match="tranid more than once"):
        src_files.read_erp_csv(spark, str(tmp_path / "n zz.csv"), "netsuite")
