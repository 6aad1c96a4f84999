"""Normalizers: source maps, rejection reasons, Stripe flattening, event fallbacks, dedupe."""

import datetime as dt
import json
from decimal import Decimal

from pyspark.sql import functions as F

from arlark.operators.dedupe import dedupe_invoices, dedupe_payments
from arlark.operators.normalize import (
    normalize_erp, normalize_payments, normalize_product_events, parse_json_payloads, split_quarantine,
)
from arlark.schemas import (
    EVENT_PAYLOAD_SCHEMA, FLAT_PAYMENT_PAYLOAD_SCHEMA, STRIPE_PAYLOAD_SCHEMA, erp_source_schema,
)


def erp(spark, source, rows):
    schema = erp_source_schema(source)
    full = [tuple(r.get(f.name) for f in schema.fields) for r in rows]
    return normalize_erp(spark.createDataFrame(full, schema), source, source_file=f"{source.lower()}.csv")


def test_netsuite_row(spark):
    df = erp(spark, "NetSuite", [dict(tranid="B-31", entity_id="K7", entity_name="Blue Kiln",
                                      trandate="2025-04-02", duedate="2025-05-02", amount="318.40", currency="usd",
                                      status="Open", otherrefnum="R-2", line_count="6")])
    r = df.first()
    assert r.invoice_id == "B-31" and r.customer_name == "Blue Kiln"
    assert r.amount_usd == Decimal("318.40") and r.status == "OPEN" and r.currency == "USD"
    assert r.source_system == "netsuite" and r.line_items == 6 and r._source_file == "netsuite.csv"
    assert r._errors == []


def test_quickbooks_and_sap_status(spark):
    qb = erp(spark, "quickbooks", [dict(doc_number="Q-51", customer_ref="K8", txn_date="2025-04-12",
                                        due_date="2025-05-20", total_amt="62", currency="USD",
                                        status="Partially Paid")]).first()
    sap = erp(spark, "sap", [dict(billing_document="D-404", sold_to_party="K9", billing_date="2025-05-20",
                                  net_due_date="2025-06-19", net_value="88.8", currency="USD",
                                  status="Closed")]).first()
    assert (qb.status, qb.source_system, qb.po_number) == ("PARTIAL", "quickbooks", None)
    assert (sap.status, sap.invoice_id) == ("PAID", "D-404")


def test_rejections_go_to_quarantine(spark):
    base = dict(tranid="I", entity_id="C", trandate="2026-01-10", duedate="2026-02-10", amount="10",
                currency="USD", status="Open")
    rows = [dict(base, status="VOID"), dict(base, amount="-1"), dict(base, line_count="-1"),
            dict(base, duedate="2025-04-02"), dict(base, entity_id=" "), dict(base)]
    valid, bad = split_quarantine(erp(spark, "netsuite", rows))
    errors = [r._errors for r in bad.collect()]
    assert valid.count() == 1
    assert ["invalid status"] in errors and ["negative amount_usd"] in errors
    assert ["negative line_items"] in errors and ["due_date before invoice_date"] in errors
    assert ["missing customer_id"] in errors


def test_unknown_source_raises(spark):
    import pytest

    with pytest.raises(ValueError):
        normalize_erp(spark.createDataFrame([("x",)], "a string"), "oracle")


def test_stripe_flattening(spark):
    payload = {"id": "hook_7", "data": {"object": {
        "id": "intent_7", "amount_received": 9930, "created": 1740830400, "currency": "usd",
        "payment_method_type": "card", "balance_transaction": "bt_7",
        "metadata": {"invoice_id": "B-1", "customer_id": "K7", "is_partial": "true"}}}}
    df = parse_json_payloads(spark.createDataFrame([(json.dumps(payload),)], "value string"), STRIPE_PAYLOAD_SCHEMA)
    r = normalize_payments(df, "stripe").first()
    assert r.payment_id == "intent_7" and r.invoice_id == "B-1" and r.amount_usd == Decimal("99.30")
    assert r.payment_method == "credit_card" and r.processor == "stripe" and r.is_partial is True
    assert r._source_event == "hook_7" and r.payment_date == dt.date(2025, 3, 1) and r._errors == []


def test_manual_payment_and_first_wins(spark):
    payload = {"event_id": "hook-3", "payment_id": "P-3", "invoice_id": "B-1", "customer_id": "K7",
               "payment_date": "2025-04-12", "amount_usd": "50", "payment_method": "wire",
               "reference_number": "W-3"}
    raw = spark.createDataFrame([(json.dumps(payload), 1), (json.dumps(payload), 2)], "value string, seq long")
    norm = normalize_payments(parse_json_payloads(raw, FLAT_PAYMENT_PAYLOAD_SCHEMA), "manual", keep=["seq"])
    r = norm.first()
    assert r.payment_method == "wire" and r.reference_number == "W-3" and r.is_partial is False
    assert dedupe_payments(norm, sequence=["seq"]).count() == 1


def test_payment_rejections(spark):
    base = {"payment_id": "P", "invoice_id": "I", "customer_id": "C", "payment_date": "2025-04-12"}
    rows = [json.dumps(dict(base, amount_usd="0")), json.dumps(dict(base, amount_usd="5", payment_method="cash")),
            json.dumps(dict(base, amount_usd="5", invoice_id=""))]
    df = parse_json_payloads(spark.createDataFrame([(r,) for r in rows], "value string"), FLAT_PAYMENT_PAYLOAD_SCHEMA)
    got = [r._errors for r in normalize_payments(df, "manual").collect()]
    # an unknown method maps to "unknown" (accepted); zero amounts and missing invoices are rejected
    assert got == [["non-positive amount"], [], ["missing invoice_id"]]


def test_event_fallbacks(spark):
    rows = [
        {"event_id": "E1", "type": "Email_Sent", "timestamp": "2025-04-15T11:45:00",
         "properties": {"invoice_id": "B-1", "customer_id": "C-1", "outcome": "Delivered"}},
        {"event_id": "E2", "invoice_id": "B-2", "customer_id": "C-2", "event_type": "sms_sent",
         "occurred_at": "2025-04-15T11:45:00", "outcome": "ignored"},
    ]
    df = parse_json_payloads(spark.createDataFrame([(json.dumps(r),) for r in rows], "value string"),
                             EVENT_PAYLOAD_SCHEMA)
    a, b = normalize_product_events(df).orderBy("event_id").collect()
    assert (a.invoice_id, a.event_type, a.actor, a.outcome) == ("B-1", "email_sent", "system", "delivered")
    assert a.occurred_at == dt.datetime(2025, 4, 15, 11, 45) and a._errors == []
    assert b._errors == ["invalid event_type", "invalid outcome"]


def test_invoice_first_wins_equal_keys(spark):
    row = dict(tranid="B-31", entity_id="K7", trandate="2025-04-02", duedate="2025-05-02", amount="77",
               currency="USD", status="Open")
    df = erp(spark, "netsuite", [row, row]).withColumn("seq", F.monotonically_increasing_id())
    valid, _ = split_quarantine(df)
    assert dedupe_invoices(valid, sequence=["seq"]).count() == 1
