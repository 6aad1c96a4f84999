"""Source records with faults, from whole driver tables: every validation rule is broken by some of them.

Unlike the renderings of ``driver_tables``, these are built as text, so that the quarantine's source texts can be
compared.  A fixed share of the rows (by key) carries one fault each, or several; the rest is valid.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arlark.schemas import TS
from arlark.sources.driver_tables import EVENT_SHIFT_DAYS, invoice_date, spread, table

#: One of so many keys has each fault.
FAULTS = 40


def _text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _either(fault: Column, cases: dict, usual: Column) -> Column:
    """``usual``, or for some fault numbers another text."""
    out = usual.cast("string")
    for number, value in cases.items():
        out = F.when(fault == number, F.lit(value) if isinstance(value, str) else value.cast("string")).otherwise(out)
    return out


def webhook_messages(spark: SparkSession, sf_dir: str, processor: str) -> DataFrame:
    """(value): every line item as a webhook of ``processor``; faults 1-13 of ``FAULTS``."""
    lines = spread(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    fault = F.pmod(k * 7 + n, F.lit(FAULTS))
    key = F.concat_ws("_", k.cast("string"), n.cast("string"))
    money = F.col("l_extendedprice").cast("decimal(18,2)")
    invoice = _either(fault, {2: ""}, _text("INV-", k))
    customer = _either(fault, {3: "null"}, _text('"CUST-', F.col("o_custkey"), '"'))
    method = F.element_at(F.array(*[F.lit(m) for m in ("card", "bank_transfer", "wire", "check", "cash")]), F.least(n, F.lit(5)).cast("int"))
    partial = F.when(n > 1, F.lit("true")).otherwise(F.lit("false"))
    day = F.to_date("l_shipdate")
    if processor == "stripe":
        seconds = F.unix_date(day).cast("bigint") * 86400 + 43200
        cents = (money * 100).cast("bigint")
        created = _either(fault, {4: '""', 5: seconds * 1000000000, 13: '""'}, seconds)
        amount = _either(fault, {6: '""', 7: '"n/a"', 8: "0", 9: "-500", 10: "1234567890123456789012345", 13: '"n/a"'}, cents)
        value = _text('{"id":"evt_', key, '","data":{"object":{"id":"', _either(fault, {1: "", 13: ""}, _text("pi_", key)), '","amount_received":',
                      amount, ',"created":', created, ',"currency":"usd","payment_method_type":"', method, '","balance_transaction":"txn_', key,
                      '","metadata":{"invoice_id":"', invoice, '","customer_id":', customer, ',"is_partial":"', partial, '"}}}}')
    else:
        amount = _either(fault, {6: "", 7: "n/a", 8: "0", 9: "-5.00", 10: "1234567890123456789012345", 13: "n/a"}, money)
        date = _either(fault, {4: "", 5: "1996-13-45", 13: ""}, F.date_format(day, "yyyy-MM-dd"))
        value = _text(f'{{"event_id":"{processor}-', key, '","payment_id":"', _either(fault, {1: "", 13: ""}, _text("PAY-", key)),
                      '","invoice_id":"', invoice, '","customer_id":', customer, ',"payment_date":"', date,
                      f'","{"amount" if processor == "plaid" else "amount_usd"}":"', amount, '","currency":"USD","payment_method":"', method,
                      '","reference_number":"REF-', key, '","is_partial":', partial, "}")
    value = F.when(fault == 11, F.substring(value, 1, 40)).when(fault == 12, _text("webhook ", key, " failed")).otherwise(value)
    return lines.join(orders, k == F.col("o_orderkey")).select(value.alias("value"))


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value): every click-stream row as an event message; faults 1-9 of ``FAULTS``."""
    events = spread(table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type"))
    e = F.col("event_id")
    fault = F.pmod(e, F.lit(FAULTS))
    kind = F.when(F.col("event_type") == "click", "Email_Sent").when(F.col("event_type") == "view", "reminder_triggered") \
        .when(F.col("event_type") == "signup", "call_logged").otherwise("dispute_opened")
    at = F.date_format(F.col("ts").cast(TS) - F.expr(f"INTERVAL {EVENT_SHIFT_DAYS} DAYS"), "yyyy-MM-dd'T'HH:mm:ss")
    value = _text('{"event_id":"', _either(fault, {1: ""}, _text("EVT-", e)), '","invoice_id":"', _either(fault, {2: ""}, _text("INV-", F.col("user_id"))),
                  '","customer_id":"', _either(fault, {3: ""}, _text("CUST-", F.col("user_id"))), '","event_type":"',
                  _either(fault, {4: "", 5: "sms_sent"}, kind), '","occurred_at":"', _either(fault, {6: "", 7: "1998-02-30T99:00:00"}, at),
                  '","outcome":"', _either(fault, {8: "ignored"}, F.lit("opened")), '","source_event":"src-', e, '"}')
    return events.select(F.when(fault == 9, F.concat(F.substring(value, 1, 30), F.lit("..."))).otherwise(value).alias("value"))


def erp_text_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a text row with canonical names and a source each; faults 1-16 of ``FAULTS``."""
    orders = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"))
    k = F.col("o_orderkey")
    fault = F.pmod(k, F.lit(FAULTS))
    day = invoice_date()
    source = F.element_at(F.array(*[F.lit(s) for s in ("NetSuite", "QuickBooks", "SAP")]), (F.pmod(k, F.lit(3)) + 1).cast("int"))
    fields = {
        "invoice_id": _either(fault, {1: "", 16: " "}, _text("INV-", k)),
        "customer_id": _either(fault, {2: "", 16: ""}, _text("CUST-", F.col("o_custkey"))),
        "customer_name": _text("Customer ", F.col("o_custkey")),
        "invoice_date": _either(fault, {3: "", 7: "1998-02-30"}, F.date_format(day, "yyyy-MM-dd")),
        "due_date": _either(fault, {4: "", 8: "soon", 13: F.date_format(F.date_sub(day, 1), "yyyy-MM-dd")}, F.date_format(F.date_add(day, 30), "yyyy-MM-dd")),
        "amount_usd": _either(fault, {5: "", 9: "n/a", 14: "-12.50", 16: "1e400"}, F.col("o_totalprice").cast("decimal(18,2)")),
        "currency": F.lit("usd"),
        "status": _either(fault, {6: "", 11: "void"}, F.lit("Open")),
        "source_system": _either(fault, {12: "oracle"}, source),
        "po_number": _text("PO-", k),
        "line_items": _either(fault, {10: "many", 15: "-1"}, F.pmod(k, F.lit(9))),
    }
    return orders.select(*[c.alias(name) for name, c in fields.items()])
