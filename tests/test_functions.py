"""Scalar rules: aging, overdue, status and method maps, cleaning, keys."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from arlark.functions import (
    aging_bucket, clean_text, days_outstanding, idempotency_key, is_overdue_by_status, normalize_payment_method,
    normalize_status, parse_date,
)


def one(spark, col, data=None):
    df = spark.createDataFrame([data or (1,)], ["x"] if data is None else None)
    return df.select(col.alias("v")).first()["v"]


def test_days_bucket_overdue_as_of(spark):
    df = spark.createDataFrame([(dt.date(2026, 1, 1), dt.date(2026, 1, 31), "OPEN")], ["inv", "due", "status"])
    as_of = dt.date(2026, 2, 15)
    r = df.select(days_outstanding("inv", as_of).alias("d"),
                  aging_bucket(days_outstanding("inv", as_of)).alias("b"),
                  is_overdue_by_status("due", "status", as_of).alias("o")).first()
    assert (r.d, r.b, r.o) == (45, "31-60", True)


def test_bucket_edges_negative_and_null(spark):
    df = spark.createDataFrame([(-5,), (30,), (31,), (60,), (61,), (90,), (91,), (None,)], "d int")
    got = [r.b for r in df.select(aging_bucket("d").alias("b")).collect()]
    assert got == ["0-30", "0-30", "31-60", "31-60", "61-90", "61-90", "90+", "90+"]


def test_status_synonyms(spark):
    df = spark.createDataFrame([(" Partially Paid ",), ("Closed",), ("past due",), ("weird",)], "s string")
    got = [r.v for r in df.select(normalize_status(clean_text("s")).alias("v")).collect()]
    assert got == ["PARTIAL", "PAID", "OVERDUE", "WEIRD"]


def test_method_map(spark):
    df = spark.createDataFrame([("card",), ("BANK_TRANSFER",), ("cash",), ("wire",)], "m string")
    got = [r.v for r in df.select(normalize_payment_method("m").alias("v")).collect()]
    assert got == ["credit_card", "ach", "unknown", "wire"]


def test_clean_text_strips_tabs_and_blanks(spark):
    df = spark.createDataFrame([("\t x \n",), ("   ",), (None,)], "s string")
    assert [r.v for r in df.select(clean_text("s").alias("v")).collect()] == ["x", None, None]


def test_iso_dates(spark):
    df = spark.createDataFrame([("2026-01-05",), ("20260105",), ("2026-1-5",), ("05/01/2026",)], "s string")
    got = [r.v for r in df.select(parse_date("s").alias("v")).collect()]
    assert got == [dt.date(2026, 1, 5), dt.date(2026, 1, 5), None, None]


def test_idempotency_key_is_sha256_of_joined_fields(spark):
    import hashlib

    df = spark.createDataFrame([("netsuite", "INV-100", "CUST-1", dt.date(2026, 1, 1))],
                               ["source_system", "invoice_id", "customer_id", "invoice_date"])
    key = df.select(idempotency_key().alias("k")).first().k
    assert key == hashlib.sha256(b"netsuite|INV-100|CUST-1|2026-01-01").hexdigest()
