"""Point-in-time features: one ledger of two firms seen at three cutoffs."""

import datetime as dt

import pytest

from arlark.operators.features import FEATURE_COLUMNS, customer_features

LEDGER = ("customer_id string, invoice_date date, last_payment_date date, amount_outstanding_usd decimal(18,2), status string, aging_bucket string, "
          "collection_attempt_count int, last_outreach_at timestamp_ntz, credit_limit_usd double")


def day(text):
    return dt.date.fromisoformat(text)


def ledger(spark):
    rows = [
        # Bakery: paid after 12 days, paid after 40 days, open and chased, disputed
        ("bakery", "2024-09-02", "2024-09-14", "0.00", "PAID", "0-30", 0, None, 4000.0),
        ("bakery", "2024-12-01", "2025-01-10", "0.00", "PAID", "31-60", 2, "2025-01-05T09:30:00", 5000.0),
        ("bakery", "2025-01-20", None, "150.00", "OPEN", "61-90", 4, "2025-03-28T12:00:00", 5000.0),
        ("bakery", "2025-03-03", None, "350.00", "disputed", "0-30", 1, "2025-03-31T00:00:00", None),
        # Mill: everything lies late in the year
        ("mill", "2025-03-15", "2025-03-20", "80.00", "PARTIAL", "0-30", 3, "2025-04-01T00:00:01", None),
        (None, "2025-01-01", None, "9.00", "OPEN", "90+", 1, None, None),
    ]
    from decimal import Decimal

    typed = [(c, day(i), p and day(p), Decimal(a), s, b, n, o and dt.datetime.fromisoformat(o), lim) for c, i, p, a, s, b, n, o, lim in rows]
    return spark.createDataFrame(typed, LEDGER)


def at(spark, cutoff):
    return {r.customer_id: r for r in customer_features(ledger(spark), cutoff).collect()}


def test_a_late_cutoff_sees_both_firms(spark):
    got = at(spark, day("2025-03-31"))
    assert set(got) == {"bakery", "mill"}
    b = got["bakery"]
    # one payment in the last 90 days (40 days to pay), none in the 90 before: 14 September lies 198 days back
    assert (b.avg_days_to_pay_90d, b.payment_velocity_delta, b.days_since_last_payment) == (40.0, 40.0, 80)
    assert b.dispute_rate_12m == 0.25 and b.outstanding_pct_of_credit == pytest.approx(500 / 100_000)
    # touches of the last 30 days, up to the cutoff's midnight
    assert b.collection_attempts_30d == 4 + 1
    assert (b.pct_current, b.pct_31_60, b.pct_61_90, b.pct_90_plus) == (0.7, 0.0, 0.3, 0.0)
    # the mill's touch is one second into the day after
    assert got["mill"].collection_attempts_30d == 0 and got["mill"].avg_days_to_pay_90d == 5.0


def test_an_early_cutoff_leaves_out_later_rows(spark):
    got = at(spark, "2025-01-12")
    assert set(got) == {"bakery"}
    b = got["bakery"]
    # now the September payment is in the span before: 40 - 12
    assert (b.avg_days_to_pay_90d, b.payment_velocity_delta, b.days_since_last_payment) == (40.0, 28.0, 2)
    assert (b.dispute_rate_12m, b.outstanding_pct_of_credit, b.collection_attempts_30d) == (0.0, 0.0, 2)
    assert (b.pct_current, b.pct_31_60, b.pct_61_90, b.pct_90_plus) == (0.0, 0.0, 0.0, 0.0)


def test_payments_after_the_cutoff_do_not_count(spark):
    b = at(spark, day("2025-01-09"))["bakery"]
    # the invoice of December is known, its payment on the 10th is not; the September payment is 117 days old
    assert (b.avg_days_to_pay_90d, b.payment_velocity_delta, b.days_since_last_payment) == (0.0, -12.0, 117)
    assert list(b.asDict()) == FEATURE_COLUMNS


def test_text_dates_and_missing_columns(spark):
    rows = [("kiln", "2025-05-01", "2025-05-09 08:00:00", 10.0, None, None), ("kiln", "not a date", "", 99.0, "OPEN", "90+")]
    df = spark.createDataFrame(rows, "customer_id string, invoice_date string, last_payment_date string, amount_outstanding_usd double, "
                                     "status string, aging_bucket string")
    r = customer_features(df, day("2025-06-01"), default_credit_limit_usd=40.0).first()
    # a row without a date is after every cutoff; bucket and status have defaults; no touches are known
    assert (r.avg_days_to_pay_90d, r.outstanding_pct_of_credit, r.collection_attempts_30d, r.pct_current) == (8.0, 0.25, 0, 1.0)


def test_empty_ledger_keeps_schema(spark):
    out = customer_features(ledger(spark).limit(0), day("2025-06-01"))
    assert out.count() == 0 and out.columns == FEATURE_COLUMNS
