"""Canonical schemas, enumerations and literal lookup maps.

Every table in the library has an explicit ``StructType``; nothing is
inferred.  Timestamps are ``TIMESTAMP_NTZ`` holding UTC wall-clock time:
the staging layer casts load times to a zone-less timestamp, and the
driver test tables are zone-less too, so results never depend on the
session time zone.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values.  These must equal the upstream pipeline's definitions for the
# results to match; they are stated here verbatim, in their natural order.
# ---------------------------------------------------------------------------

VALID_STATUSES = ["OPEN", "PARTIAL", "PAID", "OVERDUE", "DISPUTED"]
VALID_SOURCES = ["netsuite", "quickbooks", "sap"]
VALID_PAYMENT_METHODS = ["ach", "wire", "credit_card", "check", "unknown"]
VALID_PAYMENT_PROCESSORS = ["stripe", "plaid", "manual", "bank"]
VALID_PRODUCT_EVENT_TYPES = ["email_sent", "call_logged", "reminder_triggered", "dispute_opened"]
VALID_PRODUCT_OUTCOMES = ["delivered", "bounced", "connected", "voicemail", "resolved", "opened"]

# canonical column -> source column, per ERP
SOURCE_COLUMN_MAPS = {
    "netsuite": {
        "invoice_id": "tranid",
        "customer_id": "entity_id",
        "customer_name": "entity_name",
        "invoice_date": "trandate",
        "due_date": "duedate",
        "amount_usd": "amount",
        "currency": "currency",
        "status": "status",
        "po_number": "otherrefnum",
        "line_items": "line_count",
    },
    "quickbooks": {
        "invoice_id": "doc_number",
        "customer_id": "customer_ref",
        "customer_name": "customer_name",
        "invoice_date": "txn_date",
        "due_date": "due_date",
        "amount_usd": "total_amt",
        "currency": "currency",
        "status": "status",
        "po_number": "po_number",
        "line_items": "line_count",
    },
    "sap": {
        "invoice_id": "billing_document",
        "customer_id": "sold_to_party",
        "customer_name": "customer_name",
        "invoice_date": "billing_date",
        "due_date": "net_due_date",
        "amount_usd": "net_value",
        "currency": "currency",
        "status": "status",
        "po_number": "purchase_order",
        "line_items": "item_count",
    },
}

# lower-cased, trimmed source status -> canonical status
STATUS_MAP = {
    "open": "OPEN",
    "partial": "PARTIAL",
    "partially paid": "PARTIAL",
    "paid": "PAID",
    "closed": "PAID",
    "overdue": "OVERDUE",
    "past due": "OVERDUE",
    "disputed": "DISPUTED",
}

# lower-cased processor method -> canonical payment method (anything else: unknown)
PAYMENT_METHOD_MAP = {
    "card": "credit_card",
    "credit_card": "credit_card",
    "ach": "ach",
    "bank_transfer": "ach",
    "wire": "wire",
    "check": "check",
}

AGING_BUCKETS = ["0-30", "31-60", "61-90", "90+"]

# event types that count as a collection touch in the dbt ledger
COLLECTION_EVENT_TYPES = ["email_sent", "call_logged", "reminder_triggered", "dispute_opened"]

# source freshness on max(_loaded_at): (warn after hours, error after hours)
FRESHNESS_HOURS = {
    "erp_invoices": (6, 24),
    "payment_events": (2, 12),
    "product_events": (2, 12),
}

DEFAULT_CREDIT_LIMIT_USD = 100_000.0
CUSTOMER_ID_MAX_NULL_RATE = 0.001
PAYMENT_MAX_AMOUNT_USD = 10_000_000
CURRENCY_PATTERN = r"\A[A-Z]{3}\z"

# expectation suites (declarative checks on staged tables)
EXPECTATION_SUITES = {
    "erp_invoices_suite": [
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "invoice_id"}},
        {"expectation_type": "expect_column_values_to_not_be_null",
         "kwargs": {"column": "customer_id", "mostly": 0.999}},
        {"expectation_type": "expect_column_values_to_be_between",
         "kwargs": {"column": "amount_usd", "min_value": 0}},
        {"expectation_type": "expect_column_values_to_be_in_set",
         "kwargs": {"column": "status", "value_set": ["OPEN", "PARTIAL", "PAID", "OVERDUE", "DISPUTED"]}},
        {"expectation_type": "expect_column_values_to_match_regex",
         "kwargs": {"column": "currency", "regex": "^[A-Z]{3}$"}},
    ],
    "payments_suite": [
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "payment_id"}},
        {"expectation_type": "expect_column_values_to_be_between",
         "kwargs": {"column": "amount_usd", "min_value": 0.01, "max_value": 10000000}},
        {"expectation_type": "expect_column_values_to_be_in_set",
         "kwargs": {"column": "payment_method", "value_set": ["ach", "wire", "credit_card", "check", "unknown"]}},
        {"expectation_type": "expect_column_values_to_match_regex",
         "kwargs": {"column": "currency", "regex": "^[A-Z]{3}$"}},
    ],
}

# ---------------------------------------------------------------------------
# Types
# ---------------------------------------------------------------------------

MONEY = T.DecimalType(18, 2)        # one invoice or payment
MONEY_TOTAL = T.DecimalType(38, 2)  # sums over many rows
TS = T.TimestampNTZType()

INVOICE_SCHEMA = T.StructType([
    T.StructField("invoice_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("customer_name", T.StringType()),
    T.StructField("invoice_date", T.DateType()),
    T.StructField("due_date", T.DateType()),
    T.StructField("amount_usd", MONEY),
    T.StructField("currency", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("source_system", T.StringType()),
    T.StructField("po_number", T.StringType()),
    T.StructField("line_items", T.IntegerType()),
    T.StructField("_loaded_at", TS),
    T.StructField("_source_file", T.StringType()),
])

PAYMENT_SCHEMA = T.StructType([
    T.StructField("payment_id", T.StringType()),
    T.StructField("invoice_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("payment_date", T.DateType()),
    T.StructField("amount_usd", MONEY),
    T.StructField("currency", T.StringType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("processor", T.StringType()),
    T.StructField("is_partial", T.BooleanType()),
    T.StructField("reference_number", T.StringType()),
    T.StructField("notes", T.StringType()),
    T.StructField("_loaded_at", TS),
    T.StructField("_source_event", T.StringType()),
])

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("invoice_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("occurred_at", TS),
    T.StructField("actor", T.StringType()),
    T.StructField("outcome", T.StringType()),
    T.StructField("_loaded_at", TS),
    T.StructField("_source_event", T.StringType()),
])

FEATURE_SCHEMA = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("as_of_date", T.DateType()),
    T.StructField("avg_days_to_pay_90d", T.DoubleType()),
    T.StructField("payment_velocity_delta", T.DoubleType()),
    T.StructField("dispute_rate_12m", T.DoubleType()),
    T.StructField("outstanding_pct_of_credit", T.DoubleType()),
    T.StructField("collection_attempts_30d", T.IntegerType()),
    T.StructField("days_since_last_payment", T.IntegerType()),
    T.StructField("pct_current", T.DoubleType()),
    T.StructField("pct_31_60", T.DoubleType()),
    T.StructField("pct_61_90", T.DoubleType()),
    T.StructField("pct_90_plus", T.DoubleType()),
])

LINEAGE_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("recorded_at", T.StringType()),
    T.StructField("source_name", T.StringType()),
    T.StructField("target_table", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("transformation", T.StringType()),
])

# raw payload schemas for JSON sources (read with an explicit schema, no inference)
STRIPE_PAYLOAD_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("data", T.StructType([
        T.StructField("object", T.StructType([
            T.StructField("id", T.StringType()),
            T.StructField("amount_received", T.StringType()),
            T.StructField("created", T.StringType()),
            T.StructField("currency", T.StringType()),
            T.StructField("payment_method_type", T.StringType()),
            T.StructField("balance_transaction", T.StringType()),
            T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
        ])),
    ])),
])

FLAT_PAYMENT_PAYLOAD_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("payment_id", T.StringType()),
    T.StructField("invoice_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("payment_date", T.StringType()),
    T.StructField("amount", T.StringType()),
    T.StructField("amount_usd", T.StringType()),
    T.StructField("currency", T.StringType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("reference_number", T.StringType()),
    T.StructField("is_partial", T.StringType()),
    T.StructField("notes", T.StringType()),
])

EVENT_PAYLOAD_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("invoice_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("occurred_at", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("actor", T.StringType()),
    T.StructField("outcome", T.StringType()),
    T.StructField("source_event", T.StringType()),
    T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
])


def erp_source_schema(source_system: str) -> T.StructType:
    """All-string schema of one ERP export, columns in map order."""
    columns = SOURCE_COLUMN_MAPS[source_system.lower()].values()
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])
