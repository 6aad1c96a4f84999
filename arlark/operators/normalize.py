"""Source normalizers with set-based validation.

Each normalizer maps a source-shaped DataFrame onto the canonical schema and
adds ``_errors: array<string>`` listing every rule the row breaks and, for
such rows, ``_raw``: the text of the source record (a message's value, or the
source columns as JSON).  Instead of aborting a batch on the first bad record,
``split_quarantine`` separates valid rows from the quarantine, whose records
can be repaired and replayed from their text (``arlark.plans.replay``);
``strict=True`` fails the job when the quarantine is not empty.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arlark.functions.cleaning import (
    blank_to_null,
    clean_text,
    first_present,
    normalize_payment_method,
    normalize_status,
    parse_bool,
    parse_date,
    parse_decimal,
    parse_int,
    parse_timestamp,
    upper_or_default,
)
from arlark.schemas import (
    EVENT_SCHEMA,
    INVOICE_SCHEMA,
    MONEY,
    PAYMENT_SCHEMA,
    SOURCE_COLUMN_MAPS,
    TS,
    VALID_PAYMENT_METHODS,
    VALID_PAYMENT_PROCESSORS,
    VALID_PRODUCT_EVENT_TYPES,
    VALID_PRODUCT_OUTCOMES,
    VALID_SOURCES,
    VALID_STATUSES,
)

ERRORS = "_errors"
#: Text of a rejected record.
RAW = "_raw"
#: Field of a parsed payload that holds the text of a record that is no JSON object of the schema.
CORRUPT = "_corrupt_record"
INVALID_JSON = "invalid json"
CANONICAL_INVOICE_MAP = {c: c for c in SOURCE_COLUMN_MAPS["netsuite"]}


def utc_now() -> Column:
    """Load time as a zone-less UTC timestamp."""
    return F.convert_timezone(None, F.lit("UTC"), F.current_timestamp()).cast(TS)


def _errors(*checks: tuple[Column, str]) -> Column:
    """``array<string>`` of the messages whose condition is true (NULL counts as false)."""
    # no lambda: array_compact would be interpreted row by row
    return F.array_remove(F.array(*[F.when(cond, F.lit(msg)).otherwise(F.lit("")) for cond, msg in checks]), "")


def _json_errors(broken: Column, *checks: tuple[Column, str]) -> Column:
    """The errors of a parsed record; one that could not be parsed has that error alone."""
    return F.when(broken, F.array(F.lit(INVALID_JSON))).otherwise(_errors(*checks))


def _record(df: DataFrame, payload: str) -> tuple[Column, Column]:
    """(text of the source record, whether it could not be parsed) of a frame with a payload struct."""
    p = F.col(payload)
    text = F.col(RAW) if RAW in df.columns else F.to_json(p)
    broken = p.isNull()
    if CORRUPT in df.schema[payload].dataType.fieldNames():
        broken |= p[CORRUPT].isNotNull()
        text = F.coalesce(p[CORRUPT], text)
    if RAW in df.columns:
        broken |= ~F.coalesce(F.ltrim(F.col(RAW)), F.lit("")).startswith("{")
    return text, broken


def _rejected_text(text: Column) -> Column:
    return F.when(F.size(F.col(ERRORS)) > 0, text).alias(RAW)


def _missing(c: Column) -> Column:
    return c.isNull()


def _bad_parse(text: Column, parsed: Column) -> Column:
    return text.isNotNull() & parsed.isNull()


#: Columns that normalizers take over unchanged and that runs are cut by.
LOAD_COLUMNS = ("_loaded_at", "_source_file")


def evaluate_once(df: DataFrame) -> DataFrame:
    """Pass rows through a one-element ``inline`` (a Generate node).

    Predicate pushdown does not cross a generator, so a filter placed on top
    (such as the valid / quarantine split on ``_errors``) reads the computed
    columns instead of having every cleaning and parsing expression inlined
    into it -- and evaluated a second time -- below the projection.  Load columns
    stay outside the generator, so a filter on them does reach the scan.
    """
    outside = [c for c in LOAD_COLUMNS if c in df.columns]
    inside = F.inline(F.array(F.struct(*[F.col(c) for c in df.columns if c not in outside])))
    return df.select(*outside, inside).select(*df.columns)


def split_quarantine(df: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(valid rows without ``_errors`` and ``_raw``, quarantined rows with them)."""
    df = evaluate_once(df)
    bad = F.size(F.col(ERRORS)) > 0
    valid = df.where(~bad).drop(ERRORS, RAW)
    quarantine = df.where(bad)
    if strict:
        n = quarantine.limit(1).count()
        if n:
            sample = quarantine.select(ERRORS).first()[0]
            raise ValueError(f"quarantine is not empty, e.g. {sample}")
    return valid, quarantine


# --------------------------------------------------------------------------- ERP invoices

def normalize_erp(df: DataFrame, source_system: str | None, source_file: str | Column | None = None,
                  column_map: dict | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """ERP export (all text) -> canonical invoices plus ``_errors``.

    ``source_system`` selects the rename map (case-insensitive; an unknown
    name is a programming error and raises).  ``None`` means the frame already
    uses canonical names and carries a per-row ``source_system`` column.
    Absent source columns become NULL.  ``keep`` columns are carried through
    unchanged (e.g. an input-order column for first-wins dedupe).
    """
    if source_system is not None:
        source = source_system.lower()
        if source not in SOURCE_COLUMN_MAPS:
            raise ValueError(f"Unsupported source_system '{source_system}'")
        cmap = column_map or SOURCE_COLUMN_MAPS[source]
        source_col = F.lit(source)
    else:
        cmap = column_map or CANONICAL_INVOICE_MAP
        source_col = F.lower(clean_text("source_system"))

    def text(canonical: str) -> Column:
        src = cmap.get(canonical)
        if src is None or src not in df.columns:
            return F.lit(None).cast("string")
        return clean_text(F.col(src).cast("string"))

    if source_file is None:
        file_col = F.col("_source_file") if "_source_file" in df.columns else F.lit("")
    elif isinstance(source_file, Column):
        file_col = source_file
    else:
        file_col = F.lit(source_file)
    loaded = F.col("_loaded_at").cast(TS) if "_loaded_at" in df.columns else utc_now()

    source_row = F.struct(*[F.col(f"`{c}`").alias(c) for c in df.columns if not c.startswith("_") and c not in keep])
    staged = df.select(
        source_row.alias("_t_row"),
        text("invoice_id").alias("invoice_id"),
        text("customer_id").alias("customer_id"),
        text("customer_name").alias("customer_name"),
        text("invoice_date").alias("_t_invoice_date"),
        text("due_date").alias("_t_due_date"),
        text("amount_usd").alias("_t_amount"),
        text("currency").alias("_t_currency"),
        text("status").alias("_t_status"),
        source_col.alias("source_system"),
        text("po_number").alias("po_number"),
        text("line_items").alias("_t_line_items"),
        loaded.alias("_loaded_at"),
        file_col.cast("string").alias("_source_file"),
        *keep,
    )
    typed = staged.select(
        "*",
        parse_date("_t_invoice_date").alias("invoice_date"),
        parse_date("_t_due_date").alias("due_date"),
        parse_decimal("_t_amount").alias("amount_usd"),
        upper_or_default("_t_currency", "USD").alias("currency"),
        normalize_status("_t_status").alias("status"),
        parse_int("_t_line_items").alias("line_items"),
    )
    c = F.col
    checked = typed.withColumn(ERRORS, _errors(
        (_missing(c("invoice_id")), "missing invoice_id"),
        (_missing(c("customer_id")), "missing customer_id"),
        (_missing(c("_t_invoice_date")), "missing invoice_date"),
        (_missing(c("_t_due_date")), "missing due_date"),
        (_missing(c("_t_amount")), "missing amount_usd"),
        (_missing(c("_t_status")), "missing status"),
        (_bad_parse(c("_t_invoice_date"), c("invoice_date")), "invalid invoice_date"),
        (_bad_parse(c("_t_due_date"), c("due_date")), "invalid due_date"),
        (_bad_parse(c("_t_amount"), c("amount_usd")), "invalid amount_usd"),
        (_bad_parse(c("_t_line_items"), c("line_items")), "invalid line_items"),
        (c("_t_status").isNotNull() & ~c("status").isin(VALID_STATUSES), "invalid status"),
        (~F.coalesce(c("source_system"), F.lit("")).isin(VALID_SOURCES), "invalid source_system"),
        (c("amount_usd") < 0, "negative amount_usd"),
        (c("due_date") < c("invoice_date"), "due_date before invoice_date"),
        (c("line_items") < 0, "negative line_items"),
    ))
    return checked.select(*[f.name for f in INVOICE_SCHEMA.fields], *keep, ERRORS, _rejected_text(F.to_json("_t_row")))


def canonicalize_invoices(raw: DataFrame) -> DataFrame:
    """Canonical-named raw invoices through the same cleaning and checks."""
    return normalize_erp(raw, None)


def with_invoice_derivations(invoices: DataFrame, as_of=None) -> DataFrame:
    """The raw invoice record's derived fields as of a date: days outstanding, overdue, bucket.

    Overdue here is the record rule: ``as_of > due_date`` and status is not PAID.
    """
    from arlark.functions.aging import aging_bucket, as_of_literal, days_outstanding

    days = days_outstanding("invoice_date", as_of)
    return invoices.withColumns({
        "days_outstanding": days,
        "is_overdue": (as_of_literal(as_of) > F.col("due_date")) & (F.col("status") != "PAID"),
        "aging_bucket": aging_bucket(days),
    })


# --------------------------------------------------------------------------- payments

def _payment_out(payment_id, invoice_id, customer_id, date_text, date_value, amount_text, amount_value,
                 currency, method, processor, is_partial, reference, notes, source_event) -> list[Column]:
    return [
        payment_id.alias("payment_id"),
        invoice_id.alias("invoice_id"),
        customer_id.alias("customer_id"),
        date_text.alias("_t_payment_date"),
        date_value.alias("payment_date"),
        amount_text.alias("_t_amount"),
        amount_value.alias("amount_usd"),
        currency.alias("currency"),
        method.alias("payment_method"),
        processor.alias("processor"),
        is_partial.alias("is_partial"),
        reference.alias("reference_number"),
        notes.alias("notes"),
        source_event.alias("_source_event"),
    ]


#: Days since 1970 of the first and the last date (years 1 to 9999).
FIRST_DAY, LAST_DAY = -719_162, 2_932_896


def _epoch_date(seconds: Column) -> Column:
    """UTC date of epoch seconds; NULL outside the calendar (milliseconds or nanoseconds sent as seconds)."""
    days = F.floor(seconds / 86400)
    return F.when(days.between(FIRST_DAY, LAST_DAY), F.date_from_unix_date(days.try_cast("int")))


def normalize_payments(df: DataFrame, processor: str, payload: str = "payload",
                       keep: Sequence[str] = ()) -> DataFrame:
    """Parsed webhook payloads -> canonical payments plus ``_errors``.

    ``df[payload]`` is a struct (``STRIPE_PAYLOAD_SCHEMA`` for stripe,
    ``FLAT_PAYMENT_PAYLOAD_SCHEMA`` otherwise).  Amounts and ids are read as
    text so ``0`` counts as present and ``''`` as absent.
    """
    name = processor.lower()
    if name not in VALID_PAYMENT_PROCESSORS:
        raise ValueError(f"Unsupported payment processor '{processor}'")
    p = F.col(payload)
    if name == "stripe":
        obj = p["data"]["object"]
        meta = obj["metadata"]
        cleaned = {"_c_amount": clean_text(obj["amount_received"]), "_c_date": clean_text(obj["created"])}
        cents_text, created_text = F.col("_c_amount"), F.col("_c_date")
        created = (created_text).try_cast("bigint")
        cols = _payment_out(
            blank_to_null(obj["id"]),
            blank_to_null(meta["invoice_id"]),
            blank_to_null(meta["customer_id"]),
            created_text,
            # epoch seconds -> UTC calendar date, no session-zone dependence
            _epoch_date(created),
            cents_text,
            # 18 digits before the point are all that a hundredth of them can use
            (cents_text.try_cast("decimal(20,2)") / 100).try_cast(MONEY.simpleString()),
            F.upper(F.coalesce(blank_to_null(obj["currency"]), F.lit("usd"))),
            normalize_payment_method(F.coalesce(obj["payment_method_type"], F.lit("card"))),
            F.lit("stripe"),
            F.lower(F.coalesce(meta["is_partial"], F.lit("false"))) == "true",
            blank_to_null(obj["balance_transaction"]),
            F.lit(None).cast("string"),
            F.coalesce(p["id"], F.lit("")),
        )
    else:
        amount_field = "amount" if name == "plaid" else "amount_usd"
        default_method = "ach" if name == "plaid" else "unknown"
        cleaned = {"_c_amount": clean_text(p[amount_field]), "_c_date": clean_text(p["payment_date"]),
                   "_c_partial": F.lower(clean_text(p["is_partial"]))}
        date_text, amount_text = F.col("_c_date"), F.col("_c_amount")
        cols = _payment_out(
            blank_to_null(p["payment_id"]),
            blank_to_null(p["invoice_id"]),
            blank_to_null(p["customer_id"]),
            date_text,
            parse_date(date_text),
            amount_text,
            parse_decimal(amount_text),
            F.upper(F.coalesce(blank_to_null(p["currency"]), F.lit("USD"))),
            normalize_payment_method(F.coalesce(p["payment_method"], F.lit(default_method))),
            F.lit(name),
            F.coalesce(parse_bool("_c_partial"), F.lit(False)),
            blank_to_null(p["reference_number"]),
            blank_to_null(p["notes"]) if name != "plaid" else F.lit(None).cast("string"),
            F.coalesce(p["event_id"], F.lit("")),
        )
    loaded = F.col("_loaded_at").cast(TS) if "_loaded_at" in df.columns else utc_now()
    text, broken = _record(df, payload)
    # cleaned once: inside the parses each text would be trimmed again for every use
    flat = df.withColumns(cleaned).select(*cols, loaded.alias("_loaded_at"), text.alias("_t_text"), broken.alias("_t_broken"), *keep)
    c = F.col
    checked = flat.withColumn(ERRORS, _json_errors(
        c("_t_broken"),
        (_missing(c("payment_id")), "missing payment_id"),
        (_missing(c("invoice_id")), "missing invoice_id"),
        (_missing(c("customer_id")), "missing customer_id"),
        (_missing(c("_t_payment_date")), "missing payment_date"),
        (_missing(c("_t_amount")), "missing amount"),
        (_bad_parse(c("_t_payment_date"), c("payment_date")), "invalid payment_date"),
        (_bad_parse(c("_t_amount"), c("amount_usd")), "invalid amount"),
        (~c("payment_method").isin(VALID_PAYMENT_METHODS), "invalid payment_method"),
        (c("amount_usd") <= 0, "non-positive amount"),
    ))
    return checked.select(*[f.name for f in PAYMENT_SCHEMA.fields], *keep, ERRORS, _rejected_text(F.col("_t_text")))


# --------------------------------------------------------------------------- product events

def normalize_product_events(df: DataFrame, payload: str = "payload", keep: Sequence[str] = ()) -> DataFrame:
    """Event payloads with fallback chains -> canonical events plus ``_errors``.

    Each field is read from the top level, then an alternate name
    (``type``, ``timestamp``), then ``properties``; empty text counts as
    absent.  ``actor`` defaults to ``system``.
    """
    p = F.col(payload)
    props = p["properties"]
    text, broken = _record(df, payload)
    occurred_text = first_present(p["occurred_at"], p["timestamp"], props["occurred_at"])
    loaded = F.col("_loaded_at").cast(TS) if "_loaded_at" in df.columns else utc_now()
    flat = df.select(
        first_present(p["event_id"]).alias("event_id"),
        first_present(p["invoice_id"], props["invoice_id"]).alias("invoice_id"),
        first_present(p["customer_id"], props["customer_id"]).alias("customer_id"),
        F.lower(first_present(p["event_type"], p["type"], props["event_type"])).alias("event_type"),
        occurred_text.alias("_t_occurred_at"),
        parse_timestamp(occurred_text).alias("occurred_at"),
        F.coalesce(blank_to_null(p["actor"]), props["actor"], F.lit("system")).alias("actor"),
        F.lower(first_present(p["outcome"], props["outcome"])).alias("outcome"),
        loaded.alias("_loaded_at"),
        F.coalesce(p["source_event"], F.lit("")).alias("_source_event"),
        text.alias("_t_text"),
        broken.alias("_t_broken"),
        *keep,
    )
    c = F.col
    checked = flat.withColumn(ERRORS, _json_errors(
        c("_t_broken"),
        (_missing(c("event_id")), "missing event_id"),
        (_missing(c("invoice_id")), "missing invoice_id"),
        (_missing(c("customer_id")), "missing customer_id"),
        (_missing(c("event_type")), "missing event_type"),
        (_missing(c("_t_occurred_at")), "missing occurred_at"),
        (_bad_parse(c("_t_occurred_at"), c("occurred_at")), "invalid occurred_at"),
        (c("event_type").isNotNull() & ~c("event_type").isin(VALID_PRODUCT_EVENT_TYPES), "invalid event_type"),
        (c("outcome").isNotNull() & ~c("outcome").isin(VALID_PRODUCT_OUTCOMES), "invalid outcome"),
    ))
    return checked.select(*[f.name for f in EVENT_SCHEMA.fields], *keep, ERRORS, _rejected_text(F.col("_t_text")))


def parse_json_payloads(df: DataFrame, schema, value: str = "value", payload: str = "payload") -> DataFrame:
    """JSON text records (e.g. message values) -> a ``payload`` struct column, and the text as ``_raw``.

    A record that is no JSON object, or does not fit the schema, has its text in the payload's ``_corrupt_record``.
    The parse goes through a one-element ``explode`` (a Generate node).  Filters
    on payload fields -- the quarantine split tests a dozen of them -- are not
    pushed below a generator, so each record is parsed exactly once; with a
    plain projection Catalyst would inline ``from_json`` into the pushed-down
    filter once per field referenced.
    """
    text = F.col(value).cast("string")
    parsed = F.explode(F.array(F.from_json(text, with_corrupt(schema), {"columnNameOfCorruptRecord": CORRUPT}))).alias(payload)
    return df.select(*[c for c in df.columns if c not in (payload, RAW)], text.alias(RAW), parsed)


def with_corrupt(schema: T.StructType) -> T.StructType:
    """A payload schema with the field for records that do not fit it."""
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
