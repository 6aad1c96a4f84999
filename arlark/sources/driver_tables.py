"""AR raw tables derived from the TPC-H-style driver tables.

Orders become invoices, line items become payments and the click stream
becomes collection events.  The mapping is fixed so that the DuckDB oracle
text in ``arlark.plans.oracle`` computes the same rows; it reads whole
tables, so the work grows with the scale factor.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arlark.schemas import EVENT_SCHEMA, INVOICE_SCHEMA, MONEY, PAYMENT_SCHEMA, TS

# Fixed parameters of the mapping.
AS_OF = "1998-06-30"
EVENT_SHIFT_DAYS = 9346           # moves the 2024 click stream back to mid-1998
FIRST_LOAD_AT = "1998-07-01 00:00:00"
SECOND_LOAD_AT = "1998-07-01 06:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def spread(rows: DataFrame) -> DataFrame:
    """Deals rows over the cores where the scan has fewer splits: a row group cannot be split, so a table of one
    row group would have all work before its first shuffle done by one task, and compressed files that are written from it
    would be one.  A table with enough splits (some MB for each core) stays as it is."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def invoice_date(order_key: str = "o_orderkey", customer_key: str = "o_custkey") -> Column:
    """The invoice date of an order: each customer's invoices lie in one 40-day span.

    Spans run from 40 days after AS_OF to 280 days before it, so all aging
    buckets, risk bands and not-yet-issued invoices occur without leaving out any order.
    """
    age = (F.pmod(F.col(customer_key), F.lit(8)) - 1) * 40 + F.pmod(F.col(order_key), F.lit(40))
    return F.date_sub(F.lit(AS_OF).cast("date"), age.cast("int"))


def _conform(df: DataFrame, schema) -> DataFrame:
    """Select the canonical columns in order; absent ones become typed NULLs."""
    present = set(df.columns)
    return df.select([
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def _str(c) -> F.Column:
    return F.col(c).cast("string")


def raw_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One invoice per order; every tenth order is loaded a second time, later, as disputed."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    base = orders.join(customer, orders.o_custkey == customer.c_custkey, "inner")
    k = F.col("o_orderkey")
    # one scan: each order yields load 1, and every tenth also load 2
    loads = base.withColumn(
        "load_no", F.explode(F.when(k % 10 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    out = loads.select(
        F.concat(F.lit("INV-"), _str("o_orderkey")).alias("invoice_id"),
        F.concat(F.lit("CUST-"), _str("o_custkey")).alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        invoice_date().alias("invoice_date"),
        F.date_add(invoice_date(), 30).alias("due_date"),
        F.col("o_totalprice").cast(MONEY).alias("amount_usd"),
        F.lit("usd").alias("currency"),
        F.when(F.col("load_no") == 2, "Disputed")
        .when(F.col("o_orderstatus") == "O", "Open")
        .when(F.col("o_orderstatus") == "P", "Partially Paid")
        .otherwise("Past Due").alias("status"),
        F.when(k % 3 == 0, "NetSuite").when(k % 3 == 1, "QuickBooks").otherwise("SAP")
        .alias("source_system"),
        F.when(k % 4 == 0, "").otherwise(F.concat(F.lit("PO-"), _str("o_orderkey"))).alias("po_number"),
        (k % 9).cast("int").alias("line_items"),
        F.when(F.col("load_no") == 1, F.lit(FIRST_LOAD_AT).cast(TS))
        .otherwise(F.lit(SECOND_LOAD_AT).cast(TS)).alias("_loaded_at"),
        F.lit("orders.parquet").alias("_source_file"),
    )
    return _conform(out, INVOICE_SCHEMA)


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payment per line item; returned lines carry no invoice (unapplied cash)."""
    return payments_from(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"))


def payments_from(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """The payment mapping over given frames (batch or a streaming ``lineitem``)."""
    lineitem = lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        "l_returnflag", "l_linestatus", "l_shipdate")
    orders = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    j = lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey, "inner")
    n = F.col("l_linenumber")
    lag = F.pmod(F.datediff("l_shipdate", "o_orderdate"), F.lit(90))
    out = j.select(
        F.concat(F.lit("PAY-"), _str("l_orderkey"), F.lit("-"), _str("l_linenumber")).alias("payment_id"),
        F.when(F.col("l_returnflag") == "R", F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("INV-"), _str("l_orderkey"))).alias("invoice_id"),
        F.concat(F.lit("CUST-"), _str("o_custkey")).alias("customer_id"),
        F.date_add(invoice_date(), lag).alias("payment_date"),
        F.col("l_extendedprice").cast(MONEY).alias("amount_usd"),
        F.lit("usd").alias("currency"),
        F.when(n == 1, "card").when(n == 2, "bank_transfer").when(n == 3, "wire")
        .when(n == 4, "check").otherwise("cash").alias("payment_method"),
        F.when(F.col("l_linestatus") == "F", "plaid").otherwise("manual").alias("processor"),
        F.col("l_shipdate").cast(TS).alias("_loaded_at"),
        F.concat(_str("l_partkey"), F.lit("/"), _str("l_suppkey")).alias("_source_event"),
    )
    return _conform(out, PAYMENT_SCHEMA)


def raw_product_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Click stream as collection touches; ``page_viewed`` is noise outside the accepted set.

    Every fiftieth event names an invoice that does not exist.
    """
    return product_events_from(table(spark, sf_dir, "events"))


def product_events_from(events: DataFrame) -> DataFrame:
    """The event mapping over a given frame (batch or streaming)."""
    ev = events.select("event_id", "ts", "user_id", "event_type", "props")
    k = F.regexp_extract("props", "[0-9]+", 0).cast("bigint")
    et = F.col("event_type")
    out = ev.select(
        F.concat(F.lit("EVT-"), _str("event_id")).alias("event_id"),
        F.when(F.col("event_id") % 50 == 0, F.concat(F.lit("INV-GONE-"), _str("event_id")))
        .otherwise(F.concat(F.lit("INV-"), (F.col("user_id") * 10 + k % 10).cast("string"))).alias("invoice_id"),
        F.concat(F.lit("CUST-"), _str("user_id")).alias("customer_id"),
        F.when(et == "click", "Email_Sent").when(et == "view", "reminder_triggered")
        .when(et == "signup", "call_logged").when(et == "purchase", "dispute_opened")
        .otherwise("page_viewed").alias("event_type"),
        (F.col("ts").cast(TS) - F.expr(f"INTERVAL {EVENT_SHIFT_DAYS} DAYS")).alias("occurred_at"),
        F.lit("system").alias("actor"),
        F.col("ts").cast(TS).alias("_loaded_at"),
    )
    return _conform(out, EVENT_SCHEMA)


def raw_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return raw_invoices(spark, sf_dir), raw_payments(spark, sf_dir), raw_product_events(spark, sf_dir)


# --------------------------------------------------------------------------- source-shaped renderings
#
# The normalizers take source-shaped input: ERP exports as all-text rows with
# each ERP's column names, and processor webhooks / product events as JSON
# text.  These renderings produce such input from the whole driver tables,
# with deterministic messiness (padding, synonyms, alternate date forms,
# missing and invalid values) so that cleaning and quarantine are exercised.

ERP_PREFIX = {"netsuite": "NS-", "quickbooks": "QB-", "sap": "SAP-"}


def erp_export(spark: SparkSession, sf_dir: str, source_system: str) -> DataFrame:
    """Every order as a text row of one ERP's export."""
    from arlark.schemas import SOURCE_COLUMN_MAPS

    cmap = SOURCE_COLUMN_MAPS[source_system]
    orders = spread(table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    j = orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
    k, st, pr = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderpriority")
    inv_date = F.to_date("o_orderdate")
    date_fmt = "yyyyMMdd" if source_system == "quickbooks" else "yyyy-MM-dd"
    due = F.when(pr == "5-LOW", F.date_sub(inv_date, 1)).otherwise(F.date_add(inv_date, 30))
    text = {
        "invoice_id": F.concat(F.lit(ERP_PREFIX[source_system]), _str("o_orderkey")),
        "customer_id": F.when(k % 5 == 0, F.concat(F.lit("  CUST-"), _str("o_custkey"), F.lit("\t")))
        .otherwise(F.concat(F.lit("CUST-"), _str("o_custkey"))),
        "customer_name": F.when(k % 7 == 0, F.lit("")).otherwise(F.col("c_name")),
        "invoice_date": F.date_format(inv_date, date_fmt),
        "due_date": F.date_format(due, date_fmt),
        "amount_usd": F.when((pr == "1-URGENT") & (st == "F"), F.lit("n/a"))
        .otherwise(F.col("o_totalprice").cast(MONEY).cast("string")),
        "currency": F.when(k % 3 == 0, F.lit("usd")).when(k % 3 == 1, F.lit(" USD ")).otherwise(F.lit("")),
        "status": F.when((pr == "2-HIGH") & (st == "F"), F.lit("void"))
        .when(st == "O", F.lit(" Open ")).when(st == "P", F.lit("Partially Paid")).otherwise(F.lit("closed")),
        "po_number": F.when(k % 4 == 0, F.lit("")).otherwise(F.concat(F.lit("PO-"), _str("o_orderkey"))),
        "line_items": F.when(k % 11 == 0, F.lit(""))
        .when((pr == "3-MEDIUM") & (st == "P"), F.lit("-1")).otherwise((k % 9).cast("string")),
    }
    return j.select([text[canonical].alias(src) for canonical, src in cmap.items()])


def _epoch_noon(date_col) -> F.Column:
    """Epoch seconds at 12:00 UTC of a date (so the UTC calendar date is exact)."""
    return F.unix_date(date_col).cast("bigint") * 86400 + 43200


def payment_payloads(spark: SparkSession, sf_dir: str, processor: str) -> DataFrame:
    """Every line item as one JSON webhook payload of ``processor`` in column ``value``."""
    lineitem = spread(table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_shipdate"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey, "inner")
    n = F.col("l_linenumber")
    suffix = F.concat(_str("l_orderkey"), F.lit("_"), _str("l_linenumber"))
    invoice = F.when(F.col("l_returnflag") == "R", F.lit(None).cast("string")) \
        .otherwise(F.concat(F.lit("INV-"), _str("l_orderkey")))
    customer = F.concat(F.lit("CUST-"), _str("o_custkey"))
    method = F.when(n == 1, "card").when(n == 2, "bank_transfer").when(n == 3, "wire") \
        .when(n == 4, "check").otherwise("cash")
    ship = F.to_date("l_shipdate")
    if processor == "stripe":
        payload = F.struct(
            F.concat(F.lit("evt_"), suffix).alias("id"),
            F.struct(F.struct(
                F.concat(F.lit("pi_"), suffix).alias("id"),
                F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("amount_received"),
                _epoch_noon(ship).alias("created"),
                F.lit("usd").alias("currency"),
                method.alias("payment_method_type"),
                F.concat(F.lit("txn_"), suffix).alias("balance_transaction"),
                F.create_map(F.lit("invoice_id"), invoice, F.lit("customer_id"), customer,
                             F.lit("is_partial"), F.when(n > 1, "true").otherwise("false")).alias("metadata"),
            ).alias("object")).alias("data"),
        )
    else:
        amount = F.col("l_extendedprice").cast(MONEY)
        fields = [
            F.concat(F.lit(f"{processor}-"), suffix).alias("event_id"),
            F.concat(F.lit("PAY-"), suffix).alias("payment_id"),
            invoice.alias("invoice_id"),
            customer.alias("customer_id"),
            F.date_format(ship, "yyyy-MM-dd").alias("payment_date"),
            (amount.alias("amount") if processor == "plaid" else amount.cast("string").alias("amount_usd")),
            F.lit("USD").alias("currency"),
            method.alias("payment_method"),
            F.concat(F.lit("REF-"), suffix).alias("reference_number"),
            (n > 1).alias("is_partial"),
        ]
        if processor != "plaid":
            fields.append(F.when(n == 7, F.lit("")).otherwise(F.concat(F.lit("line "), _str("l_linenumber")))
                          .alias("notes"))
        payload = F.struct(*fields)
    return j.select(F.to_json(payload).alias("value"))


def event_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every click-stream row as a product-event JSON payload, in four field layouts."""
    ev = spread(table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props"))
    k = F.regexp_extract("props", "[0-9]+", 0).cast("bigint")
    et = F.col("event_type")
    etype = F.when(et == "click", "Email_Sent").when(et == "view", "reminder_triggered") \
        .when(et == "signup", "call_logged").when(et == "purchase", "dispute_opened").otherwise("sms_sent")
    occurred = F.date_format(F.col("ts").cast(TS) - F.expr(f"INTERVAL {EVENT_SHIFT_DAYS} DAYS"),
                             "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    invoice = F.concat(F.lit("INV-"), (F.col("user_id") * 10 + k % 10).cast("string"))
    customer = F.concat(F.lit("CUST-"), _str("user_id"))
    outcome = F.when(F.col("value") < 5, "Delivered").when(F.col("value") < 10, "").otherwise("opened")
    layout = F.col("event_id") % 4
    none = F.lit(None).cast("string")
    payload = F.struct(
        F.concat(F.lit("EVT-"), _str("event_id")).alias("event_id"),
        F.when(layout == 2, none).otherwise(invoice).alias("invoice_id"),
        F.when(layout == 2, none).otherwise(customer).alias("customer_id"),
        F.when(layout == 0, etype).otherwise(none).alias("event_type"),
        F.when(layout.isin(1, 2), etype).otherwise(none).alias("type"),
        F.when(layout == 0, occurred).otherwise(none).alias("occurred_at"),
        F.when(layout.isin(1, 2), occurred).otherwise(none).alias("timestamp"),
        F.when(layout == 2, none).when(layout == 1, F.lit(""))
        .otherwise(F.concat(F.lit("agent_"), (F.col("user_id") % 20).cast("string"))).alias("actor"),
        F.when(layout == 3, F.lit("")).otherwise(outcome).alias("outcome"),
        F.concat(F.lit("src-"), _str("event_id")).alias("source_event"),
        F.create_map(
            F.lit("invoice_id"), invoice, F.lit("customer_id"), customer,
            F.lit("event_type"), etype, F.lit("occurred_at"), occurred,
            F.lit("outcome"), outcome,
        ).alias("properties"),
    )
    return ev.select(F.to_json(payload, {"ignoreNullFields": "true"}).alias("value"))
