"""Replay of quarantined records: repaired texts are parsed again and admitted exactly once.

A rejected record is known by the hash of its kind and text; the same text delivered again is
the same record.  A replay takes repairs (record_id, text), leaves out those of unknown or
already admitted records, runs the kind's own parser and checks, and writes
everything, admitted or not, in one folder of its own; one appended row then makes the folder
count.  What was admitted is read from the same folders, so a replay that dies before
its row leaves nothing behind, and one that is run again admits nothing twice.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arlark.operators.normalize import (
    ERRORS, RAW, normalize_erp, normalize_payments, normalize_product_events, parse_json_payloads,
)
from arlark.plans.bucket_store import CODEC, Files
from arlark.schemas import (
    EVENT_PAYLOAD_SCHEMA, EVENT_SCHEMA, FLAT_PAYMENT_PAYLOAD_SCHEMA, INVOICE_SCHEMA, PAYMENT_SCHEMA, STRIPE_PAYLOAD_SCHEMA,
    erp_source_schema,
)

RECORD = "_record_id"
RECORDS = T.StructType([T.StructField(n, t) for n, t in (
    ("record_id", T.StringType()), ("kind", T.StringType()), ("raw", T.StringType()), ("errors", T.ArrayType(T.StringType())))])

Parser = Callable[[DataFrame], DataFrame]


def payment_parser(processor: str) -> Parser:
    schema = STRIPE_PAYLOAD_SCHEMA if processor.lower() == "stripe" else FLAT_PAYMENT_PAYLOAD_SCHEMA
    return lambda rows: normalize_payments(parse_json_payloads(rows, schema), processor, keep=[RECORD])


def event_parser() -> Parser:
    return lambda rows: normalize_product_events(parse_json_payloads(rows, EVENT_PAYLOAD_SCHEMA), keep=[RECORD])


def erp_parser(source_system: str | None) -> Parser:
    """The text of an ERP row is a JSON object of its source columns (``None``: canonical names with a source each)."""
    schema = erp_source_schema(source_system) if source_system else T.StructType(
        [T.StructField(f.name, T.StringType()) for f in INVOICE_SCHEMA.fields if not f.name.startswith("_")])

    def parse(rows: DataFrame) -> DataFrame:
        columns = [F.col("payload")[f.name].alias(f.name) for f in schema.fields]
        return normalize_erp(parse_json_payloads(rows, schema).select(*columns, RECORD), source_system, source_file="replay", keep=[RECORD])

    return parse


#: Kinds of records: their parser and the schema of what they become.
KINDS: dict[str, tuple[Parser, T.StructType]] = {
    **{f"payments/{p}": (payment_parser(p), PAYMENT_SCHEMA) for p in ("stripe", "plaid", "manual", "bank")},
    "events": (event_parser(), EVENT_SCHEMA),
    **{f"erp/{s}": (erp_parser(s), INVOICE_SCHEMA) for s in ("netsuite", "quickbooks", "sap")},
    "erp": (erp_parser(None), INVOICE_SCHEMA),
}


def record_id(kind: Column, raw: Column) -> Column:
    return F.sha2(F.concat_ws("|", kind, F.coalesce(raw, F.lit(""))), 256)


def quarantine_records(quarantine: DataFrame, kind: str) -> DataFrame:
    """(record_id, kind, raw, errors) of a quarantine table, one row for each distinct text."""
    if kind not in KINDS:
        raise ValueError(f"unknown kind of record '{kind}'")
    rows = quarantine.select(record_id(F.lit(kind), F.col(RAW)).alias("record_id"), F.lit(kind).alias("kind"), F.col(RAW).alias("raw"),
                             F.col(ERRORS).alias("errors"))
    return rows.groupBy("record_id", "kind").agg(F.first("raw").alias("raw"), F.first("errors").alias("errors"))


class ReplayLog:
    """The replays of one kind of records, under ``path``."""

    def __init__(self, spark: SparkSession, path: str, kind: str):
        self.spark, self.path, self.kind = spark, path, kind
        self.parse, fields = KINDS[kind]
        self.schema = T.StructType([*fields.fields, T.StructField(RECORD, T.StringType()),
                                    T.StructField(ERRORS, T.ArrayType(T.StringType())), T.StructField(RAW, T.StringType())])
        self.files = Files(spark, path)

    def _commits(self) -> list[str]:
        """Attempts that count, in order (one row each)."""
        folder = os.path.join(self.path, "commits")
        if not self.files.names(folder):
            return []
        rows = self.spark.read.schema("attempt string, committed_at timestamp").parquet(folder)
        return [r.attempt for r in rows.orderBy("committed_at", "attempt").collect()]

    def results(self) -> DataFrame:
        """Every repaired record of the replays that count, with ``_errors``."""
        paths = [os.path.join(self.path, "results", a) for a in self._commits()]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def admitted(self) -> DataFrame:
        """Canonical rows of the repaired records, with their record id."""
        return self.results().where(F.size(ERRORS) == 0).drop(ERRORS, RAW)

    def open_records(self, records: DataFrame) -> DataFrame:
        """The quarantined records that no replay has admitted."""
        return records.join(self.admitted().select(F.col(RECORD).alias("record_id")), "record_id", "left_anti")

    def replay(self, records: DataFrame, repairs: DataFrame) -> dict[str, int]:
        """Parses ``repairs`` (record_id, text) of open records; returns how many were admitted and rejected.

        A record with several different repairs is rejected as ``ambiguous repair``; repairs of
        unknown or admitted records are passed over.
        """
        todo = repairs.select("record_id", F.col("text").alias("value")).join(
            self.open_records(records).select("record_id"), "record_id", "left_semi")
        one = todo.groupBy(F.col("record_id").alias(RECORD)).agg(
            F.min("value").alias("value"), (~F.min("value").eqNullSafe(F.max("value"))).alias("_several"))
        parsed = self.parse(one.where(~F.col("_several")).drop("_several"))
        unclear = one.where("_several").select(RECORD, F.col("value").alias(RAW), F.array(F.lit("ambiguous repair")).alias(ERRORS))
        rows = parsed.unionByName(unclear, allowMissingColumns=True).select(*[f.name for f in self.schema.fields])
        attempt, seen = uuid.uuid4().hex, Observation(f"replay_{uuid.uuid4().hex[:8]}")
        good = F.size(ERRORS) == 0
        rows.observe(seen, F.count_if(good).alias("admitted"), F.count_if(~good).alias("rejected")).write.mode("errorifexists").option(
            "compression", CODEC).parquet(os.path.join(self.path, "results", attempt))
        row = self.spark.range(1).select(F.lit(attempt).alias("attempt"), F.current_timestamp().alias("committed_at"))
        row.write.mode("append").parquet(os.path.join(self.path, "commits"))
        return {"admitted": seen.get["admitted"], "rejected": seen.get["rejected"]}
