"""Structured Streaming forms of the ingestion operators.

The same Column functions as the batch path run on streaming DataFrames:

* ``normalized_event_stream`` / ``normalized_payment_stream`` -- JSON message
  values (files or a message queue) parsed and normalized; ``run_split`` stores
  valid and quarantined rows, so every message ends up in one of the two.
* ``first_wins_batches`` -- the first copy of each payment to arrive is kept in a bucketed table
  (``arlark.plans.incremental``); later copies are looked up among the ids of their buckets and left out, however
  late they come.  ``dedupe_payment_stream`` thins repeated deliveries on the way, on arrival
  time, so that its bounded state never drops a first copy either.
* ``touch_count_batches`` -- each batch adds its partial counts per invoice to a bucketed table
  that is compacted as it grows.
* ``append_batches`` / ``first_payments`` and ``append_touch_counts`` / ``touch_counts`` -- the forms that keep the
  history: every arriving row (or partial count) is stored in one folder for each batch and ranked (added up) on reading.

A sink's cost follows the batch.  Batches are known by the streaming query's id and their
number, so a replayed batch changes nothing.  ``run_available_now`` processes what is there and stops, which is
how an hourly schedule drives them.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from arlark.operators.dedupe import keep_first
from arlark.operators.matching import touches_per_invoice
from arlark.operators.normalize import ERRORS, RAW, normalize_payments, normalize_product_events, parse_json_payloads
from arlark.plans import incremental
from arlark.plans.bucket_store import CODEC, Files
from arlark.plans.sinks import open_together
from arlark.schemas import COLLECTION_EVENT_TYPES, EVENT_PAYLOAD_SCHEMA, FLAT_PAYMENT_PAYLOAD_SCHEMA, STRIPE_PAYLOAD_SCHEMA


def json_message_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """JSON-lines files arriving in a folder, one ``value`` per line."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def kafka_message_stream(spark: SparkSession, bootstrap_servers: str, topic: str) -> DataFrame:
    """Message-queue source (needs the Kafka connector on the classpath); ``value`` as text."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
            .option("subscribe", topic).option("startingOffsets", "earliest").load()
            .select(F.col("value").cast("string").alias("value"), F.col("timestamp").alias("_loaded_at")))


def normalized_event_stream(messages: DataFrame) -> DataFrame:
    return normalize_product_events(parse_json_payloads(messages, EVENT_PAYLOAD_SCHEMA))


def normalized_payment_stream(messages: DataFrame, processor: str) -> DataFrame:
    schema = STRIPE_PAYLOAD_SCHEMA if processor.lower() == "stripe" else FLAT_PAYMENT_PAYLOAD_SCHEMA
    return normalize_payments(parse_json_payloads(messages, schema), processor)


def dedupe_payment_stream(payments: DataFrame, delay: str = "2 days") -> DataFrame:
    """One delivery per payment id within ``delay`` of arrival.

    The watermark runs on arrival time, which never goes back, so no row is ever behind it and
    only repeated ids are dropped.  State holds the ids of the last
    ``delay``, on disk with a bounded cache (``STATE``); a copy that arrives later passes and is left to ``first_wins_batches``.
    """
    arrived = "__arrived_at"
    return (payments.withColumn(arrived, F.current_timestamp()).withWatermark(arrived, delay)
            .dropDuplicatesWithinWatermark(["payment_id"]).drop(arrived))


def _batch_folder(spark: SparkSession, table: str, checkpoint: str, batch_id: int) -> str:
    """The folder of one batch; the query's id comes from its checkpoint, so a new checkpoint never reuses folders."""
    return os.path.join(table, f"query_id={_query_id(spark, checkpoint)}", f"batch_id={batch_id}")


def append_batches(table: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None) -> Callable:
    """``foreachBatch`` handler: store the (transformed) batch in its own folder of ``table``."""
    def handler(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch) if transform else batch
        arrived = F.current_timestamp()
        rows.withColumn("_stored_at", arrived).write.mode("overwrite").option("compression", CODEC).parquet(
            _batch_folder(batch.sparkSession, table, checkpoint, batch_id))

    return handler


def stored_batches(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """All stored rows with ``_stored_at``, ``query_id`` and ``batch_id``."""
    extra = [T.StructField("_stored_at", T.TimestampType()), T.StructField("query_id", T.StringType()),
             T.StructField("batch_id", T.LongType())]
    return spark.read.schema(T.StructType(schema.fields + extra)).parquet(table)


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The streaming query's id, from its checkpoint."""
    return json.loads(spark.read.text(os.path.join(checkpoint, "metadata")).first()[0])["id"]


def first_payments(stored: DataFrame) -> DataFrame:
    """The first copy of each payment: by arrival, then load time, source event and amount."""
    return keep_first(stored, ["payment_id"], ["_stored_at", "batch_id", "_loaded_at", "_source_event", "amount_usd"])


def append_touch_counts(table: str, checkpoint: str, event_types: Sequence[str] | None = COLLECTION_EVENT_TYPES) -> Callable:
    """``foreachBatch`` handler: append the batch's (count, last occurred_at) per invoice."""
    def partial(batch: DataFrame) -> DataFrame:
        return touches_per_invoice(batch.withColumn("event_type", F.lower("event_type")), event_types)

    return append_batches(table, checkpoint, partial)


def touch_counts(spark: SparkSession, table: str) -> DataFrame:
    """Touch count and last outreach per invoice over all stored batches."""
    return stored_batches(spark, table, incremental.TOUCH_SCHEMA).groupBy("invoice_id").agg(
        F.sum("collection_attempt_count").alias("collection_attempt_count"), F.max("last_outreach_at").alias("last_outreach_at"))


def first_wins_batches(table: str, checkpoint: str, buckets: int = 64) -> Callable:
    """``foreachBatch`` handler: payments whose id the table lacks are added; a replayed batch changes nothing."""
    def handler(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        incremental.add_firsts(incremental.payment_store(spark, table, buckets), batch, _query_id(spark, checkpoint), batch_id)

    return handler


def touch_count_batches(table: str, checkpoint: str, buckets: int = 64,
                        event_types: Sequence[str] | None = COLLECTION_EVENT_TYPES) -> Callable:
    """``foreachBatch`` handler: add the batch's (count, last occurred_at) per invoice; a replayed batch changes nothing."""
    def handler(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        incremental.add_touch_counts(incremental.touch_store(spark, table, buckets), batch, _query_id(spark, checkpoint), batch_id, event_types)

    return handler


def run_split(rows: DataFrame, valid_table: str, quarantine_table: str, checkpoint: str) -> tuple[DataFrame, DataFrame]:
    """Store valid rows and quarantined ones (with ``_errors`` and ``_raw``) of a normalized stream; returns both as stored so far.

    A batch is parsed and checked once: both kinds are written by one pass, then each part takes its place in its table.
    """
    tables = {"valid": valid_table, "quarantine": quarantine_table}

    def handler(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        files = Files(spark, valid_table)
        written = os.path.join(valid_table, "_written", f"{_query_id(spark, checkpoint)}-{batch_id}")
        split = batch.withColumn("_stored_at", F.current_timestamp()).withColumn(
            "_sink", F.when(F.size(ERRORS) == 0, "valid").otherwise("quarantine"))
        with open_together(spark, len(tables)):
            split.write.mode("overwrite").partitionBy("_sink").option("compression", CODEC).parquet(written)
        for sink, table in tables.items():
            files.move(os.path.join(written, f"_sink={sink}"), _batch_folder(spark, table, checkpoint, batch_id))
        files.remove(written)

    run_available_now(rows, checkpoint, foreach_batch=handler)
    good = T.StructType([f for f in rows.schema.fields if f.name not in (ERRORS, RAW)])
    spark = rows.sparkSession
    return stored_batches(spark, valid_table, good), stored_batches(spark, quarantine_table, rows.schema)


#: Keys of a stream's state lie in files, not in the executors' heap; all stores of an executor share one cache of so many MB.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def state_on_disk(spark: SparkSession) -> None:
    """Streams of the session start with ``STATE``; a provider that the session names itself stays, with its settings.

    A checkpoint that was begun with another provider goes on with that one.
    """
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) is None:
        for key, value in STATE.items():
            spark.conf.set(key, spark.conf.get(key, None) or value)


def run_available_now(df: DataFrame, checkpoint: str, *, path: str | None = None, fmt: str = "parquet",
                      output_mode: str = "append", foreach_batch=None, query_name: str | None = None) -> StreamingQuery:
    """Process everything available, then stop (an hourly job's trigger)."""
    state_on_disk(df.sparkSession)
    writer = df.writeStream.option("checkpointLocation", checkpoint).outputMode(output_mode).trigger(availableNow=True)
    if query_name:
        writer = writer.queryName(query_name)
    if foreach_batch is not None:
        q = writer.foreachBatch(foreach_batch).start()
    else:
        q = writer.format(fmt).option("path", path).start()
    q.awaitTermination()
    return q
