"""Storage, shuffles and parsing that must not grow faster than the input."""

import datetime as dt
import glob

from pyspark.sql import functions as F

from arlark.functions.cleaning import parse_date
from arlark.operators.normalize import normalize_payments, parse_json_payloads
from arlark.plans import catalog, incremental, jobs, replay, sinks
from arlark.plans.bucket_store import BucketStore
from arlark.schemas import FLAT_PAYMENT_PAYLOAD_SCHEMA, PAYMENT_SCHEMA


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def payments(spark, *rows):
    """(payment_id, amount, day of loading) as payments."""
    d = spark.createDataFrame([(k, a, n) for k, a, n in rows], "payment_id string, amount int, n int").withColumn(
        "_loaded_at", F.timestamp_seconds(F.col("n") * 86400).cast("timestamp_ntz")).withColumn("amount_usd", F.col("amount"))
    return d.select(*[(F.col(f.name) if f.name in d.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in PAYMENT_SCHEMA.fields])


def test_messages_are_stored_compressed(spark, tmp_path):
    path = str(tmp_path / "inbox")
    sinks.write_messages(spark.createDataFrame([('{"a":1}',), ("",), ("x",)], "value string"), path)
    assert glob.glob(path + "/part-*.gz") and not glob.glob(path + "/part-*.txt")
    assert sorted(r.value for r in spark.read.text(path).collect()) == ["", "x", '{"a":1}']


def test_streamed_inboxes_and_json_arrays_are_compressed(spark, tmp_path, monkeypatch):
    written = []
    monkeypatch.setattr(sinks, "write_messages", lambda lines, path: (written.append(path), lines.write.text(path)))
    catalog._as_arrays(spark.createDataFrame([('{"a":1}',)], "value string"), str(tmp_path / "arrays"))
    assert written == [str(tmp_path / "arrays")]


def test_buckets_of_the_copartitioned_ledger_grow_with_the_files(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "some rows")      # a path with a blank is a URI with escapes in inputFiles
    spark.range(10_000).write.parquet(path)
    rows = spark.read.parquet(path)
    few = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert jobs._buckets_for(rows) == few
    monkeypatch.setattr(jobs, "BUCKET_SOURCE_BYTES", 100)
    assert jobs._buckets_for(rows) > max(few, 100)


def test_a_batch_is_joined_and_written_where_its_buckets_lie(spark, tmp_path, monkeypatch):
    plans, append = [], BucketStore.append

    def seen(self, rows, *more, **named):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return append(self, rows, *more, **named)

    monkeypatch.setattr(BucketStore, "append", seen)
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    store = incremental.payment_store(spark, str(tmp_path / "t"), 4)
    incremental.add_firsts(store, payments(spark, ("a", 1, 2), ("a", 2, 1), (None, 3, 1), (None, 4, 2), ("b", 5, 1)), "s", 0)
    incremental.add_firsts(store, payments(spark, ("a", 9, 0), (None, 9, 0), ("c", 6, 1), ("c", 7, 2)), "s", 1)
    assert {(r.payment_id, int(r.amount_usd)) for r in store.read().collect()} == {("a", 2), (None, 3), ("b", 5), ("c", 6)}
    assert store.read().count() == 4
    # the second batch: its rows and the known keys are dealt by bucket, nothing moves by key
    assert plans[1].count("hashpartitioning(_bucket") == 2 and "hashpartitioning(payment_id" not in plans[1]
    files = [e for e in store.entries() if e.kind == "file"]
    for e in files:
        assert len(glob.glob(f"{store.path}/data/attempt={e.attempt}/_bucket={e.bucket}/part-*")) == 1


def test_latest_rows_are_ranked_where_their_buckets_lie(spark, tmp_path, monkeypatch):
    lain, stage = [], BucketStore.stage

    def seen(self, rows, as_they_lie=False):
        lain.append((as_they_lie, rows._jdf.queryExecution().executedPlan().toString()))
        return stage(self, rows, as_they_lie)

    monkeypatch.setattr(BucketStore, "stage", seen)
    store = incremental.payment_store(spark, str(tmp_path / "t"), 4)
    for batch in ([("a", 1, 1), ("a", 2, 3), (None, 3, 1)], [("a", 4, 2), (None, 5, 2), ("b", 6, 1)]):
        incremental.merge_latest(store, payments(spark, *batch), tiebreak=["amount_usd"])
    assert {(r.payment_id, int(r.amount_usd)) for r in store.read().collect()} == {("a", 2), (None, 5), ("b", 6)}
    assert lain[3][0] and lain[3][1].count("Exchange") == 1 and "hashpartitioning(_bucket" in lain[3][1]


def test_a_message_is_cleaned_once_and_checked_without_a_lambda(spark):
    rows = spark.createDataFrame([('{"payment_id":"p","payment_date":" 1996-02-30 ","amount_usd":" 1.5"}',), ("x",)], "value string")
    out = normalize_payments(parse_json_payloads(rows, FLAT_PAYMENT_PAYLOAD_SCHEMA), "manual")
    text = plan(out)
    assert "lambda" not in text and text.count("trim(payload") == 3
    first, second = sorted(out.collect(), key=lambda r: len(r["_errors"]), reverse=True)
    assert first["_errors"] == ["missing invoice_id", "missing customer_id", "invalid payment_date"] and second["_errors"] == ["invalid json"]


def test_dates_that_no_calendar_has(spark):
    texts = {"1996-02-29": dt.date(1996, 2, 29), "19960229": dt.date(1996, 2, 29), "1996-02-30": None, "19961345": None, "1996-1-1": None,
             "1996-01-01\n": None, "00000000": None, "9999-12-31": dt.date(9999, 12, 31)}
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", parse_date("t").alias("d"))
    assert {r.t: r.d for r in rows.collect()} == texts
    assert "gettimestamp" not in plan(rows).lower()


def test_replayed_records_are_derived_once(spark, tmp_path, monkeypatch):
    plans, old = [], replay.ReplayLog.replay

    def seen(self, records, repairs):
        plans.append(plan(records))
        return old(self, records, repairs)

    monkeypatch.setattr(replay.ReplayLog, "replay", seen)
    assert catalog.registered()["quarantine_replay"](spark, "/root/testdata/sf0.001").count() > 0
    assert len(plans) == 2 and not any("Aggregate" in p for p in plans)
