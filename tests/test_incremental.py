"""Bucketed tables: versions, replays, touched buckets, compaction; first-wins, counts, upsert and latest rows by batches."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arlark.operators.dedupe import keep_first, keep_latest
from arlark.operators.matching import touches_per_invoice
from arlark.plans import incremental
from arlark.plans.bucket_store import BucketStore
from arlark.plans.sinks import UPSERT_KEYS, upsert_invoices
from arlark.schemas import EVENT_SCHEMA, INVOICE_SCHEMA, PAYMENT_SCHEMA
from arlark.streaming import streams

T0 = dt.datetime(2026, 1, 1)
PAIR = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])


def pairs(spark, rows):
    return spark.createDataFrame(rows, PAIR)


def content(store):
    return sorted((r.k or "", r.v) for r in store.read().collect())


def pay(pid, amount, at, event="e"):
    return (pid, "I1", "C1", at.date(), Decimal(amount), "USD", "ach", "manual", False, None, None, at, event)


def inv(i, src, status, amount, loaded, po="PO"):
    return (i, "C", "Name", dt.date(2026, 1, 1), dt.date(2026, 1, 31), Decimal(amount), "USD", status, src, po, 1, loaded, "f.csv")


def test_versions_are_whole_and_batches_count_once(spark, tmp_path):
    store = BucketStore(spark, str(tmp_path / "t"), PAIR, ["k"], buckets=4)
    assert store.version() == 0 and store.read().collect() == [] and store.last_batch("s") == -1
    assert store.append(pairs(spark, [("a", 1), (None, 2)]), "s", 0) == 1
    assert store.append(pairs(spark, [("a", 1), (None, 2)]), "s", 0) == 1      # delivered again
    assert store.append(pairs(spark, [("b", 3)]), "s", 1) == 2
    assert store.append(pairs(spark, [("c", 4)]), "other", 0) == 3
    assert content(store) == [("", 2), ("a", 1), ("b", 3), ("c", 4)] and store.last_batch("s") == 1
    assert store.append(pairs(spark, []), "s", 2) == 4 and len(content(store)) == 4


def test_an_unfinished_version_is_not_read(spark, tmp_path):
    store = BucketStore(spark, str(tmp_path / "t"), PAIR, ["k"], buckets=2)
    store.append(pairs(spark, [("a", 1)]), "s", 0)
    store.stage(pairs(spark, [("lost", 9)]))                                  # a writer that died before its commit
    os.makedirs(tmp_path / "t" / "manifest" / "version=2")                    # and one that died inside it
    assert store.version() == 1 and content(store) == [("a", 1)]
    assert store.append(pairs(spark, [("b", 2)]), "s", 1) == 3 and content(store) == [("a", 1), ("b", 2)]
    store.vacuum(keep_versions=1)
    assert content(store) == [("a", 1), ("b", 2)] and "lost" not in str(spark.read.parquet(str(tmp_path / "t" / "data")).collect())


def test_a_commit_over_a_newer_version_fails(spark, tmp_path):
    store = BucketStore(spark, str(tmp_path / "t"), PAIR, ["k"], buckets=2)
    store.append(pairs(spark, [("a", 1)]))

    def merge(rows, new):
        BucketStore(spark, store.path, PAIR, ["k"], buckets=2).append(pairs(spark, [("x", 1)]))
        return rows.unionByName(new)

    with pytest.raises(RuntimeError, match="replaced"):
        store.rewrite(pairs(spark, [("a", 2)]), merge)
    assert content(store) == [("a", 1), ("x", 1)]


def test_only_touched_buckets_are_read_and_written(spark, tmp_path):
    store = BucketStore(spark, str(tmp_path / "t"), PAIR, ["k"], buckets=8)
    store.append(pairs(spark, [(f"k{i}", i) for i in range(200)]))
    before = {e.bucket: e.attempt for e in store.entries()}
    bucket = pairs(spark, [("k7", 0)]).select(store.bucket()).first()[0]
    files = []

    def merge(rows, new):
        files.extend(rows.inputFiles())
        return rows.join(new.select("k"), "k", "left_anti").unionByName(new)

    store.rewrite(pairs(spark, [("k7", 700)]), merge)
    assert files and all(f"_bucket={bucket}/" in f for f in files)
    after = {e.bucket: e.attempt for e in store.entries()}
    assert {b for b in after if after[b] != before[b]} == {bucket}
    assert dict(content(store))["k7"] == 700 and len(content(store)) == 200
    with pytest.raises(ValueError, match="left their buckets"):
        store.rewrite(pairs(spark, [("k7", 1)]), lambda rows, new: pairs(spark, [(f"z{i}", i) for i in range(50)]))


def test_compaction_keeps_the_rows(spark, tmp_path):
    store = BucketStore(spark, str(tmp_path / "t"), PAIR, ["k"], buckets=2)
    for i in range(5):
        store.append(pairs(spark, [("a", i), ("b", 10 * i)]), "s", i)
    version = store.version()
    assert store.compact(most_files=9) == version
    store.compact(lambda rows: rows.groupBy("k").agg(F.sum("v").alias("v")), most_files=2)
    assert content(store) == [("a", 10), ("b", 100)] and store.last_batch("s") == 4
    assert store.vacuum(1) > 0 and content(store) == [("a", 10), ("b", 100)]


def test_first_wins_over_batches(spark, tmp_path):
    store = incremental.payment_store(spark, str(tmp_path / "p"), buckets=4)
    batches = [[pay("P1", "5.00", T0), pay("P2", "6.00", T0), pay("P1", "4.00", T0 + dt.timedelta(1)), pay(None, "1.00", T0)],
               [pay("P1", "7.00", T0 - dt.timedelta(days=40)), pay("P3", "8.00", T0 - dt.timedelta(days=400)), pay(None, "2.00", T0)],
               [pay("P2", "9.00", T0), pay("P4", "1.00", T0), pay("P4", "1.00", T0)]]
    for k, rows in enumerate(batches):
        for _ in range(2):
            incremental.add_firsts(store, spark.createDataFrame(rows, PAYMENT_SCHEMA), "q", k)
    got = {r.payment_id: r.amount_usd for r in store.read().collect()}
    assert got == {"P1": Decimal("5.00"), "P2": Decimal("6.00"), "P3": Decimal("8.00"), "P4": Decimal("1.00"), None: Decimal("1.00")}
    assert store.read().count() == 5
    # only the key column of stored payments is read for a batch
    plan = store.read().select("payment_id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<payment_id:string>" in plan


def test_streamed_firsts_survive_a_replayed_batch(spark, tmp_path):
    inbox, table, checkpoint = (str(tmp_path / d) for d in ("inbox", "table", "ckpt"))
    stream = spark.readStream.schema(PAYMENT_SCHEMA).parquet(os.path.join(inbox, "*"))
    for k, rows in enumerate([[pay("P1", "1.00", T0)], [pay("P1", "2.00", T0), pay("P2", "3.00", T0)]]):
        spark.createDataFrame(rows, PAYMENT_SCHEMA).write.parquet(os.path.join(inbox, f"b{k}"))
        streams.run_available_now(stream, checkpoint, foreach_batch=streams.first_wins_batches(table, checkpoint, 4))
    handler = streams.first_wins_batches(table, checkpoint, 4)
    handler(spark.createDataFrame([pay("P9", "9.00", T0)], PAYMENT_SCHEMA), 1)          # batch 1 once more
    rows = incremental.payment_store(spark, table, 4).read().collect()
    assert {r.payment_id: r.amount_usd for r in rows} == {"P1": Decimal("1.00"), "P2": Decimal("3.00")}


def test_touch_counts_stay_right_through_compaction(spark, tmp_path):
    store = incremental.touch_store(spark, str(tmp_path / "t"), buckets=2)
    events = []
    for k in range(11):
        rows = [(f"E{k}-{i}", f"I{i % 3}", "C", "Email_Sent" if i % 4 else "page_viewed", T0 + dt.timedelta(hours=k * 7 - i), "s", None, T0, "") for i in range(9)]
        events += rows
        for _ in range(1 + k % 2):
            incremental.add_touch_counts(store, spark.createDataFrame(rows, EVENT_SCHEMA), "q", k)
    lowered = spark.createDataFrame(events, EVENT_SCHEMA).withColumn("event_type", F.lower("event_type"))
    expected = {r.invoice_id: (r.collection_attempt_count, r.last_outreach_at) for r in touches_per_invoice(lowered).collect()}
    assert {r.invoice_id: (r.collection_attempt_count, r.last_outreach_at) for r in incremental.touch_counts(store).collect()} == expected
    assert max(sum(e.kind == "file" and e.bucket == b for e in store.entries()) for b in range(2)) <= incremental.COMPACT_AFTER


def test_upsert_equals_the_whole_merge(spark, tmp_path):
    target = spark.createDataFrame([inv(f"I{k}", "sap" if k % 2 else "netsuite", "OPEN", str(k), T0) for k in range(60)], INVOICE_SCHEMA)
    later = T0 + dt.timedelta(hours=6)
    change = spark.createDataFrame([inv("I3", "sap", "PAID", "333", later, "PO-NEW"), inv("I4", "netsuite", "PAID", "444", later),
                                    inv("I4", "sap", "OPEN", "4", later), inv("N1", "sap", "OPEN", "5", later)], INVOICE_SCHEMA)
    store = incremental.invoice_store(spark, str(tmp_path / "i"), buckets=16)
    incremental.upsert(store, target, "s", 0)
    before = {e.bucket: e.attempt for e in store.entries()}
    for _ in range(2):
        incremental.upsert(store, change, "s", 1)
    expected = upsert_invoices(target, change)
    assert sorted(map(str, store.read().collect())) == sorted(map(str, expected.collect()))
    changed = [b for b, a in {e.bucket: e.attempt for e in store.entries()}.items() if before.get(b) != a]
    assert 1 <= len(changed) <= 4


def test_latest_rows_by_loads_in_any_order(spark, tmp_path):
    rows = [inv(f"I{k % 20}", "sap", f"S{k}", str(k), T0 + dt.timedelta(hours=k * 37 % 50)) for k in range(100)]
    store = incremental.invoice_store(spark, str(tmp_path / "i"), buckets=4)
    tie = ["_source_file", "amount_usd", "status"]
    for at in (60, 0, 20, 60, 80, 40):
        incremental.merge_latest(store, spark.createDataFrame(rows[at:at + 20], INVOICE_SCHEMA), tiebreak=tie)
    expected = keep_latest(spark.createDataFrame(rows, INVOICE_SCHEMA), UPSERT_KEYS, tiebreak=tie)
    assert sorted(map(str, store.read().collect())) == sorted(map(str, expected.collect()))


def test_firsts_equal_one_ranking_of_everything(spark, tmp_path):
    rows = [pay(f"P{k * 7 % 31}", str(k + 1), T0 + dt.timedelta(minutes=k)) for k in range(90)]
    store = incremental.payment_store(spark, str(tmp_path / "p"), buckets=4)
    for k in range(3):
        incremental.add_firsts(store, spark.createDataFrame(rows[30 * k:30 * k + 30], PAYMENT_SCHEMA), "q", k)
    expected = keep_first(spark.createDataFrame(rows, PAYMENT_SCHEMA), ["payment_id"], ["_loaded_at"])
    assert sorted(map(str, store.read().collect())) == sorted(map(str, expected.collect()))
