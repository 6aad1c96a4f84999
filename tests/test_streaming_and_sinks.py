"""Upsert semantics and multi-batch streaming behaviour."""

import datetime as dt
import json
import os
import uuid
from decimal import Decimal

from pyspark.sql import functions as F

from arlark.plans.sinks import read_feature_snapshot, upsert_invoices, write_feature_snapshot
from arlark.schemas import EVENT_SCHEMA, FEATURE_SCHEMA, INVOICE_SCHEMA, PAYMENT_SCHEMA
from arlark.streaming import streams

T0 = dt.datetime(2026, 1, 1)


def inv(i, src, cust, status, amount, loaded, po):
    return (i, cust, "Name", dt.date(2026, 1, 1), dt.date(2026, 1, 31), Decimal(amount), "USD", status, src, po, 1,
            loaded, "f.csv")


def test_upsert_updates_listed_columns_and_inserts(spark):
    target = spark.createDataFrame([inv("A", "netsuite", "C1", "OPEN", "10.00", T0, "PO-A"),
                                    inv("B", "sap", "C2", "OPEN", "20.00", T0, "PO-B")], INVOICE_SCHEMA)
    later = T0 + dt.timedelta(hours=6)
    source = spark.createDataFrame([inv("A", "netsuite", "C9", "PAID", "11.00", later, "PO-NEW"),
                                    inv("C", "sap", "C3", "OPEN", "30.00", later, "PO-C")], INVOICE_SCHEMA)
    out = {r.invoice_id: r for r in upsert_invoices(target, source).collect()}
    assert set(out) == {"A", "B", "C"}
    a = out["A"]
    assert (a.customer_id, a.status, a.amount_usd, a._loaded_at) == ("C9", "PAID", Decimal("11.00"), later)
    assert a.po_number == "PO-A"            # not in the update list: kept from the target
    assert out["B"].status == "OPEN" and out["C"].po_number == "PO-C"


def _event(eid, invoice, etype, at):
    return (eid, invoice, "C1", etype, at, "system", None, at, "")


def test_touch_counts_merge_across_batches(spark, tmp_path):
    inbox, out = str(tmp_path / "inbox"), str(tmp_path / "out")
    spark.createDataFrame([_event("E1", "I1", "email_sent", T0), _event("E2", "I2", "page_viewed", T0)],
                          EVENT_SCHEMA).write.parquet(os.path.join(inbox, "b1"))
    stream = spark.readStream.schema(EVENT_SCHEMA).parquet(os.path.join(inbox, "*"))
    table = os.path.join(out, "table")

    def run(checkpoint):
        streams.run_available_now(stream, checkpoint, foreach_batch=streams.append_touch_counts(table, checkpoint))
        return {r.invoice_id: (r.collection_attempt_count, r.last_outreach_at) for r in streams.touch_counts(spark, table).collect()}

    first = os.path.join(out, "ckpt")
    run(first)
    later = T0 + dt.timedelta(days=1)
    for k, rows in enumerate([[_event("E3", "I1", "call_logged", later)], [_event("E4", "I3", "Dispute_Opened", later)]]):
        spark.createDataFrame(rows, EVENT_SCHEMA).write.parquet(os.path.join(inbox, f"b{k + 2}"))
        got = run(first)
    assert got == {"I1": (2, later), "I3": (1, later)}
    # a new checkpoint reads the inbox again: its folders are new ones, nothing stored before is replaced
    assert run(os.path.join(out, "other")) == {"I1": (4, later), "I3": (2, later)}


def _pay(pid, amount, at):
    return (pid, "I1", "C1", at.date(), Decimal(amount), "USD", "ach", "manual", False, None, None, at, "")


def test_late_and_repeated_payments(spark, tmp_path):
    """A unique payment is never lost, however old its load time; the first copy to arrive is read back."""
    inbox, out = str(tmp_path / "inbox"), str(tmp_path / "out")
    table, checkpoint = os.path.join(out, "table"), os.path.join(out, "ckpt")
    stream = spark.readStream.schema(PAYMENT_SCHEMA).parquet(os.path.join(inbox, "*"))
    batches = [[_pay("P1", "5.00", T0), _pay("P2", "6.00", T0)],
               [_pay("P1", "7.00", T0 - dt.timedelta(days=40)), _pay("P3", "8.00", T0 - dt.timedelta(days=400))],
               [_pay("P2", "9.00", T0 + dt.timedelta(days=400)), _pay("P4", "1.00", T0 - dt.timedelta(days=1))]]
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, PAYMENT_SCHEMA).write.parquet(os.path.join(inbox, f"b{k}"))
        streams.run_available_now(streams.dedupe_payment_stream(stream), checkpoint,
                                  foreach_batch=streams.append_batches(table, checkpoint))
    rows = streams.first_payments(streams.stored_batches(spark, table, PAYMENT_SCHEMA)).collect()
    assert {r.payment_id: r.amount_usd for r in rows} == {
        "P1": Decimal("5.00"), "P2": Decimal("6.00"), "P3": Decimal("8.00"), "P4": Decimal("1.00")}


def test_streams_store_valid_and_quarantined_rows(spark, tmp_path):
    inbox = str(tmp_path / "inbox")
    lines = [json.dumps({"payment_id": f"P{k}", "invoice_id": "I", "customer_id": "C", "payment_date": "2025-02-01",
                         "amount_usd": str(k)}) for k in range(4)] + ["not json"]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(inbox)
    rows = streams.normalized_payment_stream(streams.json_message_stream(spark, inbox), "bank")
    valid, bad = streams.run_split(rows, str(tmp_path / "ok"), str(tmp_path / "bad"), str(tmp_path / "ckpt"))
    assert sorted(r.payment_id for r in valid.collect()) == ["P1", "P2", "P3"]
    assert sorted(str(r.payment_id) for r in bad.collect()) == ["None", "P0"]


def test_a_batch_is_read_and_parsed_once(spark, tmp_path):
    inbox, seen = str(tmp_path / "inbox"), str(tmp_path / "seen")
    os.makedirs(inbox)
    os.makedirs(seen)

    def count(batches):
        for batch in batches:
            with open(os.path.join(seen, uuid.uuid4().hex), "w") as f:
                f.write(str(batch.num_rows))
            yield batch

    def run():
        return streams.run_split(rows, str(tmp_path / "ok"), str(tmp_path / "bad"), str(tmp_path / "ckpt"))

    good = '{"payment_id":"%s","invoice_id":"I","customer_id":"C","payment_date":"2025-02-01","amount_usd":"1"}'
    messages = streams.json_message_stream(spark, inbox).mapInArrow(count, "value string")
    rows = streams.normalized_payment_stream(messages, "bank")
    for arrived, n in (([good % "a", good % "b", "x"], 3), ([good % "c"], 4), (["y", "{"], 6)):     # a batch without either kind, too
        spark.createDataFrame([(x,) for x in arrived], "value string").coalesce(1).write.mode("append").text(inbox)
        valid, bad = run()
        assert sum(int((tmp_path / "seen" / f).read_text()) for f in os.listdir(seen)) == n
    assert sorted(r.payment_id for r in valid.collect()) == ["a", "b", "c"] and "_errors" not in valid.columns
    assert sorted(r._raw for r in bad.collect()) == ["x", "y", "{"]
    assert {(r.batch_id, r._errors[0]) for r in bad.collect()} == {(0, "invalid json"), (2, "invalid json")}
    # what was stored before a restart is replaced by the same batch, not doubled
    for name in os.listdir(tmp_path / "ckpt" / "commits"):
        if name.strip(".").startswith("2"):
            os.remove(tmp_path / "ckpt" / "commits" / name)
    valid, bad = run()
    assert valid.count() == 3 and bad.count() == 3


def _state_files(checkpoint):
    return [f for _, _, files in os.walk(os.path.join(checkpoint, "state")) for f in files if not f.endswith(".crc")]


def test_ids_of_a_stream_lie_in_files_and_old_checkpoints_go_on(spark, tmp_path):
    provider = "spark.sql.streaming.stateStore.providerClass"
    in_memory = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    inbox = str(tmp_path / "inbox")
    stream = streams.dedupe_payment_stream(spark.readStream.schema(PAYMENT_SCHEMA).parquet(os.path.join(inbox, "*")))
    new, old = str(tmp_path / "new"), str(tmp_path / "old")

    def run(checkpoint):
        table = checkpoint + "-table"
        streams.run_available_now(stream, checkpoint, foreach_batch=streams.append_batches(table, checkpoint))
        return sorted((r.payment_id, r.amount_usd) for r in streams.stored_batches(spark, table, PAYMENT_SCHEMA).collect())

    try:
        for k, rows in enumerate([[_pay("P1", "5.00", T0), _pay("P2", "6.00", T0)], [_pay("P1", "7.00", T0), _pay("P3", "8.00", T0)]]):
            spark.createDataFrame(rows, PAYMENT_SCHEMA).write.parquet(os.path.join(inbox, f"b{k}"))
            spark.conf.unset(provider)
            got = [run(new)]
            if not k:
                spark.conf.set(provider, in_memory)
            got.append(run(old))
            assert got[0] == got[1]
    finally:
        spark.conf.unset(provider)
    assert got[0] == [("P1", Decimal("5.00")), ("P2", Decimal("6.00")), ("P3", Decimal("8.00"))]
    assert any(f.endswith(".sst") or f.endswith(".zip") for f in _state_files(new)) and not any(f.endswith(".delta") for f in _state_files(new))
    assert any(f.endswith(".delta") for f in _state_files(old))


def test_feature_snapshot_rerun_replaces_only_its_day(spark, tmp_path):
    path = str(tmp_path / "features")

    def features(day, value):
        return spark.createDataFrame([("C1", day, value, 0.0, 0.0, 0.0, 0, None, 1.0, 0.0, 0.0, 0.0)], FEATURE_SCHEMA)

    write_feature_snapshot(features(dt.date(2026, 3, 1), 1.0), path)
    write_feature_snapshot(features(dt.date(2026, 4, 1), 2.0), path)
    write_feature_snapshot(features(dt.date(2026, 4, 1), 3.0), path)
    got = {r.as_of_date: r.avg_days_to_pay_90d for r in read_feature_snapshot(spark, path).collect()}
    assert got == {dt.date(2026, 3, 1): 1.0, dt.date(2026, 4, 1): 3.0}
    assert read_feature_snapshot(spark, path, "2026-03-01").count() == 1
