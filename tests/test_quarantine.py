"""The quarantine keeps source texts; bad records never end a job; repaired ones are admitted exactly once."""

import datetime as dt
import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from arlark.operators.normalize import (
    canonicalize_invoices, normalize_erp, normalize_payments, normalize_product_events, parse_json_payloads, split_quarantine,
)
from arlark.plans import jobs, replay
from arlark.schemas import EVENT_PAYLOAD_SCHEMA, FLAT_PAYMENT_PAYLOAD_SCHEMA, STRIPE_PAYLOAD_SCHEMA, erp_source_schema
from arlark.sources.files import read_json_records
from arlark.streaming import streams


def stripe(pid="pi", amount=100, created=1740830400, **meta):
    return json.dumps({"id": "evt", "data": {"object": {"id": pid, "amount_received": amount, "created": created, "metadata": {
        "invoice_id": "I", "customer_id": "C", **meta}}}})


def texts(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def judged(df):
    return [(tuple(r._errors), r._raw) for r in df.collect()]


def test_overflowing_stripe_records_are_quarantined_alone(spark):
    bad = [(stripe(created=1740830400 * 10**9), "invalid payment_date"), (stripe(created=1740830400 * 1000), "invalid payment_date"),
           (stripe(amount=int("1234567890" * 2 + "12345")), "invalid amount"), (stripe(created=10**30), "invalid payment_date"),
           (stripe(amount="1e400"), "invalid amount"), (stripe(created=-10**15), "invalid payment_date")]
    good = [stripe("p1"), stripe("p2", amount=99999999999999999), stripe("p3", created=-86400), stripe("p4", created=253402300799)]
    rows = normalize_payments(parse_json_payloads(texts(spark, [*(b for b, _ in bad), *good]), STRIPE_PAYLOAD_SCHEMA), "stripe")
    assert judged(rows)[:len(bad)] == [((e,), b) for b, e in bad]
    valid, rejected = split_quarantine(rows)
    assert rejected.count() == len(bad) and "_raw" not in valid.columns
    got = {r.payment_id: (r.payment_date, r.amount_usd) for r in valid.collect()}
    assert got == {"p1": (dt.date(2025, 3, 1), Decimal("1.00")), "p2": (dt.date(2025, 3, 1), Decimal("999999999999999.99")),
                   "p3": (dt.date(1969, 12, 31), Decimal("1.00")), "p4": (dt.date(9999, 12, 31), Decimal("1.00"))}


@pytest.mark.parametrize("text", ["not json", "", None, "[]", "[{}]", '{"payment_id": "P"', "42", '"text"', '{"data": "flat"}', " "])
def test_what_is_no_object_of_the_schema_is_invalid_json(spark, text):
    df = spark.createDataFrame([(text,)], "value string")
    assert judged(normalize_payments(parse_json_payloads(df, STRIPE_PAYLOAD_SCHEMA), "stripe")) == [(("invalid json",), text)]


def test_events_and_payments_keep_their_text(spark):
    broken = '{"event_id": "E", "occurred_at": "soon"'
    late = json.dumps({"event_id": "E", "invoice_id": "I", "customer_id": "C", "event_type": "email_sent", "occurred_at": "soon"})
    fine = json.dumps({"event_id": "F", "invoice_id": "I", "customer_id": "C", "event_type": "email_sent", "occurred_at": "2026-01-01T00:00:00"})
    rows = normalize_product_events(parse_json_payloads(texts(spark, [broken, late, fine]), EVENT_PAYLOAD_SCHEMA))
    assert judged(rows) == [(("invalid json",), broken), (("invalid occurred_at",), late), ((), None)]
    amount = json.dumps({"payment_id": "P", "invoice_id": "I", "customer_id": "C", "payment_date": "2025-02-01", "amount_usd": "n/a", "extra": 1})
    bad = split_quarantine(normalize_payments(parse_json_payloads(texts(spark, [amount]), FLAT_PAYMENT_PAYLOAD_SCHEMA), "bank"))[1].first()
    assert bad._raw == amount and bad.amount_usd is None


def test_erp_rows_keep_their_source_columns(spark):
    schema = erp_source_schema("netsuite")
    row = {f.name: None for f in schema.fields} | {"tranid": "T", "amount": "n/a", "status": "Open", "trandate": "2025-01-01", "duedate": "2025-02-01"}
    df = spark.createDataFrame([tuple(row[f.name] for f in schema.fields)], schema)
    r = normalize_erp(df, "netsuite").first()
    assert r._errors == ["missing customer_id", "invalid amount_usd"]
    assert json.loads(r._raw) == {k: v for k, v in row.items() if v is not None}


def test_broken_files_are_one_record_each(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"payment_id": "P1", "invoice_id": "I", "customer_id": "C", "payment_date": "2025-01-01", "amount_usd": "5"}]')
    (tmp_path / "b.json").write_text('[{"payment_id": "P2", ')
    rows = normalize_payments(read_json_records(spark, str(tmp_path / "*.json"), FLAT_PAYMENT_PAYLOAD_SCHEMA), "manual")
    valid, bad = split_quarantine(rows)
    assert [r.payment_id for r in valid.collect()] == ["P1"]
    assert [(r._errors, r._raw) for r in bad.collect()] == [(["invalid json"], '[{"payment_id": "P2", ')]


def test_streams_quarantine_overflow_with_its_text(spark, tmp_path):
    inbox = str(tmp_path / "inbox")
    rows = [stripe("p1"), stripe("p2", created=10**18), "{broken", stripe("p3", amount=10**25)]
    texts(spark, rows).write.text(inbox)
    valid, bad = streams.run_split(streams.normalized_payment_stream(streams.json_message_stream(spark, inbox), "stripe"),
                                   str(tmp_path / "ok"), str(tmp_path / "bad"), str(tmp_path / "ckpt"))
    assert [r.payment_id for r in valid.collect()] == ["p1"]
    assert {r._raw for r in bad.collect()} == set(rows[1:])


def payments(spark, rows):
    return normalize_payments(parse_json_payloads(texts(spark, rows), FLAT_PAYMENT_PAYLOAD_SCHEMA), "manual")


def record(pid, **fields):
    return json.dumps({"payment_id": pid, "invoice_id": "I", "customer_id": "C", "payment_date": "2025-01-01", "amount_usd": "5", **fields})


def test_a_repaired_record_is_admitted_exactly_once(spark, tmp_path):
    bad = [record("P1", amount_usd="n/a"), record("P2", invoice_id=""), "{cut", record("P4", amount_usd="0"), record("P1", amount_usd="n/a")]
    _, rejected = split_quarantine(payments(spark, [record("P0"), *bad]))
    path = str(tmp_path / "quarantine")
    rejected.write.parquet(path)
    records = replay.quarantine_records(spark.read.parquet(path), "payments/manual")
    assert records.count() == 4                                   # one text delivered twice is one record
    ids = {r.raw: r.record_id for r in records.collect()}
    log = replay.ReplayLog(spark, str(tmp_path / "replays"), "payments/manual")
    assert log.admitted().count() == 0 and log.open_records(records).count() == 4

    def repairs(*rows):
        return spark.createDataFrame(list(rows), "record_id string, text string")

    first = repairs((ids[bad[0]], record("P1", amount_usd="7")), (ids[bad[1]], record("P2", invoice_id=" ")), (ids["{cut"], "{still cut"),
                    ("unknown", record("P9")))
    assert log.replay(records, first) == {"admitted": 2, "rejected": 1}
    assert log.replay(records, first) == {"admitted": 0, "rejected": 1}       # nothing twice
    two = repairs((ids[bad[3]], record("P4", amount_usd="1")), (ids[bad[3]], record("P4", amount_usd="2")), (ids["{cut"], record("P3")),
                  (ids["{cut"], record("P3")))
    assert log.replay(records, two) == {"admitted": 1, "rejected": 1}
    got = {r.payment_id: (r.amount_usd, r._record_id) for r in log.admitted().collect()}
    assert {p: a for p, (a, _) in got.items()} == {"P1": Decimal("7.00"), "P2": Decimal("5.00"), "P3": Decimal("5.00")}
    assert got["P1"][1] == ids[bad[0]]
    assert [r.raw for r in log.open_records(records).collect()] == [bad[3]]
    assert ["ambiguous repair"] in [r._errors for r in log.results().collect()]


def test_a_replay_that_died_before_its_commit_leaves_nothing(spark, tmp_path, monkeypatch):
    _, rejected = split_quarantine(payments(spark, [record("P1", amount_usd="n/a")]))
    records = replay.quarantine_records(rejected, "payments/manual")
    rid = records.first().record_id
    fixes = spark.createDataFrame([(rid, record("P1"))], "record_id string, text string")
    log = replay.ReplayLog(spark, str(tmp_path), "payments/manual")
    monkeypatch.setattr(spark, "range", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        log.replay(records, fixes)
    monkeypatch.undo()
    assert log.admitted().count() == 0 and os.listdir(tmp_path / "results")
    assert log.replay(records, fixes) == {"admitted": 1, "rejected": 0} and log.admitted().count() == 1


def test_events_and_erp_rows_are_replayed_by_their_own_parsers(spark, tmp_path):
    event = json.dumps({"event_id": "E", "invoice_id": "I", "customer_id": "C", "event_type": "email_sent"})
    rejected = split_quarantine(normalize_product_events(parse_json_payloads(texts(spark, [event]), EVENT_PAYLOAD_SCHEMA)))[1]
    records = replay.quarantine_records(rejected, "events")
    fixed = records.select("record_id", F.regexp_replace("raw", "}$", ', "timestamp": "2026-01-01T10:00:00"}').alias("text"))
    log = replay.ReplayLog(spark, str(tmp_path / "e"), "events")
    assert log.replay(records, fixed) == {"admitted": 1, "rejected": 0}
    assert log.admitted().first().occurred_at == dt.datetime(2026, 1, 1, 10)

    schema = erp_source_schema("sap")
    values = {"billing_document": "D", "sold_to_party": "K", "billing_date": "2025-05-20", "net_due_date": "2025-06-19", "net_value": "x", "status": "Open"}
    df = spark.createDataFrame([tuple(values.get(f.name) for f in schema.fields)], schema)
    records = replay.quarantine_records(split_quarantine(normalize_erp(df, "sap"))[1], "erp/sap")
    log = replay.ReplayLog(spark, str(tmp_path / "s"), "erp/sap")
    assert log.replay(records, records.select("record_id", F.regexp_replace("raw", '"x"', '"8.80"').alias("text"))) == {"admitted": 1, "rejected": 0}
    got = log.admitted().first()
    assert (got.invoice_id, got.amount_usd, got.source_system) == ("D", Decimal("8.80"), "sap")

    rows = spark.createDataFrame([("I", "C", "2025-01-01", "2025-02-01", "5", "Open", "oracle")],
                                 "invoice_id string, customer_id string, invoice_date string, due_date string, amount_usd string, status string, source_system string")
    records = replay.quarantine_records(split_quarantine(canonicalize_invoices(rows))[1], "erp")
    log = replay.ReplayLog(spark, str(tmp_path / "c"), "erp")
    assert log.replay(records, records.select("record_id", F.regexp_replace("raw", "oracle", "SAP").alias("text"))) == {"admitted": 1, "rejected": 0}
    with pytest.raises(ValueError, match="unknown kind"):
        replay.quarantine_records(records, "letters")


def test_the_pipeline_stores_texts_that_can_be_replayed(spark, tmp_path):
    drop = tmp_path / "drop" / "payments"
    os.makedirs(drop)
    (drop / "p.json").write_text("[" + ",".join([record("P1"), record("P2", amount_usd="many")]) + "]")
    out = str(tmp_path / "out")
    jobs.run_local_pipeline(spark, str(tmp_path / "drop"), out, "2026-01-01", strict=False)
    records = replay.quarantine_records(spark.read.parquet(os.path.join(out, "quarantine", "payment_events")), "payments/manual")
    log = replay.ReplayLog(spark, os.path.join(out, "replays"), "payments/manual")
    fixes = records.select("record_id", F.regexp_replace("raw", "many", "9").alias("text"))
    assert log.replay(records, fixes) == {"admitted": 1, "rejected": 0}
    raw = spark.read.parquet(os.path.join(out, "raw", "payment_events"))
    both = raw.select("payment_id", "amount_usd").union(log.admitted().select("payment_id", "amount_usd"))
    assert {r.payment_id: r.amount_usd for r in both.collect()} == {"P1": Decimal("5.00"), "P2": Decimal("9.00")}
