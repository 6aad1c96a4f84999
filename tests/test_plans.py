"""Plans and mechanisms: shuffles of the co-partitioned ledger, checks observed in writes, cuts in one pass, hot id lists."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from arlark.operators import quality
from arlark.operators.matching import matched_payments, payment_id_chunks
from arlark.operators.metrics import metric_cuts, metric_query
from arlark.plans import jobs
from arlark.schemas import EVENT_SCHEMA, INVOICE_SCHEMA, PAYMENT_SCHEMA

T0 = dt.datetime(2026, 1, 1)
AS_OF = dt.date(2026, 3, 1)


def raw_tables(spark, n=40):
    inv = [(f"I{k}", f"C{k % 7}", f"N{k % 7}", dt.date(2026, 1, 1 + k % 28), dt.date(2026, 2, 1 + k % 28), Decimal(100 + k), "USD",
            "OPEN" if k % 3 else "DISPUTED", "sap" if k % 2 else "netsuite", None, 1, T0, "f") for k in range(n)]
    pay = [(f"P{k}", f"I{k % n}" if k % 5 else None, f"C{k % n % 7}", dt.date(2026, 2, 1 + k % 20), Decimal(10 + k), "USD", "ach", "manual", False, None, None, T0,
            "e") for k in range(3 * n)]
    ev = [(f"E{k}", f"I{k % n}", "C", "email_sent", T0 + dt.timedelta(days=k % 30), "system", None, T0, "") for k in range(2 * n)]
    return (spark.createDataFrame(inv, INVOICE_SCHEMA), spark.createDataFrame(pay, PAYMENT_SCHEMA), spark.createDataFrame(ev, EVENT_SCHEMA))


def ledger(spark):
    from arlark.operators.ledger import build_ledger
    from arlark.operators.staging import stg_erp_invoices, stg_payments, stg_product_events

    inv, pay, ev = raw_tables(spark)
    return build_ledger(stg_erp_invoices(inv, AS_OF), stg_payments(pay), stg_product_events(ev), AS_OF)


def test_the_copartitioned_ledger_moves_rows_for_unapplied_cash_only(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = jobs.copartitioned_ledger(*raw_tables(spark), AS_OF, buckets=4)
        plan = stored._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(invoice_id") == 0, plan
        assert plan.count("Exchange hashpartitioning") <= 4, plan
        assert sorted(map(str, stored.collect())) == sorted(map(str, ledger(spark).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_row_tests_are_counted_while_writing(spark, tmp_path, monkeypatch):
    from arlark.operators.staging import stg_erp_invoices, stg_payments, stg_product_events

    inv, pay, ev = raw_tables(spark)
    inv = inv.withColumn("status", F.when(F.col("invoice_id") == "I3", "odd").otherwise(F.col("status")))
    ev = ev.withColumn("customer_id", F.when(F.col("event_id") == "E1", None).otherwise(F.col("customer_id")))
    models = jobs.build_warehouse_models(stg_erp_invoices(inv, AS_OF), stg_payments(pay), stg_product_events(ev), AS_OF, str(tmp_path))
    scanned = quality.run_warehouse_tests(dict(models))
    with monkeypatch.context() as m:
        m.setattr(quality, "_row_condition", lambda t: pytest.fail("a row test was counted again"))
        observed = quality.run_warehouse_tests(models, observed=models.observed)
    assert sorted(map(tuple, observed.collect())) == sorted(map(tuple, scanned.collect()))
    failed = {(r.model, r.column) for r in observed.where("status = 'fail'").collect()}
    assert failed == {("stg_erp_invoices", "status"), ("stg_product_events", "customer_id")}
    assert models.observed["stg_payments"]["rows"] == 120 and models.failures("negative_outstanding") == 0


def test_cuts_equal_the_single_queries_from_one_ledger(spark):
    names = ["ar_outstanding", "collection_rate", "overdue_invoice_count"]
    cuts = {"s": (["status"], None), "cs": (["customer_id", "source_system"], None), "w": ([], "week"), "sm": (["status"], "month"), "d": (["status"], "day"),
            "all": ([], None)}
    rows = metric_cuts(ledger(spark), names, cuts)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand") == 1
    got = rows.collect()
    for cut, (dims, grain) in cuts.items():
        single = metric_query(ledger(spark), names, dims, grain).collect()
        period = [f"invoice_date__{grain}"] if grain else []
        expected = sorted(str([r[c] for c in [*dims, *period, *names]]) for r in single)
        assert sorted(str([r[c] for c in [*dims, *(["period"] if grain else []), *names]]) for r in got if r.cut == cut) == expected, cut
    assert {r.cut for r in got} == set(cuts) and all(r.status is None for r in got if r.cut == "w")
    with pytest.raises(ValueError, match="unknown grain"):
        metric_cuts(ledger(spark), names, {"x": ([], "hour")})
    with pytest.raises(ValueError, match="same dimensions"):
        metric_cuts(ledger(spark), names, {"x": (["status"], None), "y": (["status"], None)})


def test_the_ids_of_a_hot_invoice_come_in_pieces(spark):
    rows = [(f"P{k:05d}", "HOT", "C", dt.date(2026, 1, 1 + k * 7 % 28), Decimal(1), T0) for k in range(4000)]
    rows += [(f"Q{k}", f"I{k % 50}", None if k % 2 else "C", dt.date(2026, 1, 1), Decimal(1), T0) for k in range(300)] + [("U", None, "C", None, Decimal(1), T0)]
    rows += [(f"N{k}", "I1", "C", None, Decimal(1), T0) for k in range(5)]
    df = spark.createDataFrame(rows, "payment_id string, invoice_id string, customer_id string, payment_date date, amount_usd decimal(18,2), loaded_at timestamp_ntz")
    got = payment_id_chunks(df.repartition(6), chunk=64, partitions=9).collect()
    lists = {}
    for r in sorted(got, key=lambda r: r.chunk):
        assert r.payment_count == len(r.payment_ids.split(",")) <= 64
        lists.setdefault((r.invoice_id, r.customer_id), []).append(r)
    whole = {(r.invoice_id, r.customer_id): r.payment_ids for r in matched_payments(df).collect()}
    assert {k: ",".join(r.payment_ids for r in v) for k, v in lists.items()} == whole
    assert all([r.chunk for r in v] == list(range(len(v))) and all(r.payment_count == 64 for r in v[:-1]) for v in lists.values())
    assert len(lists["HOT", "C"]) == 63
