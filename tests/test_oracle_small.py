"""Every registered query against its DuckDB oracle text on the smallest driver tables."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "scripts"))
SF = "/root/testdata/sf0.001"

import __spark_entry__ as entry  # noqa: E402

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    import duckdb
    from check_oracle import register_tables

    c = duckdb.connect()
    register_tables(c, SF)
    return c


def test_every_query_has_an_oracle_or_is_rows_only():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 50


def test_every_receivables_query_has_sql():
    from arlark.plans.catalog import registered

    assert set(registered()) == set(registered()) & set(entry.oracle_sql())


def test_every_rule_is_broken_by_a_row_of_a_registered_query(con):
    """Each message of the normalizers stands in the errors of a query's SQL, next to rows without it."""
    import re

    from arlark.operators import normalize

    text = open(normalize.__file__, encoding="utf-8").read()
    messages = set(re.findall(r'"((?:missing|invalid|negative|non-positive|due_date before) [a-z_ ]+)"', text))
    # an unknown payment method becomes "unknown", which is allowed, before the rule is asked
    messages -= {"invalid payment_method"}
    found = set()
    for name in ("payment_quarantine", "event_quarantine", "erp_quarantine_rules", "erp_quarantine"):
        for (errors,) in con.execute(f"select distinct errors from ({entry.oracle_sql()[name]})").fetchall():
            found |= set(errors.split("; "))
    assert messages <= found, messages - found


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    from check_oracle import compare

    ok, msg = compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "ar_risk_band" in df.columns


def test_gate_with_real_limits_names_stale_sources(spark):
    rows = entry.queries()["publish_gate_stale"](spark, SF).collect()
    assert {(r.stage, r.published) for r in rows} == {("freshness", "false")}
    assert "stale:erp_invoices" in {r.failed for r in rows}


def test_rejected_bank_payments_are_in_a_registered_query(spark):
    rows = entry.queries()["payment_quarantine_bank"](spark, SF).collect()
    assert rows and {r.processor for r in rows} == {"bank"}
