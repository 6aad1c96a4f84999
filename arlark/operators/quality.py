"""Data-quality checks as set-based Spark jobs.

Every suite is one aggregation pass (all checks of a table are conditional
aggregates of the same ``agg``) whose single result row is unpivoted into
one row per check.  Results are DataFrames, so they can gate a job
(``assert_passed``), be written next to the data, or be reported.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arlark.schemas import (
    CURRENCY_PATTERN,
    CUSTOMER_ID_MAX_NULL_RATE,
    EXPECTATION_SUITES,
    FRESHNESS_HOURS,
    PAYMENT_MAX_AMOUNT_USD,
    TS,
    VALID_PAYMENT_METHODS,
    VALID_STATUSES,
)

CHECK_COLUMNS = ["suite", "check", "column", "observed", "threshold", "passed", "detail"]


def _checks_frame(row: DataFrame, suite: str, checks: list[tuple[str, str, Column, float, Column, Column]]) -> DataFrame:
    """Turn one aggregate row into (suite, check, column, observed, threshold, passed, detail) rows."""
    structs = [
        F.struct(
            F.lit(suite).alias("suite"), F.lit(name).alias("check"), F.lit(col).alias("column"),
            observed.cast("double").alias("observed"), F.lit(float(threshold)).alias("threshold"),
            passed.alias("passed"), detail.cast("string").alias("detail"))
        for name, col, observed, threshold, passed, detail in checks
    ]
    return row.select(F.inline(F.array(*structs)))


def bad_values(df: DataFrame, column: str, allowed: Sequence[str], fold) -> DataFrame:
    """(value, rows) of the values outside ``allowed``, one row each: grouped, whatever their number."""
    value = fold(column)
    return df.where(value.isNotNull() & ~value.isin(list(allowed))).groupBy(value.alias("value")).agg(
        F.count(F.lit(1)).alias("rows"))


def _named_bad_values(values: DataFrame, suite: str, column: str) -> DataFrame:
    return values.select(F.lit(suite).alias("suite"), F.lit(column).alias("column"), "value", "rows")


def invoice_bad_values(df: DataFrame) -> DataFrame:
    """(suite, column, value, rows): every value that fails an invoice set check."""
    return _named_bad_values(bad_values(df, "status", VALID_STATUSES, F.upper), "erp_invoices", "status")


def payment_bad_values(df: DataFrame) -> DataFrame:
    """(suite, column, value, rows): every value that fails a payment set check."""
    return _named_bad_values(bad_values(df, "payment_method", VALID_PAYMENT_METHODS, F.lower), "payments", "payment_method")


def _listed(df: DataFrame, bad: Column, counts: dict[str, Column]) -> DataFrame:
    """One row: the ``counts`` of all rows, ``bad_rows``, and ``bad_values``, the sorted list of every offending value.

    Rows are grouped by offending value first (NULL: none), so the list is put together from one row for each distinct value.
    """
    grouped = df.groupBy(bad.alias("bad")).agg(F.count(F.lit(1)).alias("all_rows"), *[c.alias(name) for name, c in counts.items()])
    return grouped.agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in counts],
        F.coalesce(F.sum(F.when(F.col("bad").isNotNull(), F.col("all_rows"))), F.lit(0)).alias("bad_rows"),
        F.expr("listagg(bad, ', ') WITHIN GROUP (ORDER BY bad)").alias("bad_values"))


def validate_invoices(df: DataFrame) -> DataFrame:
    """Invoice code checks: id nulls, customer null rate, negative amounts, status set, currency form.

    A set check's detail lists every offending value, sorted (see ``_listed``).
    """
    status = F.upper("status")
    bad_status = F.when(status.isNotNull() & ~status.isin(VALID_STATUSES), status)
    row = _listed(df, bad_status, {
        "n": F.count(F.lit(1)),
        "id_nulls": F.count_if(F.col("invoice_id").isNull()),
        "cust_nulls": F.count_if(F.col("customer_id").isNull()),
        "negative": F.count_if(F.col("amount_usd") < 0),
        "bad_currency": F.count_if(F.col("currency").isNotNull() & ~F.col("currency").rlike(CURRENCY_PATTERN)),
    }).withColumn("cust_null_rate", F.when(F.col("n") > 0, F.col("cust_nulls") / F.col("n")))
    c = F.col
    none = F.lit(None)
    return _checks_frame(row, "erp_invoices", [
        ("invoice_id_not_null", "invoice_id", c("id_nulls"), 0, c("id_nulls") == 0, none),
        ("customer_id_null_rate", "customer_id", F.coalesce(c("cust_null_rate"), F.lit(0.0)),
         CUSTOMER_ID_MAX_NULL_RATE, F.coalesce(c("cust_null_rate"), F.lit(0.0)) <= CUSTOMER_ID_MAX_NULL_RATE, none),
        ("amount_non_negative", "amount_usd", c("negative"), 0, c("negative") == 0, none),
        ("status_in_set", "status", c("bad_rows"), 0, c("bad_rows") == 0,
         c("bad_values")),
        ("currency_iso_like", "currency", c("bad_currency"), 0, c("bad_currency") == 0, none),
    ])


def validate_payments(df: DataFrame) -> DataFrame:
    """Payment code checks: id nulls, positive amount, $10M ceiling, method set.

    A set check's detail lists every offending value, sorted (see ``_listed``).
    """
    method = F.lower("payment_method")
    bad_method = F.when(method.isNotNull() & ~method.isin(VALID_PAYMENT_METHODS), method)
    row = _listed(df, bad_method, {
        "id_nulls": F.count_if(F.col("payment_id").isNull()),
        "non_positive": F.count_if(F.col("amount_usd") <= 0),
        "too_large": F.count_if(F.col("amount_usd") > PAYMENT_MAX_AMOUNT_USD),
    })
    c = F.col
    none = F.lit(None)
    return _checks_frame(row, "payments", [
        ("payment_id_not_null", "payment_id", c("id_nulls"), 0, c("id_nulls") == 0, none),
        ("amount_positive", "amount_usd", c("non_positive"), 0, c("non_positive") == 0, none),
        ("amount_below_ceiling", "amount_usd", c("too_large"), PAYMENT_MAX_AMOUNT_USD, c("too_large") == 0, none),
        ("payment_method_in_set", "payment_method", c("bad_rows"), 0, c("bad_rows") == 0,
         c("bad_values")),
    ])


def failures(results: DataFrame) -> Column:
    """Sorted list of failed check names (one-row aggregate over a check frame)."""
    return F.array_sort(F.collect_list(F.when(~F.col("passed"), F.col("check"))))


def summarize(results: DataFrame) -> DataFrame:
    """``{success, failures[]}`` per suite."""
    return results.groupBy("suite").agg(F.bool_and("passed").alias("success"), failures(results).alias("failures"))


def assert_passed(results: DataFrame) -> None:
    """Gate: raise if any check failed (the step that stops a publish)."""
    bad = results.where(~F.col("passed")).select("suite", "check").collect()    # at most one row per check
    if bad:
        raise RuntimeError("quality gate failed: " + ", ".join(f"{r.suite}.{r.check}" for r in bad))


# --------------------------------------------------------------------------- declarative expectations

def load_expectation_suite(name: str) -> list[dict]:
    return EXPECTATION_SUITES[name]


def _expectation_unexpected(e: dict) -> Column:
    kind, kw = e["expectation_type"], e["kwargs"]
    c = F.col(kw["column"])
    if kind == "expect_column_values_to_not_be_null":
        return c.isNull()
    if kind == "expect_column_values_to_be_between":
        cond = F.lit(False)
        if kw.get("min_value") is not None:
            cond = cond | (c < F.lit(kw["min_value"]))
        if kw.get("max_value") is not None:
            cond = cond | (c > F.lit(kw["max_value"]))
        return c.isNotNull() & cond
    if kind == "expect_column_values_to_be_in_set":
        return c.isNotNull() & ~c.isin(list(kw["value_set"]))
    if kind == "expect_column_values_to_match_regex":
        return c.isNotNull() & ~c.cast("string").rlike(kw["regex"])
    raise ValueError(f"unsupported expectation {kind}")


def run_expectation_suite(df: DataFrame, suite: str | Sequence[dict], suite_name: str | None = None) -> DataFrame:
    """Evaluate a suite in one pass: element and unexpected counts, percent, success (with ``mostly``)."""
    specs = load_expectation_suite(suite) if isinstance(suite, str) else list(suite)
    name = suite if isinstance(suite, str) else (suite_name or "suite")
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, e in enumerate(specs):
        aggs.append(F.count_if(_expectation_unexpected(e)).alias(f"u{i}"))
    row = df.agg(*aggs)
    structs = []
    for i, e in enumerate(specs):
        mostly = float(e["kwargs"].get("mostly", 1.0))
        u, n = F.col(f"u{i}"), F.col("n")
        pct = F.when(n == 0, F.lit(0.0)).otherwise(u.cast("double") / n * 100.0)
        ok = F.when(n == 0, F.lit(True)).otherwise((1.0 - u.cast("double") / n) >= mostly)
        structs.append(F.struct(
            F.lit(name).alias("suite"), F.lit(i).alias("position"), F.lit(e["expectation_type"]).alias("expectation_type"),
            F.lit(e["kwargs"]["column"]).alias("column"), n.alias("element_count"), u.alias("unexpected_count"),
            pct.alias("unexpected_percent"), F.lit(mostly).alias("mostly"), ok.alias("success")))
    return row.select(F.inline(F.array(*structs)))


# --------------------------------------------------------------------------- warehouse tests

@dataclass(frozen=True)
class ColumnTest:
    model: str
    column: str
    test: str                      # unique | not_null | accepted_values | relationships
    values: tuple = ()
    to: str = ""                   # parent model of a relationships test
    field: str = ""


def _t(model, column, *tests):
    return [ColumnTest(model, column, *t) if isinstance(t, tuple) else ColumnTest(model, column, t) for t in tests]


# The declared column tests of the warehouse models.
WAREHOUSE_TESTS: list[ColumnTest] = [
    *_t("stg_erp_invoices", "invoice_id", "unique", "not_null"),
    *_t("stg_erp_invoices", "customer_id", "not_null"),
    *_t("stg_erp_invoices", "invoice_date", "not_null"),
    *_t("stg_erp_invoices", "due_date", "not_null"),
    *_t("stg_erp_invoices", "amount_usd", "not_null"),
    *_t("stg_erp_invoices", "currency", "not_null"),
    *_t("stg_erp_invoices", "status", "not_null",
        ("accepted_values", ("OPEN", "PARTIAL", "PAID", "OVERDUE", "DISPUTED"))),
    *_t("stg_erp_invoices", "source_system", "not_null", ("accepted_values", ("netsuite", "quickbooks", "sap"))),
    *_t("stg_payments", "payment_id", "unique", "not_null"),
    *_t("stg_payments", "customer_id", "not_null"),
    *_t("stg_payments", "payment_date", "not_null"),
    *_t("stg_payments", "amount_usd", "not_null"),
    *_t("stg_payments", "payment_method", ("accepted_values", ("ach", "wire", "credit_card", "check", "unknown"))),
    *_t("stg_product_events", "event_id", "unique", "not_null"),
    *_t("stg_product_events", "invoice_id", "not_null"),
    *_t("stg_product_events", "customer_id", "not_null"),
    *_t("stg_product_events", "event_type",
        ("accepted_values", ("email_sent", "call_logged", "reminder_triggered", "dispute_opened"))),
    *_t("fct_ar_ledger", "invoice_id", "unique", "not_null"),
    *_t("fct_ar_ledger", "customer_id", "not_null", ("relationships", (), "dim_customers", "customer_id")),
    *_t("fct_ar_ledger", "amount_outstanding_usd", "not_null"),
    *_t("dim_customers", "customer_id", "unique", "not_null"),
    *_t("mrt_collections_health", "customer_id", "unique", "not_null",
        ("relationships", (), "dim_customers", "customer_id")),
]


#: Not declared upstream: events of invoices that do not exist, which the staged events do contain.
EVENT_PARENT_TEST = ColumnTest("stg_product_events", "invoice_id", "relationships", (), "stg_erp_invoices", "invoice_id")


def failing_rows(models: dict[str, DataFrame], t: ColumnTest) -> DataFrame:
    """The rows a test returns when it fails (empty when it passes)."""
    df = models[t.model]
    c = F.col(t.column)
    if t.test == "not_null":
        return df.where(c.isNull()).select(t.column)
    if t.test == "unique":
        return df.where(c.isNotNull()).groupBy(t.column).count().where(F.col("count") > 1)
    if t.test == "accepted_values":
        # NULL is neither accepted nor rejected: it passes
        return df.where(~c.isin(list(t.values))).select(t.column)
    if t.test == "relationships":
        parent = models[t.to].select(F.col(t.field).alias("__parent_key")).where(F.col("__parent_key").isNotNull())
        child = df.where(c.isNotNull()).select(t.column)
        return child.join(parent, child[t.column] == parent["__parent_key"], "left_anti")
    raise ValueError(f"unknown test {t.test}")


def _row_condition(t: ColumnTest) -> Column:
    c = F.col(t.column)
    if t.test == "not_null":
        return c.isNull()
    if t.test == "accepted_values":
        return ~c.isin(list(t.values))       # NULL is neither accepted nor rejected: it passes
    raise ValueError(t.test)


ROW_TESTS = ("not_null", "accepted_values")


def row_test_measures(model: str, tests: Sequence[ColumnTest] = WAREHOUSE_TESTS) -> dict[str, Column]:
    """The row-level tests of a model as aggregates, to be observed while it is written."""
    return {f"{t.column}.{t.test}": F.count_if(_row_condition(t)) for t in tests if t.model == model and t.test in ROW_TESTS}


def run_warehouse_tests(models: dict[str, DataFrame], tests: Sequence[ColumnTest] = WAREHOUSE_TESTS,
                        singular: dict[str, DataFrame | int] | None = None, observed: dict[str, dict] | None = None) -> DataFrame:
    """(model, column, test, failures, status) for every declared test plus singular tests.

    Row-level tests (not_null, accepted_values) of one model are conditional
    counts of a single aggregation pass over it; ``unique`` needs a grouping
    per column and ``relationships`` an anti join, so those run separately.  Counts that were ``observed`` while a model
    was written (``row_test_measures``) are taken as they are, and so is a singular test given as its number of failures.
    """
    parts, known = [], []
    observed = observed or {}
    spark = next(iter(models.values())).sparkSession
    by_model: dict[str, list[ColumnTest]] = {}
    for t in tests:
        by_model.setdefault(t.model, []).append(t)
    for model, ts in by_model.items():
        row_tests = [t for t in ts if t.test in ROW_TESTS]
        seen = observed.get(model, {})
        known.extend((model, t.column, t.test, seen[f"{t.column}.{t.test}"]) for t in row_tests if f"{t.column}.{t.test}" in seen)
        row_tests = [t for t in row_tests if f"{t.column}.{t.test}" not in seen]
        if row_tests:
            counts = models[model].agg(*[F.count_if(_row_condition(t)).alias(f"t{i}")
                                         for i, t in enumerate(row_tests)])
            parts.append(counts.select(F.inline(F.array(*[
                F.struct(F.lit(t.model).alias("model"), F.lit(t.column).alias("column"),
                         F.lit(t.test).alias("test"), F.col(f"t{i}").alias("failures"))
                for i, t in enumerate(row_tests)]))))
        for t in ts:
            if t.test in ("unique", "relationships"):
                parts.append(failing_rows(models, t).agg(F.count(F.lit(1)).alias("failures")).select(
                    F.lit(t.model).alias("model"), F.lit(t.column).alias("column"), F.lit(t.test).alias("test"),
                    "failures"))
    for name, rows in (singular or {}).items():
        if isinstance(rows, int):
            known.append((name, None, "singular", rows))
            continue
        parts.append(rows.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(name).alias("model"), F.lit(None).cast("string").alias("column"), F.lit("singular").alias("test"),
            "failures"))
    if known:
        parts.append(spark.createDataFrame(known, "model string, column string, test string, failures long"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose non-NULL key has no parent (left anti join)."""
    pk = parent_key or key
    parent_keys = parent.select(F.col(pk).alias("__pk")).where(F.col("__pk").isNotNull())
    return child.where(F.col(key).isNotNull()).join(parent_keys, F.col(key) == F.col("__pk"), "left_anti")


# --------------------------------------------------------------------------- freshness and volume

def source_freshness(sources: dict[str, DataFrame], now, loaded_at: str = "_loaded_at",
                     thresholds: dict[str, tuple[int, int]] = FRESHNESS_HOURS) -> DataFrame:
    """pass / warn / error on the age of max(loaded_at) at ``now`` (one aggregate per source)."""
    if isinstance(now, str):
        now = dt.datetime.fromisoformat(now)
    now_col = F.lit(now).cast(TS)
    parts = []
    for name, df in sources.items():
        warn, err = thresholds[name]
        age = (F.unix_micros(now_col.cast("timestamp")) - F.unix_micros(F.col("max_loaded_at").cast("timestamp"))) / 3.6e9
        parts.append(df.agg(F.max(loaded_at).cast(TS).alias("max_loaded_at")).select(
            F.lit(name).alias("source"), "max_loaded_at", age.alias("age_hours"),
            F.lit(warn).alias("warn_after_hours"), F.lit(err).alias("error_after_hours")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn(
        "status",
        F.when(F.col("max_loaded_at").isNull(), "error")
        .when(F.col("age_hours") > F.col("error_after_hours"), "error")
        .when(F.col("age_hours") > F.col("warn_after_hours"), "warn")
        .otherwise("pass"),
    )


def volume_anomalies(df: DataFrame, date_col: str = "invoice_date", by: Sequence[str] = ("source_system",),
                     lookback_days: int = 90, sigmas: float = 3.0) -> DataFrame:
    """Daily row counts against the mean and sample stddev of the previous ``lookback_days`` days.

    Days without rows count as zero (a calendar per series is generated from
    its min and max date).  The window runs over the daily series -- one row
    per day per series, bounded by the calendar, not by the data volume.
    """
    keys = list(by)
    daily = df.where(F.col(date_col).isNotNull()).groupBy(*keys, F.col(date_col).alias("day")).agg(
        F.count(F.lit(1)).alias("row_count"))
    calendar = daily.groupBy(*keys).agg(F.min("day").alias("lo"), F.max("day").alias("hi")).select(
        *keys, F.explode(F.sequence("lo", "hi")).alias("day"))
    series = calendar.join(daily, [*keys, "day"], "left").withColumn(
        "row_count", F.coalesce(F.col("row_count"), F.lit(0)).cast("bigint"))
    w = Window.partitionBy(*keys).orderBy("day").rowsBetween(-lookback_days, -1)
    mean, std = F.avg("row_count").over(w), F.stddev_samp("row_count").over(w)
    out = series.select(*keys, F.col("day").alias(date_col), "row_count",
                        mean.alias("rolling_mean"), std.alias("rolling_stddev"))
    return out.withColumn(
        "is_anomaly",
        F.coalesce(F.abs(F.col("row_count") - F.col("rolling_mean")) > sigmas * F.col("rolling_stddev"), F.lit(False)),
    )


def currency_report(frames: dict[str, DataFrame], iso_codes: DataFrame | None = None,
                    column: str = "currency") -> DataFrame:
    """Per table and currency value: rows, ISO-like form, and (given a code table) membership.

    ``iso_codes`` is a one-column table of valid codes supplied by the caller;
    it is joined, not collected, so its size does not matter.
    """
    parts = [df.groupBy(F.col(column).alias("currency")).agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "currency", "row_count") for name, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = out.withColumn("iso_like", F.coalesce(F.col("currency").rlike(CURRENCY_PATTERN), F.lit(False)))
    if iso_codes is not None:
        codes = iso_codes.select(F.col(iso_codes.columns[0]).alias("__code")).distinct()
        out = out.join(codes, F.col("currency") == F.col("__code"), "left") \
            .withColumn("in_code_list", F.col("__code").isNotNull()).drop("__code")
    return out
