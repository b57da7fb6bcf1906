"""Ingest keeps values: what a logical type cannot hold exactly fails or stays as stored."""

import contextlib
import datetime as dt
import io
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from testdata import SF_ORACLE, SF_SMALL

from zerobill import schemas
from zerobill.operators import rollup as R
from zerobill.plans.job import AlarmPlan
from zerobill.plans.registry import QUERIES, plan_for
from zerobill.run import FIXTURE_RUN
from zerobill.sources.catalog import conform, conform_sources, key_types

D = Decimal
BILLING = {
    "prep_date": ("timestamp_ntz", dt.datetime(2001, 7, 3, 10)), "bill_ref_no": ("bigint", 5), "account_no": ("bigint", 6),
    "amount": ("decimal(18,2)", D("1.00")), "tax": ("decimal(23,4)", D("0.1")), "discount": ("decimal(23,4)", D("0")), "type_code": ("int", 2),
    "prep_status": ("string", "1"), "backout_status": ("string", "0"), "prep_error_code": ("int", None),
}


def billing(spark, *rows, **columns):
    """Billing lines that differ from a plain one in the given columns: name=(type, value of each row)."""
    layout = {**BILLING, **{c: (kind, None) for c, (kind, *_) in columns.items()}}
    values = [tuple(columns[c][1][i] if c in columns else v for c, (_, v) in layout.items()) for i in range(len(next(iter(columns.values()))[1]))]
    return spark.createDataFrame(values, ", ".join(f"{c} {kind}" for c, (kind, _) in layout.items()))


def plan_text(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize(
    "column,kind,good,bad",
    [
        ("amount", "double", 1.25, 0.004), ("amount", "string", "-7.50", "0.004"), ("amount", "string", "0.00", "0.0000000000000000000001"),
        ("amount", "float", 0.5, float("nan")), ("amount", "string", "3", "abc"), ("type_code", "string", "2", "2.7"),
        ("type_code", "double", 2.0, 2.7), ("bill_ref_no", "string", "12", "0012"), ("bill_ref_no", "decimal(20,1)", D("12.0"), D("12.5")),
        ("account_no", "string", "7", "99999999999999999999"), ("account_no", "double", 3.0, 1e19),
    ],
)
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_inexact_values_fail(spark, column, kind, good, bad, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        kept = conform(billing(spark, **{column: (kind, [good, None])}), schemas.BILLING_LINE, "billing_line")
        first, second = (r[column] for r in kept.orderBy(F.col(column).isNull()).collect())
        assert float(first) == float(good) and second is None
        with pytest.raises(Exception, match=f"billing_line.{column}: not exactly"):
            conform(billing(spark, **{column: (kind, [good, bad])}), schemas.BILLING_LINE, "billing_line").collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_four_decimals_are_no_false_zero(spark):
    stored = billing(spark, bill_ref_no=("bigint", [1, 2, 2, 3, 4, 4, 5]), amount=("decimal(20,4)", [D("0.0040"), D("10.0000"), D("-10.0000"), None, D("0.0040"), D("-0.0040"), D("0.0001")]))
    rolled = R.monthly_billing(conform(stored, schemas.BILLING_LINE), FIXTURE_RUN)
    assert {r["bill_ref_no"] for r in rolled.filter("sum_amount = 0").collect()} == {2, 4}
    assert {r["bill_ref_no"]: r["sum_amount"] for r in rolled.collect()}[1] == D("0.0040")


def test_decimal_codes_are_compared_as_stored(spark):
    stored = billing(spark, bill_ref_no=("bigint", [1, 2, 3]), type_code=("decimal(4,1)", [D("2.0"), D("2.7"), D("7.0")]))
    rolled = R.monthly_billing(conform(stored, schemas.BILLING_LINE), FIXTURE_RUN)
    assert {r["bill_ref_no"] for r in rolled.collect()} == {1, 3}


def test_text_keys_stay_apart_when_all_inputs_store_text(spark):
    src = plan_for(spark, SF_SMALL).sources
    frames = {n: getattr(src, n) for n in schemas.SOURCES}
    padded = lambda df: df.withColumn("bill_ref_no", F.lpad(F.col("bill_ref_no").cast("string"), 20, "0"))
    text = {n: padded(f) if "bill_ref_no" in f.columns else f for n, f in frames.items()}
    assert {k: t.simpleString() for k, t in key_types(text).items()} == {"bill_ref_no": "string"}
    got = AlarmPlan(conform_sources(text), FIXTURE_RUN).zero_invoices
    want = AlarmPlan(src, FIXTURE_RUN).zero_invoices
    assert sorted(map(repr, got.withColumn("bill_ref_no", F.col("bill_ref_no").cast("bigint")).collect())) == sorted(map(repr, want.collect()))
    # one input alone stores text: leading zeros would be lost, so it fails
    mixed = frames | {"billing_line": padded(frames["billing_line"])}
    assert key_types(mixed) == {}
    with pytest.raises(Exception, match="billing_line.bill_ref_no: not exactly"):
        AlarmPlan(conform_sources(mixed), FIXTURE_RUN).zero_invoices.collect()


def test_stored_layout_query_holds_every_trap(spark):
    rows = QUERIES["q30_stored_layout_billing"](spark, SF_ORACLE).collect()
    kinds = {r["is_zero"] for r in rows}
    assert kinds == {True, False, None}
    assert any(r["sum_amount"] is not None and r["sum_amount"] != 0 and round(r["sum_amount"], 2) == 0 for r in rows)
    keys = {r["bill_ref_no"] for r in rows}
    assert any(k.startswith("0") and k.lstrip("0") in keys for k in keys)


def text_dates(spark, *days):
    return billing(spark, bill_ref_no=("bigint", list(range(len(days)))), prep_date=("string", list(days)))


def test_text_dates_in_any_usual_form(spark):
    days = ["2001-01-01", "2001-1-5 10:00:00", "2001-07-31 23:59:59.999", "2001-08-01", "2000-12-31 23:59:59", "2001-07", None]
    for frame in (text_dates(spark, *days),):
        rolled = R.monthly_billing(conform(frame, schemas.BILLING_LINE), FIXTURE_RUN)
        assert {r["bill_ref_no"]: r["prep_date"] for r in rolled.collect()} == {0: "200101", 1: "200101", 2: "200107", 5: "200107"}
    with pytest.raises(Exception, match="prep_date: not a date: 2001-13-45"):
        R.monthly_billing(conform(text_dates(spark, "2001-13-45"), schemas.BILLING_LINE), FIXTURE_RUN).collect()


def test_window_over_two_years_of_text_dates(spark):
    from zerobill.run import RunContext

    ctx = RunContext(dt.date(2002, 1, 31))  # June to December 2001
    days = ["2001-05-31", "2001-06-01", "2001-12-31", "2002-01-01"]
    assert {r["bill_ref_no"] for r in R.monthly_billing(text_dates(spark, *days), ctx).collect()} == {1, 2}
    ctx = RunContext(dt.date(2002, 3, 1))  # August 2001 to February 2002
    assert {r["bill_ref_no"] for r in R.monthly_billing(text_dates(spark, *days), ctx).collect()} == {2, 3}


@pytest.mark.parametrize("code", ["bigint", "decimal(10,0)", "smallint"])
def test_predicates_reach_the_scan_in_the_stored_type(spark, tmp_path, code):
    stored = plan_for(spark, SF_SMALL).sources.billing_line
    stored = stored.withColumns({
        "prep_date": F.date_format("prep_date", "yyyy-MM-dd HH:mm:ss"), "type_code": F.col("type_code").cast(code),
        "prep_status": F.col("prep_status").cast("int"), "prep_error_code": F.col("prep_error_code").cast("bigint"),
    })
    stored.write.parquet(f"{tmp_path}/billing")
    read = conform(spark.read.parquet(f"{tmp_path}/billing"), schemas.BILLING_LINE)
    text = plan_text(R.monthly_billing(read, FIXTURE_RUN))
    pushed = next(line for line in text.splitlines() if "PushedFilters" in line)
    for part in ("GreaterThanOrEqual(prep_date,2001)", "LessThan(prep_date,2002)", "In(type_code, [2,3,6,7])", "EqualTo(prep_status,1)"):
        assert part in pushed
    assert "Or(IsNull(prep_error_code),EqualTo(prep_error_code,0))" in pushed
    want = R.monthly_billing(plan_for(spark, SF_SMALL).sources.billing_line, FIXTURE_RUN)
    assert sorted(map(repr, R.monthly_billing(read, FIXTURE_RUN).collect())) == sorted(map(repr, want.collect()))


def test_text_snapshot_day_and_bigint_tax_type(spark, tmp_path):
    lines = plan_for(spark, SF_SMALL).sources.tax_line_1
    lines.withColumns({"dt_foto": F.col("dt_foto").cast("string"), "tax_type_code": F.col("tax_type_code").cast("bigint")}).write.parquet(f"{tmp_path}/tax")
    read = conform(spark.read.parquet(f"{tmp_path}/tax"), schemas.TAX_LINE)
    tax = R.invoice_tax({1: read}, None)
    assert "GreaterThanOrEqual(tax_type_code,1000000), LessThan(tax_type_code,4000000)" in plan_text(tax)
    assert sorted(map(repr, tax.collect())) == sorted(map(repr, R.invoice_tax({1: lines}, None).collect()))


def test_one_billed_key_list_for_both_systems(spark):
    """q05 joins once; in q04 the planner moves the join below the union and reuses the key list's exchange."""
    for name in ("q04_billed_tax_lines", "q05_invoice_tax"):
        df = QUERIES[name](spark, SF_SMALL)
        df.collect()
        final = plan_text(df).split("== Initial Plan ==")[0]
        joins = [line for line in final.splitlines() if "LeftSemi" in line and "Join" in line]
        assert len(joins) - final.count("ReusedExchange") == 1, final
