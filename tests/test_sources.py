"""Typed ingest (conform / read_sources) and the catalog insert path."""

import pytest
from pyspark.sql import functions as F

from zerobill import schemas
from zerobill.plans.job import AlarmPlan
from zerobill.plans.registry import plan_for
from zerobill.run import FIXTURE_RUN
from zerobill.schemas import ALARM_COLUMNS
from zerobill.session import scratch_path
from zerobill.sources import sinks
from zerobill.sources.catalog import SchemaError, conform, read_sources
from testdata import SF_SMALL


def test_conform_casts_and_orders_columns(spark):
    df = spark.createDataFrame([("7", 12, "SP", 99)], "ACCOUNT_NO string, account_category int, cust_state string, extra int")
    out = conform(df, schemas.CUSTOMER, "customer")
    assert out.columns == ["account_no", "cust_state", "account_category"]
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in schemas.CUSTOMER.fields]
    row = out.first()
    assert (row.account_no, row.cust_state, row.account_category) == (7, "SP", "12")


def test_conform_rejects_missing_columns(spark):
    df = spark.createDataFrame([(1,)], "account_no long")
    with pytest.raises(SchemaError):
        conform(df, schemas.CUSTOMER, "customer")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_conform_rejects_bad_values_instead_of_nulling(spark, ansi):
    df = spark.createDataFrame([("x1", "SP", "12")], "account_no string, cust_state string, account_category string")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="customer.account_no"):
            conform(df, schemas.CUSTOMER, "customer").collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_read_sources_from_files_round_trip(spark):
    src = plan_for(spark, SF_SMALL).sources
    base = scratch_path(spark, "sources")
    locations = {}
    for name in schemas.SOURCES:
        path = f"{base}/{name}"
        getattr(src, name).write.parquet(path)
        locations[name] = path
    read = read_sources(spark, locations, fmt="parquet")
    a = AlarmPlan(read, FIXTURE_RUN).all_alarms()
    b = AlarmPlan(src, FIXTURE_RUN).all_alarms()
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def test_positional_insert_into_catalog_table(spark):
    location = scratch_path(spark, "alarm_table")
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.ALARM_SCHEMA.fields)
    spark.sql(f"CREATE TABLE alarm_final_test ({ddl}) USING orc LOCATION '{location}'")
    try:
        alarms = plan_for(spark, SF_SMALL).all_alarms(with_timestamp=True)
        # rename every column: the insert must go by position, not by name
        renamed = alarms.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(alarms.columns)])
        sinks.append_alarms(renamed, "alarm_final_test", fmt=None)
        back = spark.table("alarm_final_test")
        assert back.columns == ALARM_COLUMNS
        assert sorted(map(repr, back.collect())) == sorted(map(repr, alarms.collect()))
    finally:
        spark.sql("DROP TABLE IF EXISTS alarm_final_test")


def test_default_format_full_refresh(spark):
    zero = plan_for(spark, SF_SMALL).zero_invoices
    path = scratch_path(spark, "zero_default")
    sinks.write_table(zero, path, fmt="parquet", compression=None)
    sinks.write_table(zero, path, fmt="parquet", compression=None)
    assert spark.read.parquet(path).count() == zero.count()


def test_create_as_select_catalog_table_default_format(spark):
    zero = plan_for(spark, SF_SMALL).zero_invoices
    try:
        for _ in range(2):   # drop-and-create semantics: the second run replaces the first
            sinks.save_as_table(zero, "zero_invoice_test", path=scratch_path(spark, "zero_tbl"))
        back = spark.table("zero_invoice_test")
        assert back.columns == zero.columns
        assert sorted(map(repr, back.collect())) == sorted(map(repr, zero.collect()))
        provider = [r for r in spark.sql("DESCRIBE TABLE EXTENDED zero_invoice_test").collect()
                    if r[0] == "Provider"][0][1]
        assert provider == spark.conf.get("spark.sql.sources.default")
    finally:
        spark.sql("DROP TABLE IF EXISTS zero_invoice_test")


def test_conform_keeps_stored_timestamps_and_widens_safely(spark):
    import datetime as dt
    from decimal import Decimal

    df = spark.createDataFrame(
        [(dt.datetime(2001, 7, 3, 10), 5, 6, Decimal("1.50"), Decimal("0.1000"), Decimal("0"), 2, 1, 0, None)],
        "prep_date timestamp, bill_ref_no int, account_no int, amount decimal(10,2), "
        "tax decimal(12,4), discount decimal(5,0), type_code int, prep_status int, "
        "backout_status int, prep_error_code long",
    )
    out = conform(df, schemas.BILLING_LINE, "billing_line")
    types = {f.name: f.dataType.simpleString() for f in out.schema.fields}
    assert types["prep_date"] == "timestamp"           # stored type kept
    assert types["bill_ref_no"] == "bigint" and types["amount"] == "decimal(18,2)"
    # codes and statuses are compared as stored
    assert types["prep_status"] == "int" and types["prep_error_code"] == "bigint"
    row = out.first()
    assert row.prep_status == 1 and row.amount == Decimal("1.50")
    from zerobill.operators import rollup as R
    from zerobill.run import FIXTURE_RUN
    assert R.monthly_billing(out, FIXTURE_RUN).count() == 1
