"""Catalog tables: create, refresh by swapping, positional insert; scratch that does not outlive its use."""

import datetime as dt
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F
from testdata import SF_SMALL

import __spark_entry__ as E
from zerobill.plans.job import AlarmPlan, run_month
from zerobill.plans.registry import plan_for
from zerobill.run import FIXTURE_RUN
from zerobill.session import drop_scratch, path_exists, scratch_path, scratch_scope
from zerobill.sources import sinks
from zerobill.sources.fixture import fixture_sources

ROOT = os.path.dirname(os.path.abspath(E.__file__))


def bag(df):
    return sorted(tuple(map(repr, r)) for r in df.collect())


def failing(spark):
    """A frame whose last rows raise an error when they are written."""
    return spark.range(100).select(F.when(F.col("id") < 99, F.col("id")).otherwise(F.raise_error(F.lit("broken row")).cast("bigint")).alias("id"))


@pytest.fixture
def table(spark):
    name = "swap_test"
    yield name
    for t in spark.catalog.listTables():
        if t.name.startswith(name):
            spark.sql(f"DROP TABLE {t.name}")


@pytest.mark.parametrize("external", [False, True])
def test_refresh_replaces_rows_and_layout(spark, table, external):
    place = scratch_path(spark, "kept") if external else None
    sinks.refresh_table(spark.range(5), table, location=place)
    sinks.refresh_table(spark.range(7).select(F.lit("x").alias("a"), "id"), table, location=place)
    assert spark.table(table).columns == ["a", "id"] and spark.table(table).count() == 7
    assert sinks.table_provider(spark, table) == "orc"
    properties = sinks.table_properties(spark, table)
    assert (properties["orc.compress"], properties["transactional"]) == ("SNAPPY", "false")
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith(table)] == [table]
    if external:
        kept = os.listdir(place.removeprefix("file:"))
        assert len(kept) == 1  # the first refresh's folder is gone


@pytest.mark.parametrize("external", [False, True])
def test_failed_refresh_keeps_the_last_table(spark, table, external):
    place = scratch_path(spark, "kept") if external else None
    sinks.refresh_table(spark.range(5), table, location=place)
    with pytest.raises(Exception, match="broken row"):
        sinks.refresh_table(failing(spark), table, location=place)
    assert sorted(r[0] for r in spark.table(table).collect()) == [0, 1, 2, 3, 4]
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith(table)] == [table]
    if external:
        assert len(os.listdir(place.removeprefix("file:"))) == 1


def test_failed_refresh_keeps_the_last_folder(spark):
    path = scratch_path(spark, "folder")
    sinks.write_table(spark.range(5), path)
    with pytest.raises(Exception, match="broken row"):
        sinks.write_table(failing(spark), path)
    assert sorted(r[0] for r in spark.read.orc(path).collect()) == [0, 1, 2, 3, 4]
    here, name = os.path.split(path.removeprefix("file:"))
    assert [n for n in os.listdir(here) if n.startswith(name)] == [name]


def test_failed_month_keeps_the_kept_table(spark):
    sources, kept, alarms = fixture_sources(spark, SF_SMALL), scratch_path(spark, "kept"), scratch_path(spark, "alarms")
    run_month(spark, sources, FIXTURE_RUN, kept, alarms)
    before = bag(spark.read.orc(kept))
    broken = sources.customer.withColumn("cust_state", F.raise_error(F.lit("broken row")).cast("string"))
    with pytest.raises(Exception, match="broken row"):
        run_month(spark, type(sources)(broken, sources.billing_line, sources.tax_line_1, sources.tax_line_2, sources.alarm_factor), FIXTURE_RUN, kept, alarms)
    assert bag(spark.read.orc(kept)) == before


def test_default_source_decides_the_format(spark, table):
    before = spark.conf.get("spark.sql.sources.default")
    try:
        for fmt in ("json", "orc"):
            spark.conf.set("spark.sql.sources.default", fmt)
            sinks.save_as_table(spark.range(3), table)
            assert sinks.table_provider(spark, table) == fmt and spark.table(table).count() == 3
    finally:
        spark.conf.set("spark.sql.sources.default", before)


def test_insert_goes_by_position_and_fails_on_what_does_not_fit(spark, table):
    spark.sql(f"CREATE TABLE {table} (a INT, b STRING) USING orc")
    sinks.append_alarms(spark.sql("SELECT 5L AS b, 'x' AS a"), table, fmt=None)
    sinks.append_alarms(spark.sql("SELECT 6L AS q, 'y' AS p"), table, fmt=None)
    assert sorted(map(tuple, spark.table(table).collect())) == [(5, "x"), (6, "y")]
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        sinks.append_alarms(spark.sql("SELECT 3000000000L AS q, 'y' AS p"), table, fmt=None)
    with pytest.raises(ValueError, match="2 columns"):
        sinks.append_alarms(spark.range(1), table, fmt=None)
    assert spark.table(table).count() == 2


def test_run_month_needs_a_kept_table(spark):
    with pytest.raises(ValueError, match="kept table"):
        run_month(spark, fixture_sources(spark, SF_SMALL), FIXTURE_RUN, None, "t")


def test_run_month_into_catalog_tables(spark, table):
    sources = fixture_sources(spark, SF_SMALL)
    plan = AlarmPlan(sources, FIXTURE_RUN)
    for _ in range(2):
        run_month(spark, sources, FIXTURE_RUN, None, scratch_path(spark, "alarms"), zero_invoice_table=table)
    assert bag(spark.table(table)) == bag(plan.zero_invoices)


def test_command_line_with_tables(spark, table):
    from zerobill import schemas
    from zerobill.__main__ import main

    src, args = fixture_sources(spark, SF_SMALL), ["--run-date", "2001-08-15"]
    for name in schemas.SOURCES:
        sinks.refresh_table(getattr(src, name), f"{table}_{name}", fmt="parquet")
        args += [f"--{name.replace('_', '-')}", f"{table}_{name}"]
    alarms = AlarmPlan(src, FIXTURE_RUN).all_alarms(with_timestamp=True)
    sinks.create_table(alarms.limit(0), f"{table}_alarms")
    main([*args, "--zero-invoice-table", table, "--alarm-table", f"{table}_alarms"])
    assert bag(spark.table(f"{table}_alarms").drop("data_alarme")) == bag(alarms.drop("data_alarme"))
    assert bag(spark.table(table)) == bag(plan_for(spark, SF_SMALL).zero_invoices)
    with pytest.raises(SystemExit):
        main([*args, "--alarm-table", f"{table}_alarms"])


def test_scratch_scope_drops_what_it_staged(spark):
    outside = scratch_path(spark, "outside")
    with pytest.raises(RuntimeError):
        with scratch_scope(spark) as folder:
            inside = scratch_path(spark, "inside")
            spark.range(3).write.parquet(inside)
            assert inside.startswith(folder)
            raise RuntimeError
    assert not path_exists(spark, folder)
    spark.range(3).write.parquet(outside)
    assert not scratch_path(spark, "x").startswith(folder)
    drop_scratch(spark)
    assert not path_exists(spark, outside)
    spark.range(3).write.parquet(scratch_path(spark, "again"))


@pytest.mark.parametrize("crash", [False, True])
def test_a_session_leaves_no_scratch(tmp_path, crash):
    """q23 and q24 stage and read back; after the driver has ended, also by an error, nothing is left."""
    code = f"""
import sys
sys.path.insert(0, {ROOT!r})
from zerobill.session import build_session
import __spark_entry__ as E
spark = build_session("local[2]", shuffle_partitions=2, extra={{"spark.checkpoint.dir": {str(tmp_path / "shared")!r}}})
for name in ("q23_orc_roundtrip", "q24_alarm_append"):
    assert E.queries()[name](spark, {SF_SMALL!r}).count() > 0
import os
print(len(os.listdir({str(tmp_path / "shared")!r})))
{"raise RuntimeError" if crash else ""}
"""
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path)
    assert (run.returncode != 0) == crash, run.stderr
    assert int(run.stdout) > 0
    left = [os.path.join(d, f) for d, _, files in os.walk(tmp_path / "shared") for f in files]
    assert left == []


def test_read_alarms_keep_the_run_timestamp(spark):
    got = E.queries()["q28_run_month_alarms"](spark, SF_SMALL)
    assert {r[0] for r in got.select("data_alarme").collect()} == {dt.datetime(2001, 8, 15)}
