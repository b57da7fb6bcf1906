"""Sinks: full refresh, positional append, idempotent period replace."""

import datetime as dt

from testdata import SF_SMALL

from zerobill.plans.job import AlarmPlan, run_month
from zerobill.plans.registry import plan_for
from zerobill.run import FIXTURE_RUN
from zerobill.schemas import ALARM_COLUMNS
from zerobill.session import scratch_path
from zerobill.sources import sinks
from zerobill.sources.fixture import fixture_sources


def _bag(df):
    return sorted(tuple(map(repr, r)) for r in df.collect())


def test_scratch_path_is_below_checkpoint_dir(spark):
    base = spark.sparkContext.getCheckpointDir()
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(base.rstrip("/"))


def test_overwrite_twice_is_a_full_refresh(spark):
    zero = plan_for(spark, SF_SMALL).zero_invoices
    path = scratch_path(spark, "zero")
    sinks.write_table(zero, path)
    sinks.write_table(zero, path)
    back = spark.read.orc(path)
    assert back.columns == zero.columns
    assert _bag(back) == _bag(zero)


def test_orc_files_are_snappy(spark):
    import glob

    zero = plan_for(spark, SF_SMALL).zero_invoices
    path = scratch_path(spark, "zero")
    sinks.write_table(zero, path)
    local = path.replace("file:", "")
    assert glob.glob(f"{local}/*.snappy.orc")


def test_append_is_positional_and_not_idempotent(spark):
    alarms = plan_for(spark, SF_SMALL).all_alarms(with_timestamp=True)
    assert alarms.columns == ALARM_COLUMNS
    path = scratch_path(spark, "alarm")
    sinks.append_alarms(alarms, path)
    once = sinks.read_alarms(spark, path)
    assert once.columns == ALARM_COLUMNS and _bag(once) == _bag(alarms)
    sinks.append_alarms(alarms, path)
    assert sinks.read_alarms(spark, path).count() == 2 * alarms.count()
    ts = {r["data_alarme"] for r in once.select("data_alarme").collect()}
    assert ts == {dt.datetime(2001, 8, 15)}


def test_replace_period_is_idempotent(spark):
    alarms = plan_for(spark, SF_SMALL).all_alarms(with_timestamp=True)
    path = scratch_path(spark, "alarm")
    sinks.replace_period(alarms, path)
    sinks.replace_period(alarms, path)
    back = sinks.read_alarms(spark, path)
    assert back.columns == ALARM_COLUMNS
    assert _bag(back) == _bag(alarms)


import pytest


def test_run_month_writes_kept_table_and_alarms(spark):
    sources = fixture_sources(spark, SF_SMALL)
    kept = scratch_path(spark, "kept")
    target = scratch_path(spark, "alarm")
    run_month(spark, sources, FIXTURE_RUN, kept, target)
    plan = AlarmPlan(sources, FIXTURE_RUN)
    assert _bag(spark.read.orc(kept)) == _bag(plan.zero_invoices)
    assert _bag(sinks.read_alarms(spark, target)) == _bag(plan.all_alarms(with_timestamp=True))


def test_zero_keys_cut_tax_and_customer_without_hints(spark):
    import contextlib
    import io

    from zerobill.plans.job import enrich_zero_billing

    sources = fixture_sources(spark, SF_SMALL)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        enrich_zero_billing(sources, AlarmPlan(sources, FIXTURE_RUN).zero_billing).explain(True)
    assert "LeftSemi" in buf.getvalue() and "ResolvedHint" not in buf.getvalue()


def test_run_month_leaves_no_staging(spark):
    import glob

    root = scratch_path(spark, "x").rsplit("/", 1)[0].removeprefix("file:")
    before = set(glob.glob(f"{root}/zero_billing-*"))
    sources = fixture_sources(spark, SF_SMALL)
    run_month(spark, sources, FIXTURE_RUN, scratch_path(spark, "kept"), scratch_path(spark, "alarm"))
    with pytest.raises(Exception):
        run_month(spark, sources, FIXTURE_RUN, "nosuchfs://x/kept", scratch_path(spark, "alarm"))
    assert set(glob.glob(f"{root}/zero_billing-*")) == before
    with pytest.raises(ValueError):
        run_month(spark, sources, FIXTURE_RUN, "k", "t", alarm_format=None, idempotent=True)


def test_replace_period_clears_an_empty_month(spark):
    alarms = AlarmPlan(fixture_sources(spark, SF_SMALL), FIXTURE_RUN).all_alarms(with_timestamp=True)
    path = scratch_path(spark, "alarm")
    sinks.replace_period(alarms, path, period=FIXTURE_RUN.period)
    assert sinks.read_alarms(spark, path).count() > 0
    sinks.replace_period(alarms.limit(0), path, period=FIXTURE_RUN.period)
    assert sinks.read_alarms(spark, path).count() == 0


def test_command_line_run(spark):
    from zerobill import schemas
    from zerobill.__main__ import main

    src = fixture_sources(spark, SF_SMALL)
    base = scratch_path(spark, "cli")
    args = ["--run-date", "2001-08-15", "--input-format", "parquet"]
    for name in schemas.SOURCES:
        getattr(src, name).write.parquet(f"{base}/{name}")
        args += [f"--{name.replace('_', '-')}", f"{base}/{name}"]
    args += ["--zero-invoice-path", f"{base}/zero", "--alarm-table", f"{base}/alarms",
             "--alarm-format", "orc", "--replace-period"]
    main(args)
    main(args)  # idempotent per period
    plan = AlarmPlan(src, FIXTURE_RUN)
    got = sinks.read_alarms(spark, f"{base}/alarms").drop("data_alarme")
    assert _bag(got) == _bag(plan.all_alarms())
    assert _bag(spark.read.orc(f"{base}/zero")) == _bag(plan.zero_invoices)


def test_replace_period_keeps_other_periods(spark):
    import datetime as dt

    from zerobill.run import RunContext

    sources = fixture_sources(spark, SF_SMALL)
    july = AlarmPlan(sources, FIXTURE_RUN).all_alarms(with_timestamp=True)
    june_ctx = RunContext(dt.date(2001, 7, 15), dt.datetime(2001, 7, 15))
    june = AlarmPlan(sources, june_ctx).all_alarms(with_timestamp=True)
    path = scratch_path(spark, "alarm")
    sinks.replace_period(july, path)
    sinks.replace_period(june, path)
    sinks.replace_period(july, path)            # re-run July: replaces July only
    back = sinks.read_alarms(spark, path)
    assert sorted(r[0] for r in back.select("periodo").distinct().collect()) == ["200106", "200107"]
    assert _bag(back) == sorted(_bag(july) + _bag(june))
