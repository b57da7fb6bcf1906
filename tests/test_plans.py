"""Physical-plan properties that matter at scale (checked with explain)."""

import contextlib
import io

import pytest
from testdata import SF_SMALL

import __spark_entry__ as E
from zerobill.plans.registry import QUERIES

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "PythonUDF", "MapInArrow")


def plan_text(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"q23_orc_roundtrip", "q24_alarm_append"}))
def test_no_python_in_any_plan(spark, name):
    text = plan_text(QUERIES[name](spark, SF_SMALL))
    assert not any(node in text for node in PYTHON_NODES)


def test_window_bounds_reach_the_scan(spark):
    text = plan_text(QUERIES["q02_monthly_billing"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(o_orderdate,2001-01-01T00:00)" in text
    assert "LessThan(o_orderdate,2001-08-01T00:00)" in text
    assert "In(l_linenumber, [2,3,6,7])" in text


def test_snapshot_is_a_scan_filter_not_a_join(spark):
    text = plan_text(QUERIES["q03_latest_snapshot"](spark, SF_SMALL))
    assert "Join" not in text.split("===== Subqueries =====")[0]
    assert "===== Subqueries =====" in text and "= Subquery subquery" in text


def test_billed_restriction_is_a_semi_join(spark):
    text = plan_text(QUERIES["q05_invoice_tax"](spark, SF_SMALL))
    assert "LeftSemi" in text


def test_alarm_path_skips_the_tax_tables(spark):
    # the counter reads no tax column, so no tax snapshot subquery is planned
    text = plan_text(QUERIES["q16_all_alarms"](spark, SF_SMALL))
    assert "Subquery" not in text
    assert "LeftSemi" not in text


def test_rules_are_broadcast_from_a_local_table(spark):
    text = plan_text(QUERIES["q16_all_alarms"](spark, SF_SMALL))
    assert "LocalTableScan" in text
    assert "BroadcastHashJoin LeftOuter BuildRight" in text


def test_counter_computed_once_for_both_grains(spark):
    df = E.entry(spark)
    df.collect()
    assert "ReusedExchange" in plan_text(df)


def test_kept_columns_only_are_read(spark):
    text = plan_text(QUERIES["q01_customer_segments"](spark, SF_SMALL))
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int>" in text


def test_bucketed_billing_rolls_up_without_shuffle(spark):
    from zerobill import schemas
    from zerobill.operators import rollup as R
    from zerobill.run import FIXTURE_RUN
    from zerobill.session import scratch_path
    from zerobill.sources import sinks
    from zerobill.sources.catalog import conform
    from zerobill.sources.fixture import fixture_sources

    billing = fixture_sources(spark, SF_SMALL).billing_line
    sinks.save_bucketed(billing, "billing_bucketed_test", "bill_ref_no", 4,
                        path=scratch_path(spark, "billing_bucketed"))
    try:
        table = conform(spark.table("billing_bucketed_test"), schemas.BILLING_LINE)
        rolled = R.monthly_billing(table, FIXTURE_RUN)
        text = plan_text(rolled)
        assert "Exchange" not in text.split("===== Subqueries =====")[0]
        expected = R.monthly_billing(billing, FIXTURE_RUN)
        assert sorted(map(repr, rolled.collect())) == sorted(map(repr, expected.collect()))
    finally:
        spark.sql("DROP TABLE IF EXISTS billing_bucketed_test")


def test_zero_filter_runs_before_the_enrichment_joins(spark):
    text = plan_text(QUERIES["q08_zero_invoices"](spark, SF_SMALL), "simple")
    lines = text.splitlines()
    zero = next(i for i, l in enumerate(lines) if "(sum_amount" in l and "= 0.00" in l and "Filter" in l)
    joins = [i for i, l in enumerate(lines) if "LeftOuter" in l]
    assert len(joins) == 2 and all(i < zero for i in joins)   # filter sits below both joins


def test_hot_account_join_partition_is_split(spark):
    """One account holding most zero invoices: AQE splits its join partition."""
    from frames import billing_row, sources

    from zerobill.plans.job import AlarmPlan
    from zerobill.run import FIXTURE_RUN

    billing = [billing_row("200107", b, 1, 0) for b in range(1, 3000)]
    billing += [billing_row("200106", 5000 + a, a, 0) for a in range(2, 10)]
    customers = [(a, "SP", "12") for a in range(1, 10)]
    plan = AlarmPlan(sources(spark, customers=customers, billing=billing), FIXTURE_RUN)
    expected = sorted(map(repr, plan.zero_invoices.collect()))
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = AlarmPlan(plan.sources, FIXTURE_RUN).zero_invoices
        got = sorted(map(repr, df.collect()))
        text = plan_text(df, "simple")
    finally:
        for k in conf:
            spark.conf.unset(k)
    assert "SortMergeJoin(skew=true)" in text
    assert got == expected
