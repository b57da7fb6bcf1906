"""Row counts of FIXTURES.md section 3 (adapter and every stage)."""

import pytest
from pyspark.sql import functions as F
from testdata import SF_ORACLE, SF_SMALL

from zerobill.operators import alarm as A
from zerobill.plans.registry import plan_for

EXPECTED = {
    SF_SMALL: dict(customer=159, billing_line=6000, tax_line_1=3068, tax_line_2=2932,
                   q01=159, q02=82, q05=1538, q06=101, q07=107, q08=15, zero_before_fan_out=14,
                   q10=14, q14=10, q15=5),
    SF_ORACLE: dict(customer=1589, billing_line=60000, tax_line_1=29833, tax_line_2=30167,
                    q01=1589, q02=906, q05=15788, q06=1201, q07=1266, q08=175,
                    zero_before_fan_out=131, q10=135, q14=22, q15=5),
}


@pytest.mark.parametrize("sf_dir", [SF_SMALL, SF_ORACLE])
def test_stage_counts(spark, sf_dir):
    exp = EXPECTED[sf_dir]
    plan = plan_for(spark, sf_dir)
    s = plan.sources
    got = dict(
        customer=s.customer.count(),
        billing_line=s.billing_line.count(),
        tax_line_1=s.tax_line_1.count(),
        tax_line_2=s.tax_line_2.count(),
        q01=plan.customer_segments.count(),
        q02=plan.monthly_billing.count(),
        q05=plan.invoice_tax.count(),
        q06=plan.billing_with_tax.count(),
        q07=plan.enriched_invoices.count(),
        q08=plan.zero_invoices.count(),
        zero_before_fan_out=plan.monthly_billing.filter("sum_amount = 0").count(),
        q10=plan.zero_counter.count(),
        q14=plan.grain_alarms(A.GRAIN_STATE).count(),
        q15=plan.grain_alarms(A.GRAIN_PERIOD).count(),
    )
    assert got == exp


def test_flag_coverage_sf001(spark):
    """All four outcomes occur at sf0.01 (FIXTURES.md flag table)."""
    plan = plan_for(spark, SF_ORACLE)
    expected = {
        A.GRAIN_STATE: {("n", "Normal", False): 7, ("n", "Normal", True): 1,
                        ("s", "Normal", True): 6, ("s", "Ultrapassou Limite Superior", True): 8},
        A.GRAIN_PERIOD: {("n", "Normal", True): 1, ("s", "Normal", True): 2,
                         ("s", "Ultrapassou Limite Superior", True): 2},
    }
    for grain, exp in expected.items():
        got = {}
        for r in plan.grain_alarms(grain).collect():
            key = (r["flag_alarme"], r["alarme"], r["cod"] is not None)
            got[key] = got.get(key, 0) + 1
        assert got == exp


@pytest.mark.parametrize("sf_dir", [SF_SMALL, SF_ORACLE])
def test_every_row_of_the_test_tables_enters(spark, sf_dir):
    def rows(name):
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    s = plan_for(spark, sf_dir).sources
    accounts = s.customer.select("account_no").distinct()
    assert accounts.count() == rows("customer").select("c_custkey").distinct().count()
    joined = rows("lineitem").join(rows("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    assert s.billing_line.count() == joined.count()
    assert s.tax_line_1.count() + s.tax_line_2.count() == rows("lineitem").count()
    # the roles still occur
    billed = s.billing_line.select("bill_ref_no").distinct()
    assert s.tax_line_1.join(billed, "bill_ref_no", "left_anti").count() > 0
    assert s.billing_line.join(accounts, "account_no", "left_anti").count() > 0
