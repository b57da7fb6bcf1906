"""The monthly job as one lazy plan with named stages.

``AlarmPlan`` exposes every intermediate table of the job as a DataFrame
(nothing is computed until an action). ``run_month`` is the production entry
point. It first stores the zero invoice-months of the window (the only part
that needs the full billing scan) below the shared checkpoint folder and
semi-joins the tax snapshot and the customer table on the zero invoices' keys
before those are aggregated and shuffled; the planner chooses the joins from
the stored size. The staging is dropped once the kept table is written.
It then writes the kept zero-invoice table, reads it back (a second lineage
cut: the alarm stage never re-reads the raw sources) and appends the alarms.

Two stages are planned differently from their staging-table definitions
because the result provably does not change:

* the alarm counter is fed by zero invoices **without** the tax join: it
  reads no tax column and its ``max`` absorbs the rows the tax join
  duplicates, so the latest-snapshot tax scan is skipped;
* the tax stage used by the enrichment skips the whole-history billed-key
  restriction, because the left join from windowed billing only keeps
  billed invoices anyway.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace
from functools import cached_property
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zerobill.operators import alarm as A
from zerobill.operators import rollup as R
from zerobill.operators import zero as Z
from zerobill.run import RunContext
from zerobill.session import scratch_path, scratch_scope
from zerobill.sources import Sources
from zerobill.sources import sinks


class AlarmPlan:
    """Named stages of the job for one set of sources and one run date."""

    def __init__(self, sources: Sources, ctx: RunContext):
        self.sources = sources
        self.ctx = ctx

    # -- path 1: sources -> enriched invoices ---------------------------------
    @cached_property
    def customer_segments(self) -> DataFrame:
        return R.customer_segments(self.sources.customer)

    @cached_property
    def monthly_billing(self) -> DataFrame:
        return R.monthly_billing(self.sources.billing_line, self.ctx)

    def latest_tax_lines(self, system: int) -> DataFrame:
        return R.latest_snapshot(self.sources.tax_lines()[system])

    @cached_property
    def billed_tax_lines(self) -> DataFrame:
        """Both systems, tagged with ``system``, billed invoices only."""
        return R.billed_tax_lines(self.sources.tax_lines(), self.sources.billing_line)

    @cached_property
    def invoice_tax(self) -> DataFrame:
        """The tax staging table: billed invoices only, both systems."""
        return R.invoice_tax(self.sources.tax_lines(), self.sources.billing_line)

    @cached_property
    def _tax_for_join(self) -> DataFrame:
        return R.invoice_tax(self.sources.tax_lines(), None)

    @cached_property
    def billing_with_tax(self) -> DataFrame:
        return R.attach_tax(self.monthly_billing, self._tax_for_join)

    @cached_property
    def enriched_invoices(self) -> DataFrame:
        return R.attach_customer(self.billing_with_tax, self.customer_segments)

    @cached_property
    def zero_billing(self) -> DataFrame:
        """Zero invoice-months of the window, before any enrichment."""
        return self.monthly_billing.filter(F.col("sum_amount") == 0)

    # -- path 2: kept analytic table and counter -------------------------------
    @cached_property
    def zero_invoices(self) -> DataFrame:
        return Z.zero_invoices(self.enriched_invoices)

    @cached_property
    def zero_counter(self) -> DataFrame:
        """The counter staging table, row count ``qtde`` included."""
        return Z.month_counter(self.zero_invoices, self.ctx, with_row_count=True)

    @cached_property
    def alarm_counter(self) -> DataFrame:
        """Counter as the alarm stage reads it (no tax join, no ``qtde``)."""
        enriched = R.attach_customer(self.zero_billing, self.customer_segments)
        return Z.month_counter(Z.zero_invoices(enriched), self.ctx, with_row_count=False)

    # -- path 3: alarms ---------------------------------------------------------
    def month_counts(self, grain: str) -> DataFrame:
        return A.month_counts(self.alarm_counter, self.sources.alarm_factor, grain)

    def grain_alarms(self, grain: str, with_timestamp: bool = False) -> DataFrame:
        return A.alarm_rows(self.month_counts(grain), grain, self.ctx, with_timestamp)

    def all_alarms(self, with_timestamp: bool = False) -> DataFrame:
        return A.all_alarms(self.alarm_counter, self.sources.alarm_factor, self.ctx, with_timestamp)


def alarms_from_zero_invoices(
    zero: DataFrame, alarm_factor: DataFrame, ctx: RunContext, with_timestamp: bool = True
) -> DataFrame:
    """Alarm rows computed from a (stored) zero-invoice table."""
    counter = Z.month_counter(zero, ctx, with_row_count=False)
    return A.all_alarms(counter, alarm_factor, ctx, with_timestamp)


def enrich_zero_billing(sources: Sources, zero_billing: DataFrame) -> DataFrame:
    """Zero invoice-months with tax and customer attached (the kept table).

    The invoice and account keys semi-join the tax lines and customer rows
    first, so only rows that can match are aggregated and shuffled. No hint:
    ``zero_billing`` is read from files, so the planner knows its size and
    picks a broadcast or a shuffle itself.
    """
    bills = zero_billing.select("bill_ref_no").distinct()
    accounts = zero_billing.select("account_no").distinct()
    tax_systems = {
        k: R.latest_snapshot(v).join(bills, "bill_ref_no", "left_semi")
        for k, v in sources.tax_lines().items()
    }
    customer = sources.customer.join(accounts, "account_no", "left_semi")
    tax = R.invoice_tax(tax_systems, None, snapshot_applied=True)
    with_tax = R.attach_tax(zero_billing, tax)
    return Z.zero_invoices(R.attach_customer(with_tax, R.customer_segments(customer)))


def run_month(
    spark: SparkSession,
    sources: Sources,
    ctx: RunContext,
    zero_invoice_path: str | None,
    alarm_target: str,
    alarm_format: str | None = sinks.ORC,
    idempotent: bool = False,
    zero_invoice_table: str | None = None,
) -> DataFrame:
    """Run the whole job for ``ctx`` and return the alarm rows written.

    1. stage the zero invoice-months below ``spark.checkpoint.dir``;
    2. refresh the kept zero-invoice table (ORC, snappy), enriched by
       semi-joins on the zero keys; the staging is dropped, also on failure,
       and a failed run leaves the last kept table in place;
    3. read it back and build the alarms from it;
    4. append them to ``alarm_target`` (or, with ``idempotent=True``, replace
       that month's partitions so a re-run does not duplicate alarms).

    The kept table is a folder (``zero_invoice_path``), a catalog table
    (``zero_invoice_table``), or with both an external table below that
    folder. The run timestamp is fixed at the start, so the returned frame
    repeats the stored rows.
    """
    if idempotent and alarm_format is None:
        raise ValueError("idempotent=True writes partitioned files: give alarm_format")
    if zero_invoice_path is None and zero_invoice_table is None:
        raise ValueError("name the kept table: zero_invoice_path, zero_invoice_table or both")
    if ctx.run_ts is None:
        now = dt.datetime.now(ZoneInfo(spark.conf.get("spark.sql.session.timeZone")))
        ctx = replace(ctx, run_ts=now.replace(tzinfo=None, microsecond=0))
    plan = AlarmPlan(sources, ctx)
    with scratch_scope(spark):
        stage_path = scratch_path(spark, "zero_billing")
        sinks.write_table(plan.zero_billing, stage_path)
        kept = enrich_zero_billing(sources, spark.read.orc(stage_path))
        if zero_invoice_table:
            sinks.refresh_table(kept, zero_invoice_table, location=zero_invoice_path)
        else:
            sinks.write_table(kept, zero_invoice_path)
    stored = spark.table(zero_invoice_table) if zero_invoice_table else spark.read.orc(zero_invoice_path)
    alarms = alarms_from_zero_invoices(stored, sources.alarm_factor, ctx, with_timestamp=True)
    if idempotent:
        sinks.replace_period(alarms, alarm_target, alarm_format, period=ctx.period)
    else:
        sinks.append_alarms(alarms, alarm_target, alarm_format)
    return alarms
