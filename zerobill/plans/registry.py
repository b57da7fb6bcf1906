"""Registered queries: one per stage or operator of the job.

Each entry takes ``(spark, sf_dir)``, derives the five logical inputs from the
test tables in ``sf_dir`` (``zerobill.sources.fixture``), runs the job for the
fixture run date and returns one stage as a DataFrame. Column names match the
DuckDB oracle in ``zerobill.oracle``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zerobill import schemas
from zerobill.functions import month_key, month_start, state_key
from zerobill.functions.business import default_segment
from zerobill.operators import alarm as A
from zerobill.operators import rollup as R
from zerobill.plans.job import AlarmPlan, run_month
from zerobill.run import FIXTURE_RUN, RunContext
from zerobill.schemas import ALARM_SCHEMA
from zerobill.session import scratch_path
from zerobill.sources import sinks
from zerobill.sources.catalog import conform
from zerobill.sources.fixture import DriverTables, fixture_sources, stored_billing

Query = Callable[[SparkSession, str], DataFrame]

TAX_LINE_COLUMNS = ["system", "bill_ref_no", "tax_type_code", "federal_tax", "dt_foto"]
ALARM_KEY = ["segmento", "item_alarme", "cod"]


def plan_for(spark: SparkSession, sf_dir: str, ctx: RunContext = FIXTURE_RUN) -> AlarmPlan:
    return AlarmPlan(fixture_sources(spark, sf_dir), ctx)


def q01_customer_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan_for(spark, sf_dir).customer_segments


def q02_monthly_billing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan_for(spark, sf_dir).monthly_billing


def q03_latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = plan_for(spark, sf_dir)
    latest = {system: plan.latest_tax_lines(system) for system in plan.sources.tax_lines()}
    return R.tagged_lines(latest).select(*TAX_LINE_COLUMNS)


def q04_billed_tax_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan_for(spark, sf_dir).billed_tax_lines.select(*TAX_LINE_COLUMNS)


def q05_invoice_tax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan_for(spark, sf_dir).invoice_tax


def q06_billing_with_tax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan_for(spark, sf_dir).billing_with_tax


def q07_enriched_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan_for(spark, sf_dir).enriched_invoices


def q08_zero_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan_for(spark, sf_dir).zero_invoices


def q09_zero_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    zero = plan_for(spark, sf_dir).zero_invoices
    return zero.groupBy(default_segment("tipo_cliente").alias("tipo_cliente")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("bill_ref_no").alias("n_invoices"),
    )


def q10_zero_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan_for(spark, sf_dir).zero_counter


def q12_state_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan_for(spark, sf_dir).month_counts(A.GRAIN_STATE)


def q13_period_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan_for(spark, sf_dir).month_counts(A.GRAIN_PERIOD)


def q14_state_alarms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan_for(spark, sf_dir).grain_alarms(A.GRAIN_STATE)


def q15_period_alarms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan_for(spark, sf_dir).grain_alarms(A.GRAIN_PERIOD)


def q16_all_alarms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan_for(spark, sf_dir).all_alarms()


def q17_state_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = plan_for(spark, sf_dir).sources.customer
    counts = customer.groupBy("cust_state").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.select("cust_state", state_key("cust_state").alias("state_key"), "n_rows")


def q18_month_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = plan_for(spark, sf_dir)
    billing = plan.sources.billing_line
    lines = billing.filter(R.in_window(billing, plan.ctx) & R.billable(billing))
    counts = lines.groupBy(month_start("prep_date").alias("_month")).agg(
        F.count(F.lit(1)).alias("n_lines")
    )
    month = month_key("_month")
    return counts.select(
        month.alias("prep_date"), "n_lines", (month == F.lit(plan.ctx.period)).alias("is_period")
    )


def q19_month_variation(spark: SparkSession, sf_dir: str) -> DataFrame:
    alarms = plan_for(spark, sf_dir).all_alarms()
    cols = [c for k in range(1, 7) for c in (f"valor_mes_ant_{k}", f"var_mes_ant_{k}")]
    return alarms.select(*ALARM_KEY, "valor", *cols)


def q20_mean_variation(spark: SparkSession, sf_dir: str) -> DataFrame:
    alarms = plan_for(spark, sf_dir).all_alarms()
    return alarms.select(
        *ALARM_KEY, *[f"var_mes_ant_{k}" for k in range(1, 7)], "med_var_mes"
    )


def q21_level_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    alarms = plan_for(spark, sf_dir).all_alarms()
    return alarms.select(
        *ALARM_KEY,
        "valor",
        "media_meses",
        "limite_inferior",
        "limite_superior",
        "fator_perc_inf",
        "fator_perc_sup",
    )


def q22_alarm_flag_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = plan_for(spark, sf_dir)
    parts = [
        plan.grain_alarms(grain).select(F.lit(A.scope_of(grain)).alias("grain"), "*")
        for grain in A.GRAINS
    ]
    alarms = parts[0].unionByName(parts[1])
    return alarms.groupBy(
        "grain", "flag_alarme", "alarme", F.col("cod").isNotNull().alias("rule_matched")
    ).agg(F.count(F.lit(1)).alias("n_rows"))


def q23_orc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept table written twice in overwrite mode (full refresh), then read back."""
    zero = plan_for(spark, sf_dir).zero_invoices
    path = scratch_path(spark, "zero_invoices")
    for _ in range(2):
        sinks.write_table(zero, path)
    return spark.read.orc(path)


def q24_alarm_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 56 columns appended by position to an empty table, then read back."""
    alarms = plan_for(spark, sf_dir).all_alarms(with_timestamp=True)
    path = scratch_path(spark, "alarm_final")
    sinks.append_alarms(alarms, path)
    return sinks.read_alarms(spark, path)


def _name(kind: str) -> str:
    return f"zerobill_{kind}_{uuid.uuid4().hex[:8]}"


def q25_kept_table_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept table as a catalog table: created, then fully refreshed, and read
    back with the format and properties that the catalog has for it."""
    zero, table, place = plan_for(spark, sf_dir).zero_invoices, _name("kept"), scratch_path(spark, "kept")
    try:
        for _ in range(2):
            sinks.refresh_table(zero, table, location=place)
        properties = sinks.table_properties(spark, table)
        return spark.table(table).select(
            "*",
            F.lit(sinks.table_provider(spark, table)).alias("provider"),
            F.lit(properties.get("orc.compress")).alias("orc_compress"),
            F.lit(properties.get("transactional")).alias("transactional"),
        )
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")  # external: the rows stay until the session ends


def _alarm_table(spark: SparkSession, table: str) -> None:
    """An existing alarm table with names of its own, wider integers, at a scratch location."""
    wider = {"int": "bigint"}
    columns = ", ".join(
        f"c{i:02d} {wider.get(f.dataType.simpleString(), f.dataType.simpleString())}" for i, f in enumerate(ALARM_SCHEMA.fields)
    )
    spark.sql(f"CREATE TABLE {table} ({columns}) USING orc LOCATION '{scratch_path(spark, 'alarms')}'")


def _stored_alarms(spark: SparkSession, table: str) -> DataFrame:
    stored = spark.table(table)
    return stored.select(*[F.col(c).cast(f.dataType).alias(f.name) for c, f in zip(stored.columns, ALARM_SCHEMA.fields)])


def q26_alarm_insert_into(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both grains' alarms inserted by position, one after the other, into a
    catalog table that already exists under other column names."""
    plan, table = plan_for(spark, sf_dir), _name("alarms")
    _alarm_table(spark, table)
    try:
        for grain in A.GRAINS:
            sinks.append_alarms(plan.grain_alarms(grain, with_timestamp=True), table, fmt=None)
        return _stored_alarms(spark, table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def _run_month(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The production job into two catalog tables, both read back."""
    kept, alarms = _name("kept"), _name("alarms")
    _alarm_table(spark, alarms)
    try:
        run_month(
            spark, fixture_sources(spark, sf_dir), FIXTURE_RUN, scratch_path(spark, "kept"), alarms, alarm_format=None, zero_invoice_table=kept
        )
        return spark.table(kept), _stored_alarms(spark, alarms)
    finally:
        for table in (kept, alarms):
            spark.sql(f"DROP TABLE IF EXISTS {table}")


def q27_run_month_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_month(spark, sf_dir)[0]


def q28_run_month_alarms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_month(spark, sf_dir)[1]


def q29_default_format_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tax staging table without a storage clause, under two session
    defaults: each time the catalog names the session's format."""
    tax, parts = plan_for(spark, sf_dir).invoice_tax, []
    before = spark.conf.get("spark.sql.sources.default")
    try:
        for default in ("orc", "parquet"):
            spark.conf.set("spark.sql.sources.default", default)
            table = _name("tax")
            try:
                sinks.save_as_table(tax, table, path=scratch_path(spark, "tax"))
                parts.append(spark.table(table).select("*", F.lit(sinks.table_provider(spark, table)).alias("provider")))
            finally:
                spark.sql(f"DROP TABLE IF EXISTS {table}")
    finally:
        spark.conf.set("spark.sql.sources.default", before)
    return parts[0].unionAll(parts[1])


def q30_stored_layout_billing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roll-up of billing lines in another stored layout: nothing is rounded,
    merged or read as another code on the way in; NULL sums are no zero."""
    stored = stored_billing(DriverTables(spark, sf_dir))
    billing = conform(stored, schemas.BILLING_LINE, "billing_line", {"bill_ref_no": stored.schema["bill_ref_no"].dataType})
    return R.monthly_billing(billing, FIXTURE_RUN).withColumn("is_zero", F.col("sum_amount") == 0)


QUERIES: dict[str, Query] = {
    "q01_customer_segments": q01_customer_segments,
    "q02_monthly_billing": q02_monthly_billing,
    "q03_latest_snapshot": q03_latest_snapshot,
    "q04_billed_tax_lines": q04_billed_tax_lines,
    "q05_invoice_tax": q05_invoice_tax,
    "q06_billing_with_tax": q06_billing_with_tax,
    "q07_enriched_invoices": q07_enriched_invoices,
    "q08_zero_invoices": q08_zero_invoices,
    "q09_zero_by_segment": q09_zero_by_segment,
    "q10_zero_counter": q10_zero_counter,
    "q12_state_counts": q12_state_counts,
    "q13_period_counts": q13_period_counts,
    "q14_state_alarms": q14_state_alarms,
    "q15_period_alarms": q15_period_alarms,
    "q16_all_alarms": q16_all_alarms,
    "q17_state_key": q17_state_key,
    "q18_month_window": q18_month_window,
    "q19_month_variation": q19_month_variation,
    "q20_mean_variation": q20_mean_variation,
    "q21_level_limits": q21_level_limits,
    "q22_alarm_flag_label": q22_alarm_flag_label,
    "q23_orc_roundtrip": q23_orc_roundtrip,
    "q24_alarm_append": q24_alarm_append,
    "q25_kept_table_refresh": q25_kept_table_refresh,
    "q26_alarm_insert_into": q26_alarm_insert_into,
    "q27_run_month_kept": q27_run_month_kept,
    "q28_run_month_alarms": q28_run_month_alarms,
    "q29_default_format_table": q29_default_format_table,
    "q30_stored_layout_billing": q30_stored_layout_billing,
}
