"""Relational steps of the job (``DataFrame -> DataFrame``)."""

from zerobill.operators.alarm import all_alarms, alarm_rows, grain_alarms, month_counts, rules
from zerobill.operators.rollup import (
    attach_customer,
    attach_tax,
    customer_segments,
    invoice_tax,
    latest_snapshot,
    monthly_billing,
    restrict_to_billed,
)
from zerobill.operators.zero import month_counter, zero_invoices

__all__ = [
    "all_alarms",
    "alarm_rows",
    "attach_customer",
    "attach_tax",
    "customer_segments",
    "grain_alarms",
    "invoice_tax",
    "latest_snapshot",
    "month_counter",
    "month_counts",
    "monthly_billing",
    "restrict_to_billed",
    "rules",
    "zero_invoices",
]
