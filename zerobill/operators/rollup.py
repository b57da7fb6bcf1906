"""Source roll-ups and the two enrichment joins.

Every aggregate here is algebraic (sum, max, count), so Spark pre-aggregates
on the map side before the shuffle and a hot key (one invoice or account with
a large share of the lines) arrives at the reducer as one partial row per map
task. Joins carry no hints: the planner broadcasts a side only when its
measured size is under ``spark.sql.autoBroadcastJoinThreshold`` (checked again
at runtime by AQE), otherwise it sort-merge joins, and AQE splits skewed
partitions.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zerobill.functions import month_key, month_start, segment, tax_or_zero
from zerobill.run import RunContext
from zerobill.schemas import INVOICE_TAX_TYPE

# ---------------------------------------------------------------------------
# Billing-line and tax-line selection rules of the reference.
# ---------------------------------------------------------------------------
PREP_STATUS_OK = "1"
BACKOUT_STATUS_OK = "0"
KEPT_TYPE_CODES = (2, 3, 6, 7)
TAX_TYPE_MIN = 1000000  # inclusive
TAX_TYPE_MAX = 4000000  # exclusive
CENTS_PER_UNIT = 100
# ---------------------------------------------------------------------------


def customer_segments(customer: DataFrame) -> DataFrame:
    """One row per (account, raw state, segment) with its source row count."""
    return customer.groupBy(
        "account_no", "cust_state", segment("account_category").alias("tipo_cliente")
    ).agg(F.count(F.lit(1)).alias("qtde"))


def _bound(kind: T.DataType, day: dt.date) -> Column:
    """A literal of the column's own type, so the comparison reaches the scan."""
    return F.lit(day.isoformat()).cast(kind)


def _moment(billing: DataFrame) -> Column:
    """The preparation date as a date or timestamp; text must read as one."""
    d, kind = F.col("prep_date"), billing.schema["prep_date"].dataType
    if not isinstance(kind, T.StringType):
        return d
    read = d.try_cast(T.TimestampNTZType())
    return F.when(read.isNotNull() | d.isNull(), read).otherwise(
        F.raise_error(F.concat(F.lit("prep_date: not a date: "), d)).cast(T.TimestampNTZType())
    )


def in_window(billing: DataFrame, ctx: RunContext) -> Column:
    """The seven closed months as a half-open range on the raw date column.

    Equivalent to comparing ``yyyyMM`` texts, but the bounds are pushed to
    the file scan (row-group and partition pruning). A date stored as text is
    first held against the window's years, in its own type: any text that
    reads as a date begins with its year, so this reaches the scan too, and
    only the years of the window are parsed.
    """
    start, end = ctx.window_bounds()
    kind = billing.schema["prep_date"].dataType
    if isinstance(kind, T.StringType):
        d, last = F.col("prep_date"), end - dt.timedelta(days=1)
        moment = _moment(billing)
        return (
            (d >= f"{start.year:04d}")
            & (d < f"{last.year + 1:04d}")
            & (moment >= F.lit(start.isoformat()).cast(T.TimestampNTZType()))
            & (moment < F.lit(end.isoformat()).cast(T.TimestampNTZType()))
        )
    d = F.col("prep_date")
    return (d >= _bound(kind, start)) & (d < _bound(kind, end))


def _status_is(billing: DataFrame, column: str, code: str) -> Column:
    """Equality with a status code in the type it is stored in."""
    stored = billing.schema[column].dataType
    return F.col(column) == (code if isinstance(stored, T.StringType) else F.lit(int(code)).cast(stored))


def billable(billing: DataFrame) -> Column:
    """Line filters: posted, kept type, not backed out, no preparation error.

    Codes are compared as stored; a decimal 2.7 is none of the kept types.
    """
    err, kind = F.col("prep_error_code"), billing.schema["type_code"].dataType
    kept = [F.lit(c).cast(kind) for c in KEPT_TYPE_CODES]
    return (
        _status_is(billing, "prep_status", PREP_STATUS_OK)
        & F.col("type_code").isin(*kept)
        & _status_is(billing, "backout_status", BACKOUT_STATUS_OK)
        & (err.isNull() | (err == F.lit(0).cast(billing.schema["prep_error_code"].dataType)))
    )


def monthly_billing(billing: DataFrame, ctx: RunContext) -> DataFrame:
    """Billing lines of the window rolled up to month x invoice x account.

    Lines are grouped by the month's first day and the ``yyyyMM`` text is
    formatted once per output row instead of once per line.
    """
    return (
        billing.filter(in_window(billing, ctx) & billable(billing))
        .groupBy(month_start(_moment(billing)).alias("_month"), "bill_ref_no", "account_no")
        .agg(
            F.sum("amount").alias("sum_amount"),
            F.sum("tax").alias("sum_tax"),
            F.sum("discount").alias("sum_discount"),
        )
        .select(
            month_key("_month").alias("prep_date"),
            "bill_ref_no",
            "account_no",
            "sum_amount",
            "sum_tax",
            "sum_discount",
        )
    )


def latest_snapshot(tax_lines: DataFrame) -> DataFrame:
    """Lines of the most recent ``dt_foto`` only.

    Planned as a scalar subquery filter on the scan (no join); when the table
    is partitioned by ``dt_foto`` the filter prunes partitions at runtime.
    """
    newest = tax_lines.agg(F.max("dt_foto")).scalar()
    return tax_lines.filter(F.col("dt_foto") == newest)


def billed_invoice_keys(billing: DataFrame) -> DataFrame:
    """Distinct invoice numbers of all billing lines (whole history, no filter)."""
    return billing.select("bill_ref_no").distinct()


def restrict_to_billed(tax: DataFrame, billing: DataFrame) -> DataFrame:
    """Tax rows whose invoice appears in billing.

    A left-semi join: never duplicates a tax row, and the map-side distinct
    on the key list shrinks its shuffle to one row per invoice per task.
    """
    return tax.join(billed_invoice_keys(billing), "bill_ref_no", "left_semi")


def tagged_lines(tax_systems: dict[int, DataFrame]) -> DataFrame:
    """Bag union of the systems' lines with the system's number in front."""
    parts = [lines.select(F.lit(k).alias("system"), "*") for k, lines in tax_systems.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def billed_tax_lines(tax_systems: dict[int, DataFrame], billing: DataFrame) -> DataFrame:
    """Latest-snapshot lines of all systems whose invoice appears in billing.

    One semi-join over the tagged union: billing's key list is built and
    exchanged once, whatever the number of systems (where Catalyst moves the
    join below the union, both sides reuse the list's exchange).
    """
    return restrict_to_billed(tagged_lines({k: latest_snapshot(v) for k, v in tax_systems.items()}), billing)


def qualifying_tax(tax_lines: DataFrame) -> Column:
    """Type in the half-open range and a positive amount, compared as stored."""
    code, kind = F.col("tax_type_code"), tax_lines.schema["tax_type_code"].dataType
    if isinstance(kind, T.DecimalType) and kind.precision - kind.scale < len(str(TAX_TYPE_MAX)):
        kind = T.LongType()  # a type too narrow for the bounds
    low, high = (F.lit(x).cast(kind) for x in (TAX_TYPE_MIN, TAX_TYPE_MAX))
    return (code >= low) & (code < high) & (F.col("federal_tax") > 0)


def invoice_tax(
    tax_systems: dict[int, DataFrame], billing: DataFrame | None, snapshot_applied: bool = False
) -> DataFrame:
    """Tax per invoice and system, latest snapshot, in currency units: an
    invoice with lines in both systems appears twice.

    All systems are summed in one aggregate with a conditional sum each, keyed
    by the invoice alone, so lines are pre-aggregated map-side and there is
    one exchange. With ``billing`` given, invoices are restricted to those in
    billing (the staging table as the reference keeps it) by one semi-join
    that reuses the aggregate's partitioning. The enrichment passes ``None``:
    it left-joins the tax onto windowed billing rows, whose invoices are
    billed by construction, so the restriction cannot change its result and
    the whole-history key scan is skipped. ``snapshot_applied`` means the
    caller already kept the latest snapshots only (the max must be taken over
    the whole system, before any other restriction).
    """
    lines = {
        k: (v if snapshot_applied else latest_snapshot(v)).filter(qualifying_tax(v)).select("bill_ref_no", "federal_tax")
        for k, v in tax_systems.items()
    }
    sums = {k: F.sum(F.when(F.col("system") == k, F.col("federal_tax"))) for k in tax_systems}
    per_invoice = tagged_lines(lines).groupBy("bill_ref_no").agg(
        *[
            # sum(cents) / 100 equals the sum of per-line cents / 100 exactly in
            # decimal arithmetic, with one division per invoice instead of per line
            F.round(s / F.lit(CENTS_PER_UNIT), 2).cast(INVOICE_TAX_TYPE).alias(f"_tax_{k}")
            for k, s in sums.items()
        ]
    )
    if billing is not None:
        per_invoice = restrict_to_billed(per_invoice, billing)
    each = F.explode(F.array(*[F.col(f"_tax_{k}") for k in tax_systems])).alias("tax")
    # amounts are positive, so a system without lines for the invoice is the only NULL
    return per_invoice.select("bill_ref_no", each).filter(F.col("tax").isNotNull())


def attach_tax(monthly: DataFrame, tax: DataFrame) -> DataFrame:
    """Left-join invoice tax onto the roll-up; fans out for two-system invoices."""
    t = tax.select(F.col("bill_ref_no").alias("_t_bill"), F.col("tax").alias("_t_tax"))
    joined = monthly.join(t, monthly["bill_ref_no"] == t["_t_bill"], "left")
    return joined.select(
        "prep_date",
        "bill_ref_no",
        "account_no",
        "sum_amount",
        tax_or_zero("_t_tax", INVOICE_TAX_TYPE).alias("sum_tax"),
        "sum_discount",
    )


def attach_customer(invoices: DataFrame, segments: DataFrame) -> DataFrame:
    """Left-join state and segment by account; fans out per customer row."""
    g = segments.select(
        F.col("account_no").alias("_g_account"), "cust_state", "tipo_cliente"
    )
    joined = invoices.join(g, invoices["account_no"] == g["_g_account"], "left")
    return joined.select(
        "prep_date",
        "bill_ref_no",
        "account_no",
        "cust_state",
        "tipo_cliente",
        "sum_amount",
        "sum_tax",
        "sum_discount",
    )


__all__ = [
    "attach_customer",
    "attach_tax",
    "billed_invoice_keys",
    "billed_tax_lines",
    "customer_segments",
    "in_window",
    "invoice_tax",
    "latest_snapshot",
    "monthly_billing",
    "restrict_to_billed",
    "tagged_lines",
]
