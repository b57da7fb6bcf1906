"""Zero-amount invoices and their seven-month presence counter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zerobill.functions.business import default_segment
from zerobill.run import RunContext

ZERO_INVOICE_COLUMNS = [
    "prep_date",
    "bill_ref_no",
    "account_no",
    "cust_state",
    "tipo_cliente",
    "sum_amount",
    "sum_tax",
    "sum_discount",
]


def zero_invoices(enriched: DataFrame) -> DataFrame:
    """Invoice-months whose amount sums to exactly zero (a NULL sum is not zero).

    The predicate only reads the billing roll-up, so Catalyst pushes it below
    both enrichment left joins: they run on zero invoices only.
    """
    return enriched.filter(F.col("sum_amount") == 0).select(*ZERO_INVOICE_COLUMNS)


def month_counter(zero: DataFrame, ctx: RunContext, with_row_count: bool = True) -> DataFrame:
    """One row per raw (segment, state, invoice) with one column per window month.

    ``mes_k`` is the invoice's amount in that month (always 0 here) or NULL
    when the invoice had no zero row that month, so ``count(mes_k)`` counts
    zero invoices. Grouping uses the raw segment, and the shown segment
    defaults NULL to B2C afterwards, so an unmatched account and a B2C
    account stay separate rows. ``qtde`` counts source rows (tax fan-out
    included); without it every aggregate is duplicate-insensitive.
    """
    months = [
        F.max(F.when(F.col("prep_date") == key, F.col("sum_amount"))).alias(name)
        for name, key in ctx.month_columns()
    ]
    if with_row_count:
        months.append(F.count(F.lit(1)).alias("qtde"))
    grouped = zero.groupBy("tipo_cliente", "cust_state", "bill_ref_no").agg(*months)
    rest = [name for name, _ in ctx.month_columns()] + (["qtde"] if with_row_count else [])
    return grouped.select(
        default_segment("tipo_cliente").alias("tipo_cliente"),
        "cust_state",
        "bill_ref_no",
        *rest,
    )
