"""Business expressions of the alarm job.

Every function returns a ``Column`` built from ``pyspark.sql.functions`` so
it stays inside whole-stage codegen. Division uses ``try_divide`` (NULL on a
zero divisor, independent of ``spark.sql.ansi.enabled``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the reference's codes and labels exactly.
# ---------------------------------------------------------------------------
B2B_CATEGORIES = ("12", "13", "14", "15", "21", "22")
NOT_BILLABLE_CATEGORIES = ("17", "18", "19", "20")
OWN_USE_CATEGORIES = ("16",)
SEGMENT_B2B = "B2B"
SEGMENT_NOT_BILLABLE = "CONTAS N FATURAVEIS"
SEGMENT_OWN_USE = "USO PROPRIO"
SEGMENT_DEFAULT = "B2C"
NULL_TEXT = "NULL"
MISSING_STATE = "SEM UF"
FLAG_YES = "s"
FLAG_NO = "n"
LABEL_NORMAL = "Normal"
LABEL_ABOVE = "Ultrapassou Limite Superior"
MONTH_FORMAT = "yyyyMM"
# ---------------------------------------------------------------------------

HISTORY_MONTHS = 6


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def segment(category: Column | str) -> Column:
    """Customer segment from the account category code.

    Anything not listed, NULL included, is the default segment.
    """
    c = _col(category)
    return (
        F.when(c.isin(*B2B_CATEGORIES), SEGMENT_B2B)
        .when(c.isin(*NOT_BILLABLE_CATEGORIES), SEGMENT_NOT_BILLABLE)
        .when(c.isin(*OWN_USE_CATEGORIES), SEGMENT_OWN_USE)
        .otherwise(SEGMENT_DEFAULT)
    )


def default_segment(seg: Column | str) -> Column:
    """Unmatched customer (NULL segment) falls back to the default segment."""
    return F.coalesce(_col(seg), F.lit(SEGMENT_DEFAULT))


def state_key(state: Column | str) -> Column:
    """State shown on alarms and used as rule key: NULL or text 'NULL' -> 'SEM UF'."""
    s = _col(state)
    return F.when(s.isNull() | (s == NULL_TEXT), MISSING_STATE).otherwise(s)


def tax_or_zero(tax: Column | str, dtype: T.DataType = T.DecimalType(29, 2)) -> Column:
    """Missing invoice tax counts as zero (typed, so no text comparison is needed)."""
    return F.coalesce(_col(tax), F.lit(0).cast(dtype)).cast(dtype)


def month_key(ts: Column | str) -> Column:
    """``yyyyMM`` text of a date or timestamp."""
    return F.date_format(_col(ts), MONTH_FORMAT)


def month_start(ts: Column | str) -> Column:
    """First day of the month (a date): a fixed-width grouping key with the
    same partition of rows as ``month_key``, formatted only after grouping."""
    return F.trunc(_col(ts).cast(T.DateType()), "month")


def variation(newer: Column | str, older: Column | str) -> Column:
    """Unrounded month-over-month variation ``newer / older - 1``; NULL when older is 0."""
    return F.try_divide(_col(newer), _col(older)) - F.lit(1)


def mean_variation(variations: Sequence[Column]) -> Column:
    """Mean absolute variation over the six month pairs, rounded to 2 places.

    The first term enters signed and only the outer ``abs`` covers it, so a
    negative first variation offsets the others; the remaining terms are
    absolute values. Missing variations count as 0.
    """
    first, *rest = [F.coalesce(v, F.lit(0.0)) for v in variations]
    total = first
    for v in rest:
        total = total + F.abs(v)
    return F.round(F.abs(total) / F.lit(len(variations)), 2)


def six_month_mean(history: Sequence[Column]) -> Column:
    """Unrounded mean of the six history-month counts (double)."""
    if len(history) != HISTORY_MONTHS:
        raise ValueError(f"expected {HISTORY_MONTHS} history columns, got {len(history)}")
    total = history[0]
    for c in history[1:]:
        total = total + c
    return total / F.lit(HISTORY_MONTHS)


def level_lower(mean: Column, factor_inf: Column | str) -> Column:
    """Unrounded lower level limit ``m - m * inf``."""
    return mean - mean * _col(factor_inf)


def level_upper(mean: Column, factor_sup: Column | str) -> Column:
    """Unrounded upper level limit ``m + m * sup``."""
    return mean + mean * _col(factor_sup)


def alarm_flag(value: Column, lower: Column, upper: Column) -> Column:
    """'s' when the current count is strictly outside the unrounded limits, else 'n'.

    A NULL limit (no rule matched) compares as not-true, giving 'n'.
    """
    return (
        F.when(value < lower, FLAG_YES)
        .when(value > upper, FLAG_YES)
        .otherwise(FLAG_NO)
    )


def alarm_label(value: Column, lower: Column, upper: Column) -> Column:
    """Label of the alarm: only an upper breach is named; a lower breach reads 'Normal'."""
    return (
        F.when(value < lower, LABEL_NORMAL)
        .when(value > upper, LABEL_ABOVE)
        .otherwise(LABEL_NORMAL)
    )
