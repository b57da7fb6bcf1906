"""Column expressions (``Column -> Column``), all JVM-side built-ins."""

from zerobill.functions.business import (
    alarm_flag,
    alarm_label,
    level_lower,
    level_upper,
    mean_variation,
    month_key,
    month_start,
    segment,
    six_month_mean,
    state_key,
    tax_or_zero,
    variation,
)

__all__ = [
    "alarm_flag",
    "alarm_label",
    "level_lower",
    "level_upper",
    "mean_variation",
    "month_key",
    "month_start",
    "segment",
    "six_month_mean",
    "state_key",
    "tax_or_zero",
    "variation",
]
