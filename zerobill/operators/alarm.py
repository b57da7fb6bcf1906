"""Level alarms at two grains: per segment x state, and per segment.

Both grains are one operator with a ``grain`` argument. The counter is first
reduced to one row per (segment, raw state) holding the seven zero-invoice
counts; the rule join and the final grouping then work on that tiny table.
Joining first and counting later (as a row-at-a-time plan would) gives the
same numbers: a counter row that matches ``r`` identical rules is counted
``r`` times either way, because the per-key counts are summed once per
joined rule row. A hot segment or state never reaches a single join task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zerobill.functions import (
    alarm_flag,
    alarm_label,
    level_lower,
    level_upper,
    mean_variation,
    six_month_mean,
    state_key,
    variation,
)
from zerobill.run import RunContext
from zerobill.schemas import ALARM_COLUMNS, ALARM_SCHEMA

# ---------------------------------------------------------------------------
# Rule range, scopes and the constant texts of an alarm row.
# ---------------------------------------------------------------------------
RULE_CODE_FIRST = "PAT0501401"
RULE_CODE_LAST = "PAT0501700"
SCOPE_STATE = "ESTADO"
SCOPE_PERIOD = "PERIODO"
PERIOD_ITEM = "PERIODO"
NO_INFO = "SEM INFO"
NO_CLASSIFICATION = "SEM CLASSIFICACAO"
SUBJECT = "Fatura Zerada - Patamar"
REDUCER = "n"
VALUE_REFERENCE = "Quantidade Fatura"
PRODUCT_INDICATOR = "Faturamento - Outros"
TECHNOLOGY = "SEM CLASS"
PERIODICITY = "MENSAL"
# ---------------------------------------------------------------------------

GRAIN_STATE = "state"
GRAIN_PERIOD = "period"
GRAINS = (GRAIN_STATE, GRAIN_PERIOD)

RULE_COLUMNS = [
    "cod",
    "tipo",
    "sistema",
    "etapa",
    "fator_perc_inf",
    "fator_perc_sup",
    "fator_num_inf",
    "fator_num_sup",
    "fator_perc_composto",
    "ponto",
]

# count of mes_atual, mes_1 .. mes_6 as they are named on the alarm row
COUNT_COLUMNS = ["valor"] + [f"valor_mes_ant_{k}" for k in range(1, 7)]
_COUNTER_MONTHS = ["mes_atual"] + [f"mes_{k}" for k in range(1, 7)]

# Alarm columns that are constant zeros (int) on every row.
_ZERO_INT_COLUMNS = [
    "media_quant",
    "dif_media_valor_x_quant",
    "imp_x_fat_atual",
    "imp_x_fat_media",
    "quant",
    "quant_mes_ant",
    "quant_med",
    "limite_inferior_quant",
    "limite_superior_quant",
    "fator_perc_inf_quant",
    "fator_perc_sup_quant",
    "arpu",
    "arpu_mes_ant",
]


def scope_of(grain: str) -> str:
    if grain not in GRAINS:
        raise ValueError(f"unknown grain {grain!r}; expected one of {GRAINS}")
    return SCOPE_STATE if grain == GRAIN_STATE else SCOPE_PERIOD


def rules(alarm_factor: DataFrame, scope: str) -> DataFrame:
    """Rules of this alarm family for one scope (pushed down to the rule scan)."""
    cod = F.col("cod")
    return alarm_factor.filter(
        (cod >= RULE_CODE_FIRST) & (cod <= RULE_CODE_LAST) & (F.col("campo") == scope)
    )


def key_counts(counter: DataFrame) -> DataFrame:
    """Zero-invoice counts per (segment, raw state): one partial aggregate."""
    return counter.groupBy("tipo_cliente", "cust_state").agg(
        *[F.count(m).alias(c) for m, c in zip(_COUNTER_MONTHS, COUNT_COLUMNS)]
    )


def month_counts(counter: DataFrame, alarm_factor: DataFrame, grain: str) -> DataFrame:
    """Counts c0..c6 per alarm group: grain keys plus the matched rule's columns.

    State grain joins rules on (segment, state key) and keeps the raw state in
    the group, so NULL and 'NULL' stay two rows. Period grain joins on segment.
    Unmatched groups keep NULL rule columns (left join).
    """
    scoped = rules(alarm_factor, scope_of(grain)).select(
        F.col("tipo_cliente").alias("_r_segment"), F.col("chave").alias("_r_key"), *RULE_COLUMNS
    )
    counts = key_counts(counter)
    if grain == GRAIN_STATE:
        keys = ["tipo_cliente", "cust_state"]
        left = counts.withColumn("_state_key", state_key("cust_state"))
        cond = (left["tipo_cliente"] == scoped["_r_segment"]) & (
            left["_state_key"] == scoped["_r_key"]
        )
    else:
        keys = ["tipo_cliente"]
        left = counts.groupBy("tipo_cliente").agg(*[F.sum(c).alias(c) for c in COUNT_COLUMNS])
        cond = left["tipo_cliente"] == scoped["_r_segment"]
    joined = left.join(scoped, cond, "left")
    return joined.groupBy(*keys, *RULE_COLUMNS).agg(
        *[F.sum(c).cast(T.LongType()).alias(c) for c in COUNT_COLUMNS]
    )


def alarm_rows(
    counts: DataFrame, grain: str, ctx: RunContext, with_timestamp: bool = False
) -> DataFrame:
    """Alarm rows in table order (55 columns, or 56 with ``data_alarme``).

    Mean, limits and ratios get a column of their own first: the output reads
    each several times, and a named column is computed once per row.
    """
    scope_of(grain)
    c = [F.col(name) for name in COUNT_COLUMNS]
    ratios = {f"_var_{k}": variation(c[k], c[k + 1]) for k in range(6)}
    counts = counts.withColumns({**ratios, "_mean": six_month_mean(c[1:])}).withColumns(
        {"_lower": level_lower(F.col("_mean"), "fator_perc_inf"), "_upper": level_upper(F.col("_mean"), "fator_perc_sup")}
    )
    raw_var = [F.col(name) for name in ratios]
    mean, lower, upper = (F.col(n) for n in ("_mean", "_lower", "_upper"))
    item = state_key("cust_state") if grain == GRAIN_STATE else F.lit(PERIOD_ITEM)

    values: dict[str, Column] = {
        "segmento": F.col("tipo_cliente"),
        "tipo_cliente": F.lit(NO_INFO),
        "item_alarme": item,
        "produto": item,
        "tipo_fat": F.lit(NO_CLASSIFICATION),
        "periodo": F.lit(ctx.period),
        "valor": c[0],
        "media_valor": F.lit(0.0),
        "med_var_mes": mean_variation(raw_var),
        "assunto": F.lit(SUBJECT),
        "redutor": F.lit(REDUCER),
        "media_meses": F.round(mean, 2),
        "limite_inferior": F.round(lower, 2),
        "limite_superior": F.round(upper, 2),
        "flag_alarme": alarm_flag(c[0], lower, upper),
        "alarme": alarm_label(c[0], lower, upper),
        "referencia_valor": F.lit(VALUE_REFERENCE),
        "rel_ind_produto": F.lit(PRODUCT_INDICATOR),
        "tecnologia": F.lit(TECHNOLOGY),
        "periodicidade": F.lit(PERIODICITY),
    }
    for k in range(1, 7):
        values[f"var_mes_ant_{k}"] = F.round(raw_var[k - 1], 2)
        values[f"valor_mes_ant_{k}"] = c[k]
    for name in RULE_COLUMNS:
        values[name] = F.col(name)
    for name in _ZERO_INT_COLUMNS:
        values[name] = F.lit(0)
    if with_timestamp:
        # a wall-clock literal: text -> timestamp_ntz does not depend on any time zone
        values["data_alarme"] = (
            F.lit(ctx.run_ts.isoformat(sep=" ")).cast(T.TimestampNTZType())
            if ctx.run_ts is not None
            else F.localtimestamp()
        )

    out = []
    for field in ALARM_SCHEMA.fields:
        if field.name == "data_alarme" and not with_timestamp:
            continue
        out.append(values[field.name].cast(field.dataType).alias(field.name))
    return counts.select(*out)


def grain_alarms(
    counter: DataFrame,
    alarm_factor: DataFrame,
    grain: str,
    ctx: RunContext,
    with_timestamp: bool = False,
) -> DataFrame:
    return alarm_rows(month_counts(counter, alarm_factor, grain), grain, ctx, with_timestamp)


def all_alarms(
    counter: DataFrame,
    alarm_factor: DataFrame,
    ctx: RunContext,
    with_timestamp: bool = False,
) -> DataFrame:
    """State-grain rows followed by period-grain rows (bag union)."""
    state = grain_alarms(counter, alarm_factor, GRAIN_STATE, ctx, with_timestamp)
    period = grain_alarms(counter, alarm_factor, GRAIN_PERIOD, ctx, with_timestamp)
    return state.unionByName(period)


__all__ = [
    "ALARM_COLUMNS",
    "COUNT_COLUMNS",
    "RULE_COLUMNS",
    "all_alarms",
    "alarm_rows",
    "grain_alarms",
    "key_counts",
    "month_counts",
    "rules",
]
