"""Logical schemas of the five inputs and of the 56-column alarm row.

Only the columns the job reads are listed; extra source columns are pruned
by the scan. Money is decimal so that "the invoice sums to exactly zero" is
an exact test.
"""

from __future__ import annotations

from pyspark.sql import types as T

CUSTOMER = T.StructType([
    T.StructField("account_no", T.LongType(), False),
    T.StructField("cust_state", T.StringType(), True),
    T.StructField("account_category", T.StringType(), True),
])

BILLING_LINE = T.StructType([
    T.StructField("prep_date", T.TimestampNTZType(), False),
    T.StructField("bill_ref_no", T.LongType(), False),
    T.StructField("account_no", T.LongType(), False),
    T.StructField("amount", T.DecimalType(18, 2), True),
    T.StructField("tax", T.DecimalType(23, 4), True),
    T.StructField("discount", T.DecimalType(23, 4), True),
    T.StructField("type_code", T.IntegerType(), False),
    T.StructField("prep_status", T.StringType(), False),
    T.StructField("backout_status", T.StringType(), False),
    T.StructField("prep_error_code", T.IntegerType(), True),
])

TAX_LINE = T.StructType([
    T.StructField("bill_ref_no", T.LongType(), False),
    T.StructField("tax_type_code", T.IntegerType(), False),
    T.StructField("federal_tax", T.DecimalType(18, 2), True),
    T.StructField("dt_foto", T.DateType(), False),
])

ALARM_FACTOR = T.StructType([
    T.StructField("cod", T.StringType(), False),
    T.StructField("campo", T.StringType(), False),
    T.StructField("tipo_cliente", T.StringType(), False),
    T.StructField("chave", T.StringType(), False),
    T.StructField("tipo", T.StringType(), True),
    T.StructField("sistema", T.StringType(), True),
    T.StructField("etapa", T.StringType(), True),
    T.StructField("ponto", T.StringType(), True),
    T.StructField("fator_perc_inf", T.DoubleType(), True),
    T.StructField("fator_perc_sup", T.DoubleType(), True),
    T.StructField("fator_num_inf", T.DoubleType(), True),
    T.StructField("fator_num_sup", T.DoubleType(), True),
    T.StructField("fator_perc_composto", T.DoubleType(), True),
])

SOURCES = {
    "customer": CUSTOMER,
    "billing_line": BILLING_LINE,
    "tax_line_1": TAX_LINE,
    "tax_line_2": TAX_LINE,
    "alarm_factor": ALARM_FACTOR,
}

# What a column is used for decides how an input's stored type is taken over
# (``zerobill.sources.catalog``).
KEY, CODE, STATUS, DAY, MEASURE, TEXT, FACTOR = "key", "code", "status", "day", "measure", "text", "factor"
_ROLES = {
    KEY: ("account_no", "bill_ref_no"),
    CODE: ("type_code", "prep_error_code", "tax_type_code"),
    STATUS: ("prep_status", "backout_status"),
    DAY: ("prep_date", "dt_foto"),
    MEASURE: ("amount", "tax", "discount", "federal_tax"),
}


def role(column: str) -> str:
    for name, columns in _ROLES.items():
        if column in columns:
            return name
    return FACTOR if column.startswith("fator_") else TEXT


# Tax per invoice after the cents-to-currency conversion.
INVOICE_TAX_TYPE = T.DecimalType(29, 2)

_S, _L, _D, _I = T.StringType(), T.LongType(), T.DoubleType(), T.IntegerType()

# The alarm table is written by position, so this order is the contract.
ALARM_SCHEMA = T.StructType([
    T.StructField("segmento", _S),
    T.StructField("tipo_cliente", _S),
    T.StructField("item_alarme", _S),
    T.StructField("produto", _S),
    T.StructField("tipo_fat", _S),
    T.StructField("periodo", _S),
    T.StructField("valor", _L),
    T.StructField("media_valor", _D),
    T.StructField("media_quant", _I),
    T.StructField("dif_media_valor_x_quant", _I),
    T.StructField("var_mes_ant_1", _D),
    T.StructField("valor_mes_ant_1", _L),
    T.StructField("var_mes_ant_2", _D),
    T.StructField("valor_mes_ant_2", _L),
    T.StructField("var_mes_ant_3", _D),
    T.StructField("valor_mes_ant_3", _L),
    T.StructField("var_mes_ant_4", _D),
    T.StructField("valor_mes_ant_4", _L),
    T.StructField("var_mes_ant_5", _D),
    T.StructField("valor_mes_ant_5", _L),
    T.StructField("var_mes_ant_6", _D),
    T.StructField("valor_mes_ant_6", _L),
    T.StructField("med_var_mes", _D),
    T.StructField("cod", _S),
    T.StructField("tipo", _S),
    T.StructField("assunto", _S),
    T.StructField("redutor", _S),
    T.StructField("sistema", _S),
    T.StructField("etapa", _S),
    T.StructField("media_meses", _D),
    T.StructField("limite_inferior", _D),
    T.StructField("limite_superior", _D),
    T.StructField("imp_x_fat_atual", _I),
    T.StructField("imp_x_fat_media", _I),
    T.StructField("fator_perc_inf", _D),
    T.StructField("fator_perc_sup", _D),
    T.StructField("fator_num_inf", _D),
    T.StructField("fator_num_sup", _D),
    T.StructField("fator_perc_composto", _D),
    T.StructField("flag_alarme", _S),
    T.StructField("alarme", _S),
    T.StructField("ponto", _S),
    T.StructField("referencia_valor", _S),
    T.StructField("rel_ind_produto", _S),
    T.StructField("tecnologia", _S),
    T.StructField("data_alarme", T.TimestampNTZType()),
    T.StructField("quant", _I),
    T.StructField("quant_mes_ant", _I),
    T.StructField("quant_med", _I),
    T.StructField("limite_inferior_quant", _I),
    T.StructField("limite_superior_quant", _I),
    T.StructField("fator_perc_inf_quant", _I),
    T.StructField("fator_perc_sup_quant", _I),
    T.StructField("arpu", _I),
    T.StructField("arpu_mes_ant", _I),
    T.StructField("periodicidade", _S),
])

ALARM_COLUMNS = [f.name for f in ALARM_SCHEMA.fields]
assert len(ALARM_COLUMNS) == 56
