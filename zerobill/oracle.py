"""Independent DuckDB SQL for every registered query (the correctness oracle).

The SQL states each stage the plain way: rules are joined to the counter
rows first and counted afterwards, the snapshot and billed-invoice
restrictions are subqueries, and no stage is pre-aggregated or skipped, so
it checks the rewrites the Spark plan relies on. It runs on the raw test tables (``region nation
customer orders lineitem`` are views) through the same fixture adapter as
``zerobill.sources.fixture``, written again in SQL.

Engine-parity rules (SURVEY section 5): tax is ``round(sum(cents) * 0.01, 2)``;
division by zero is ``x / NULLIF(y, 0)``; rounding of doubles goes through
the shortest decimal text (``_round2``) to match Spark's half-up rounding;
every output column is cast to the Spark type.
"""

from __future__ import annotations

from zerobill.sources import fixture as FX

RUN_DATE = "DATE '2001-08-15'"
RUN_TS = "TIMESTAMP '2001-08-15 00:00:00'"


def _month(offset: int) -> str:
    return f"strftime({RUN_DATE} - INTERVAL {offset} MONTH, '%Y%m')"


def _round2(x: str) -> str:
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE)"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _rules_values() -> str:
    rows = []
    for r in FX.alarm_factor_rows():
        cod, campo, seg, key, tipo, sistema, etapa, ponto, inf, sup, ni, ns, pc = r
        rows.append(
            f"({_q(cod)}, {_q(campo)}, {_q(seg)}, {_q(key)}, {_q(tipo)}, {_q(sistema)}, "
            f"{_q(etapa)}, {_q(ponto)}, {inf!r}::DOUBLE, {sup!r}::DOUBLE, {ni!r}::DOUBLE, "
            f"{ns!r}::DOUBLE, {pc!r}::DOUBLE)"
        )
    return ",\n    ".join(rows)


def _tax_source(system: int) -> str:
    return f"""
    SELECT l_orderkey AS bill_ref_no,
           CAST(l_linenumber * 700000 AS INTEGER) AS tax_type_code,
           CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) * 100
                AS DECIMAL(18,2)) AS federal_tax,
           CASE WHEN l_partkey % 5 = 0 THEN DATE '2001-07-31' ELSE DATE '2001-08-31' END AS dt_foto
    FROM lineitem WHERE l_suppkey % 2 = {system % 2}"""


def _system_tax(system: int) -> str:
    return f"""
    SELECT bill_ref_no, CAST(round(sum(federal_tax) * 0.01, 2) AS DECIMAL(29,2)) AS tax
    FROM src_tax_{system}
    WHERE dt_foto = (SELECT max(dt_foto) FROM src_tax_{system})
      AND bill_ref_no IN (SELECT bill_ref_no FROM src_billing)
      AND tax_type_code >= 1000000 AND tax_type_code < 4000000
      AND federal_tax > 0
    GROUP BY bill_ref_no"""


def _shown_state(col: str) -> str:
    return f"coalesce(nullif({col}, 'NULL'), 'SEM UF')"


_RULE_COLUMNS = (
    "cod, tipo, sistema, etapa, fator_perc_inf, fator_perc_sup, fator_num_inf, "
    "fator_num_sup, fator_perc_composto, ponto"
)
_MONTH_COUNTS = "count(mes_atual)::BIGINT AS valor,\n           " + ",\n           ".join(
    f"count(mes_{k})::BIGINT AS valor_mes_ant_{k}" for k in range(1, 7)
)


def _alarm_select(source: str, item: str, with_ts: bool) -> str:
    n = ["valor"] + [f"valor_mes_ant_{k}" for k in range(1, 7)]
    ratio = [f"({n[k]}::DOUBLE / NULLIF({n[k + 1]}, 0) - 1)" for k in range(6)]
    mean_var = "abs(" + " + ".join(
        [f"coalesce({ratio[0]}, 0)"] + [f"abs(coalesce({x}, 0))" for x in ratio[1:]]) + ") / 6"
    var_cols = ",\n           ".join(
        f"{_round2(ratio[k - 1])} AS var_mes_ant_{k}, valor_mes_ant_{k}"
        for k in range(1, 7)
    )
    ts = f"{RUN_TS} AS data_alarme,\n           " if with_ts else ""
    zi = "0::INTEGER"
    return f"""
    SELECT tipo_cliente AS segmento,
           'SEM INFO' AS tipo_cliente,
           {item} AS item_alarme,
           {item} AS produto,
           'SEM CLASSIFICACAO' AS tipo_fat,
           {_month(1)} AS periodo,
           valor,
           0.0::DOUBLE AS media_valor,
           {zi} AS media_quant,
           {zi} AS dif_media_valor_x_quant,
           {var_cols},
           {_round2(mean_var)} AS med_var_mes,
           cod, tipo,
           'Fatura Zerada - Patamar' AS assunto,
           'n' AS redutor,
           sistema, etapa,
           {_round2("avg6")} AS media_meses,
           {_round2("low")} AS limite_inferior,
           {_round2("high")} AS limite_superior,
           {zi} AS imp_x_fat_atual,
           {zi} AS imp_x_fat_media,
           fator_perc_inf, fator_perc_sup, fator_num_inf,
           fator_num_sup, fator_perc_composto,
           CASE WHEN valor < low OR valor > high THEN 's' ELSE 'n' END AS flag_alarme,
           CASE WHEN (valor < low) IS NOT TRUE AND valor > high THEN 'Ultrapassou Limite Superior'
                ELSE 'Normal' END AS alarme,
           ponto,
           'Quantidade Fatura' AS referencia_valor,
           'Faturamento - Outros' AS rel_ind_produto,
           'SEM CLASS' AS tecnologia,
           {ts}{zi} AS quant, {zi} AS quant_mes_ant, {zi} AS quant_med,
           {zi} AS limite_inferior_quant, {zi} AS limite_superior_quant,
           {zi} AS fator_perc_inf_quant, {zi} AS fator_perc_sup_quant,
           {zi} AS arpu, {zi} AS arpu_mes_ant,
           'MENSAL' AS periodicidade
    FROM (SELECT *, avg6 - avg6 * fator_perc_inf AS low, avg6 + avg6 * fator_perc_sup AS high
          FROM (SELECT *, ({" + ".join(n[1:])})::DOUBLE / 6 AS avg6 FROM {source}))"""


def _adapter_ctes() -> str:
    """The five logical inputs derived from the test tables (FIXTURES.md)."""
    return f"""
src_customer AS (
    SELECT CASE WHEN c.c_custkey % 20 = 0 THEN c.c_custkey + 1000000000000000 ELSE c.c_custkey END AS account_no,
           CASE WHEN r.r_regionkey = 0 THEN NULL WHEN r.r_regionkey = 1 THEN 'NULL'
                ELSE r.r_name END AS cust_state,
           CASE WHEN c.c_custkey % 33 = 0 THEN NULL
                ELSE CAST(10 + c.c_custkey % 14 AS VARCHAR) END AS account_category
    FROM customer c
    JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey
    UNION ALL
    SELECT CASE WHEN c_custkey % 20 = 0 THEN c_custkey + 1000000000000000 ELSE c_custkey END,
           'ALT_STATE', CAST(10 + c_custkey % 14 AS VARCHAR)
    FROM customer WHERE c_custkey % 17 = 0
),
src_billing AS (
    SELECT o.o_orderdate AS prep_date,
           CASE WHEN l.l_orderkey % 11 = 0 THEN l.l_orderkey + 1000000000000000 ELSE l.l_orderkey END AS bill_ref_no,
           o.o_custkey AS account_no,
           CASE WHEN l.l_returnflag = 'R' THEN CAST(0 AS DECIMAL(18,2))
                ELSE CAST(l.l_extendedprice AS DECIMAL(18,2)) END AS amount,
           CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_tax AS DECIMAL(4,2)) AS DECIMAL(23,4)) AS tax,
           CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_discount AS DECIMAL(4,2)) AS DECIMAL(23,4)) AS discount,
           l.l_linenumber AS type_code,
           CASE WHEN l.l_suppkey % 10 = 0 THEN '0' ELSE '1' END AS prep_status,
           CASE WHEN o.o_orderpriority = '5-LOW' THEN '1' ELSE '0' END AS backout_status,
           CASE WHEN l.l_linestatus = 'O' THEN NULL WHEN l.l_partkey % 10 = 3 THEN 7 ELSE 0 END AS prep_error_code
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
src_tax_1 AS ({_tax_source(1)}
),
src_tax_2 AS ({_tax_source(2)}
),
src_rules AS (
    SELECT * FROM (VALUES
    {_rules_values()}
    ) AS t(cod, campo, tipo_cliente, chave, tipo, sistema, etapa, ponto,
           fator_perc_inf, fator_perc_sup, fator_num_inf, fator_num_sup, fator_perc_composto)
)
"""


def _stage_ctes() -> str:
    """The job's stages over ``src_customer src_billing src_tax_1 src_tax_2 src_rules``."""
    pivot = ",\n           ".join(
        f"max(sum_amount) FILTER (WHERE prep_date = {_month(off)}) AS {name}"
        for name, off in [(f"mes_{k}", k + 1) for k in range(6, 0, -1)] + [("mes_atual", 1)]
    )
    segments = ", ".join(
        f"('{code}', '{name}')" for codes, name in (
            (("12", "13", "14", "15", "21", "22"), "B2B"),
            (("17", "18", "19", "20"), "CONTAS N FATURAVEIS"),
            (("16",), "USO PROPRIO"),
        ) for code in codes
    )
    return f"""
segment_codes AS (
    SELECT * FROM (VALUES {segments}) AS v(code, segment_name)
),
customer_seg AS (
    SELECT c.account_no, c.cust_state, coalesce(s.segment_name, 'B2C') AS tipo_cliente,
           count(*)::BIGINT AS qtde
    FROM src_customer c LEFT JOIN segment_codes s ON c.account_category = s.code
    GROUP BY ALL
),
billing_month AS (
    SELECT strftime(prep_date, '%Y%m') AS prep_date, bill_ref_no, account_no,
           sum(amount)::DECIMAL(28,2) AS sum_amount,
           sum(tax)::DECIMAL(33,4) AS sum_tax,
           sum(discount)::DECIMAL(33,4) AS sum_discount
    FROM src_billing
    WHERE prep_status = '1' AND backout_status = '0'
      AND type_code IN (2, 3, 6, 7)
      AND coalesce(prep_error_code, 0) = 0
      AND strftime(prep_date, '%Y%m') BETWEEN {_month(7)} AND {_month(1)}
    GROUP BY ALL
),
invoice_tax AS ({_system_tax(2)}
    UNION ALL{_system_tax(1)}
),
billing_tax AS (
    SELECT b.prep_date, b.bill_ref_no, b.account_no, b.sum_amount,
           coalesce(t.tax, 0)::DECIMAL(29,2) AS sum_tax, b.sum_discount
    FROM billing_month b LEFT JOIN invoice_tax t USING (bill_ref_no)
),
enriched AS (
    SELECT b.prep_date, b.bill_ref_no, b.account_no, c.cust_state, c.tipo_cliente,
           b.sum_amount, b.sum_tax, b.sum_discount
    FROM billing_tax b LEFT JOIN customer_seg c ON b.account_no = c.account_no
),
zero_inv AS (
    SELECT * FROM enriched WHERE sum_amount = 0
),
counter AS (
    SELECT coalesce(tipo_cliente, 'B2C') AS tipo_cliente, cust_state, bill_ref_no,
           {pivot},
           count(*)::BIGINT AS qtde
    FROM zero_inv
    GROUP BY zero_inv.tipo_cliente, cust_state, bill_ref_no
),
scoped_rules AS (
    SELECT * FROM src_rules WHERE cod BETWEEN 'PAT0501401' AND 'PAT0501700'
),
state_groups AS (
    SELECT k.tipo_cliente, k.cust_state, {_RULE_COLUMNS},
           {_MONTH_COUNTS}
    FROM counter k
    LEFT JOIN (SELECT * FROM scoped_rules WHERE campo = 'ESTADO') r
      ON r.tipo_cliente = k.tipo_cliente AND r.chave = {_shown_state("k.cust_state")}
    GROUP BY k.tipo_cliente, k.cust_state, {_RULE_COLUMNS}
),
period_groups AS (
    SELECT k.tipo_cliente, {_RULE_COLUMNS},
           {_MONTH_COUNTS}
    FROM counter k
    LEFT JOIN (SELECT * FROM scoped_rules WHERE campo = 'PERIODO') r
      ON r.tipo_cliente = k.tipo_cliente
    GROUP BY k.tipo_cliente, {_RULE_COLUMNS}
),
state_alarms AS ({_alarm_select("state_groups", _shown_state("cust_state"), False)}
),
period_alarms AS ({_alarm_select("period_groups", "'PERIODO'", False)}
),
all_alarms AS (
    SELECT * FROM state_alarms UNION ALL SELECT * FROM period_alarms
),
state_alarms_ts AS ({_alarm_select("state_groups", _shown_state("cust_state"), True)}
),
period_alarms_ts AS ({_alarm_select("period_groups", "'PERIODO'", True)}
)
"""


def _latest(system: int, billed: bool) -> str:
    semi = (
        " AND a.bill_ref_no IN (SELECT bill_ref_no FROM src_billing)" if billed else ""
    )
    return f"""
    SELECT CAST({system} AS INTEGER) AS system, a.bill_ref_no, a.tax_type_code, a.federal_tax, a.dt_foto
    FROM src_tax_{system} a
    WHERE a.dt_foto = (SELECT max(dt_foto) FROM src_tax_{system}){semi}"""


_COUNTS_OUT = _RULE_COLUMNS + ", valor, " + ", ".join(f"valor_mes_ant_{k}" for k in range(1, 7))

_ALARM_KEY = "segmento, item_alarme, cod"

_FINAL = {
    "q01_customer_segments": "SELECT * FROM customer_seg",
    "q02_monthly_billing": "SELECT * FROM billing_month",
    "q03_latest_snapshot": _latest(2, False) + " UNION ALL " + _latest(1, False),
    "q04_billed_tax_lines": _latest(2, True) + " UNION ALL " + _latest(1, True),
    "q05_invoice_tax": "SELECT * FROM invoice_tax",
    "q06_billing_with_tax": "SELECT * FROM billing_tax",
    "q07_enriched_invoices": "SELECT * FROM enriched",
    "q08_zero_invoices": "SELECT * FROM zero_inv",
    "q09_zero_by_segment": """
    SELECT coalesce(tipo_cliente, 'B2C') AS tipo_cliente,
           count(*)::BIGINT AS n_rows,
           count(DISTINCT bill_ref_no)::BIGINT AS n_invoices
    FROM zero_inv GROUP BY ALL""",
    "q10_zero_counter": "SELECT * FROM counter",
    "q12_state_counts": f"SELECT tipo_cliente, cust_state, {_COUNTS_OUT} FROM state_groups",
    "q13_period_counts": f"SELECT tipo_cliente, {_COUNTS_OUT} FROM period_groups",
    "q14_state_alarms": "SELECT * FROM state_alarms",
    "q15_period_alarms": "SELECT * FROM period_alarms",
    "q16_all_alarms": "SELECT * FROM all_alarms",
    "q17_state_key": f"""
    SELECT cust_state, {_shown_state("cust_state")} AS state_key, count(*)::BIGINT AS n_rows
    FROM src_customer GROUP BY cust_state""",
    "q18_month_window": f"""
    SELECT month AS prep_date, count(*)::BIGINT AS n_lines, month = {_month(1)} AS is_period
    FROM (SELECT strftime(prep_date, '%Y%m') AS month FROM src_billing
          WHERE prep_status = '1' AND backout_status = '0' AND type_code IN (2, 3, 6, 7)
            AND coalesce(prep_error_code, 0) = 0
            AND strftime(prep_date, '%Y%m') BETWEEN {_month(7)} AND {_month(1)})
    GROUP BY month""",
    "q19_month_variation": f"""
    SELECT {_ALARM_KEY}, valor,
           valor_mes_ant_1, var_mes_ant_1, valor_mes_ant_2, var_mes_ant_2,
           valor_mes_ant_3, var_mes_ant_3, valor_mes_ant_4, var_mes_ant_4,
           valor_mes_ant_5, var_mes_ant_5, valor_mes_ant_6, var_mes_ant_6
    FROM all_alarms""",
    "q20_mean_variation": f"""
    SELECT {_ALARM_KEY}, var_mes_ant_1, var_mes_ant_2, var_mes_ant_3, var_mes_ant_4,
           var_mes_ant_5, var_mes_ant_6, med_var_mes
    FROM all_alarms""",
    "q21_level_limits": f"""
    SELECT {_ALARM_KEY}, valor, media_meses, limite_inferior, limite_superior,
           fator_perc_inf, fator_perc_sup
    FROM all_alarms""",
    "q22_alarm_flag_label": """
    SELECT grain, flag_alarme, alarme, rule_matched, CAST(count(*) AS BIGINT) AS n_rows
    FROM (SELECT 'ESTADO' AS grain, flag_alarme, alarme, cod IS NOT NULL AS rule_matched
          FROM state_alarms
          UNION ALL
          SELECT 'PERIODO', flag_alarme, alarme, cod IS NOT NULL FROM period_alarms) x
    GROUP BY 1, 2, 3, 4""",
    "q23_orc_roundtrip": "SELECT * FROM zero_inv",
    "q24_alarm_append": "SELECT * FROM state_alarms_ts UNION ALL SELECT * FROM period_alarms_ts",
    "q25_kept_table_refresh": """
    SELECT *, 'orc' AS provider, 'SNAPPY' AS orc_compress, 'false' AS transactional FROM zero_inv""",
    "q26_alarm_insert_into": "SELECT * FROM state_alarms_ts UNION ALL SELECT * FROM period_alarms_ts",
    "q27_run_month_kept": "SELECT * FROM zero_inv",
    "q28_run_month_alarms": "SELECT * FROM state_alarms_ts UNION ALL SELECT * FROM period_alarms_ts",
    "q29_default_format_table": """
    SELECT *, 'orc' AS provider FROM invoice_tax UNION ALL SELECT *, 'parquet' FROM invoice_tax""",
    "q30_stored_layout_billing": f"""
    SELECT strftime(o_orderdate, '%Y%m') AS prep_date,
           CASE WHEN l_linenumber % 2 = 0 THEN lpad(CAST(l_orderkey AS VARCHAR), 20, '0')
                ELSE CAST(l_orderkey AS VARCHAR) END AS bill_ref_no,
           o_custkey AS account_no,
           sum(amount)::DECIMAL(30,4) AS sum_amount,
           sum(sign * price * CAST(l_tax AS DECIMAL(4,2)))::DECIMAL(33,4) AS sum_tax,
           sum(sign * price * CAST(l_discount AS DECIMAL(4,2)))::DECIMAL(33,4) AS sum_discount,
           sum(amount) = 0 AS is_zero
    FROM (
        SELECT l.*, o.*, sign, CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
               CASE WHEN l_returnflag = 'A' AND l_partkey % 3 = 0 THEN NULL
                    WHEN l_returnflag <> 'R' AND l_partkey % 7 = 0 THEN CAST(0.0040 AS DECIMAL(20,4))
                    ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) * sign AS DECIMAL(20,4)) END AS amount
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN (VALUES (1), (-1)) s(sign) ON sign = 1 OR l_returnflag = 'R'
    )
    WHERE strftime(o_orderdate, '%Y%m') BETWEEN {_month(7)} AND {_month(1)}
      AND l_suppkey % 10 <> 0 AND o_orderpriority <> '5-LOW'
      AND l_linenumber IN (2, 3, 6, 7) AND l_partkey % 5 <> 0
      AND (l_linestatus = 'O' OR l_partkey % 10 <> 3)
    GROUP BY 1, 2, 3""",
}


def oracle_sql() -> dict[str, str]:
    """Every registered query over the raw test tables."""
    prelude = "\nWITH" + _adapter_ctes() + ",\n" + _stage_ctes()
    return {name: prelude + body for name, body in _FINAL.items()}


def stage_sql(name: str, run_date=None) -> str:
    """One query over already-registered logical inputs (``src_*`` tables),
    optionally for another run date (a ``datetime.date``)."""
    sql = "\nWITH " + _stage_ctes() + _FINAL[name]
    if run_date is not None:
        sql = sql.replace(RUN_DATE, f"DATE '{run_date.isoformat()}'")
    return sql
