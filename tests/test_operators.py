"""Operators on inline frames, one test per trap of SURVEY 2.10."""

import datetime as dt
from decimal import Decimal

from frames import billing_row, rule_row, sources, tax_row

from zerobill.operators import alarm as A
from zerobill.plans.job import AlarmPlan
from zerobill.run import FIXTURE_RUN

CTX = FIXTURE_RUN  # window 200101..200107, current month 200107


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_line_filters_and_window(spark):
    billing = [
        billing_row("200107", 1, 10, 5),
        billing_row("200107", 1, 10, 7),                    # same invoice: summed
        billing_row("200107", 2, 10, 5, type_code=1),       # type not kept
        billing_row("200107", 3, 10, 5, prep_status="0"),   # not posted
        billing_row("200107", 4, 10, 5, backout_status="1"),
        billing_row("200107", 5, 10, 5, prep_error_code=7),
        billing_row("200107", 6, 10, 5, prep_error_code=None),  # NULL error is fine
        billing_row("200012", 7, 10, 5, day=31),            # before the window
        billing_row("200108", 8, 10, 5, day=1),             # run month: excluded
        billing_row("200101", 9, 10, 5, day=1),             # first day of window
    ]
    plan = AlarmPlan(sources(spark, billing=billing), CTX)
    got = _rows(plan.monthly_billing, "prep_date", "bill_ref_no", "sum_amount")
    assert got == [("200101", 9, Decimal("5.00")), ("200107", 1, Decimal("12.00")),
                   ("200107", 6, Decimal("5.00"))]


def test_zero_means_exact_zero_sum(spark):
    # Trap 8: +10 and -10 kept; all-NULL dropped; 0.10 + 0.20 - 0.30 kept
    billing = [
        billing_row("200107", 1, 10, 10), billing_row("200107", 1, 10, -10),
        billing_row("200107", 2, 10, None), billing_row("200107", 2, 10, None),
        billing_row("200107", 3, 10, "0.10"), billing_row("200107", 3, 10, "0.20"),
        billing_row("200107", 3, 10, "-0.30"),
        billing_row("200107", 4, 10, "0.01"),
    ]
    plan = AlarmPlan(sources(spark, billing=billing), CTX)
    assert _rows(plan.zero_invoices, "bill_ref_no") == [(1,), (3,)]


def test_tax_fan_out_absorbed_by_counter(spark):
    # Trap 6a: invoice in both tax systems -> two kept rows, one counter row (qtde 2)
    billing = [billing_row("200107", 1, 10, 0)]
    plan = AlarmPlan(
        sources(spark, customers=[(10, "SP", "12")], billing=billing,
                tax1=[tax_row(1, 150)], tax2=[tax_row(1, 250)]),
        CTX,
    )
    assert _rows(plan.zero_invoices, "bill_ref_no", "sum_tax") == [
        (1, Decimal("1.50")), (1, Decimal("2.50"))]
    counter = plan.zero_counter.collect()
    assert len(counter) == 1 and counter[0]["qtde"] == 2 and counter[0]["mes_atual"] == 0
    assert plan.alarm_counter.count() == 1


def test_customer_fan_out_counts_twice_at_period_grain(spark):
    # Trap 6b: one account in two states counts its invoice once per state
    billing = [billing_row("200107", 1, 10, 0)]
    plan = AlarmPlan(
        sources(spark, customers=[(10, "SP", "12"), (10, "RJ", "12")], billing=billing), CTX)
    state = plan.grain_alarms(A.GRAIN_STATE)
    period = plan.grain_alarms(A.GRAIN_PERIOD)
    assert _rows(state, "item_alarme", "valor") == [("RJ", 1), ("SP", 1)]
    assert _rows(period, "segmento", "valor") == [("B2B", 2)]


def test_raw_state_grouping_shows_same_label(spark):
    # Trap 5: NULL, 'NULL' and 'SEM UF' -> three rows, all shown as SEM UF
    billing = [billing_row("200107", b, b, 0) for b in (1, 2, 3)]
    customers = [(1, None, "12"), (2, "NULL", "12"), (3, "SEM UF", "12")]
    plan = AlarmPlan(sources(spark, customers=customers, billing=billing), CTX)
    state = plan.grain_alarms(A.GRAIN_STATE)
    assert _rows(state, "segmento", "item_alarme", "valor") == [("B2B", "SEM UF", 1)] * 3


def test_unmatched_account_defaults_to_b2c_and_merges(spark):
    # Counter keeps NULL and 'B2C' apart; the alarm groups merge them.
    billing = [billing_row("200107", 1, 99, 0), billing_row("200107", 2, 5, 0)]
    plan = AlarmPlan(sources(spark, customers=[(5, None, "11")], billing=billing), CTX)
    assert _rows(plan.zero_counter, "tipo_cliente", "bill_ref_no") == [("B2C", 1), ("B2C", 2)]
    state = plan.grain_alarms(A.GRAIN_STATE)
    assert _rows(state, "segmento", "item_alarme", "valor") == [("B2C", "SEM UF", 2)]


def test_same_invoice_null_and_b2c_segment_counts_twice(spark):
    # Same invoice number under an unmatched account and a B2C account: two counter
    # rows (raw grouping), both counted in the merged B2C / SEM UF group.
    billing = [billing_row("200107", 1, 99, 0), billing_row("200107", 1, 5, 0)]
    plan = AlarmPlan(sources(spark, customers=[(5, None, "11")], billing=billing), CTX)
    assert plan.zero_counter.count() == 2
    state = plan.grain_alarms(A.GRAIN_STATE)
    assert _rows(state, "segmento", "valor") == [("B2C", 2)]


def test_duplicate_rules_double_counts(spark):
    # Trap 7: two identical rules -> counts doubled in one row
    billing = [billing_row("200107", b, 10, 0) for b in (1, 2)]
    rules = [rule_row("PAT0501501", "PERIODO", "B2B", "PERIODO")] * 2
    plan = AlarmPlan(sources(spark, customers=[(10, "SP", "12")], billing=billing, rules=rules), CTX)
    period = plan.grain_alarms(A.GRAIN_PERIOD)
    assert _rows(period, "cod", "valor") == [("PAT0501501", 4)]


def test_distinct_rules_one_row_each_and_decoys_ignored(spark):
    billing = [billing_row("200107", 1, 10, 0)]
    rules = [
        rule_row("PAT0501501", "PERIODO", "B2B", "PERIODO"),
        rule_row("PAT0501502", "PERIODO", "B2B", "PERIODO", 0.25, 0.05),
        rule_row("PAT0501701", "PERIODO", "B2B", "PERIODO"),   # out of code range
        rule_row("PAT0501400", "ESTADO", "B2B", "SP"),         # out of code range
        rule_row("PAT0501600", "CIDADE", "B2B", "SP"),         # other scope
        rule_row("PAT0501401", "ESTADO", "B2B", "SP"),
    ]
    plan = AlarmPlan(sources(spark, customers=[(10, "SP", "12")], billing=billing, rules=rules), CTX)
    alarms = plan.all_alarms()
    assert _rows(alarms, "item_alarme", "cod") == [
        ("PERIODO", "PAT0501501"), ("PERIODO", "PAT0501502"), ("SP", "PAT0501401")]


def test_month_columns_and_counts(spark):
    # history 1 zero invoice per month for 6 months, current month 3 -> above limit
    billing = [billing_row(m, i, 10, 0) for i, m in enumerate(
        ["200101", "200102", "200103", "200104", "200105", "200106"])]
    billing += [billing_row("200107", 100 + i, 10, 0) for i in range(3)]
    rules = [rule_row("PAT0501401", "ESTADO", "B2B", "SP")]
    plan = AlarmPlan(sources(spark, customers=[(10, "SP", "12")], billing=billing, rules=rules), CTX)
    row = plan.grain_alarms(A.GRAIN_STATE).first()
    assert row["valor"] == 3
    assert [row[f"valor_mes_ant_{k}"] for k in range(1, 7)] == [1] * 6
    assert row["var_mes_ant_1"] == 2.0 and row["var_mes_ant_2"] == 0.0
    assert row["media_meses"] == 1.0 and row["limite_inferior"] == 0.9 and row["limite_superior"] == 1.1
    assert row["flag_alarme"] == "s" and row["alarme"] == "Ultrapassou Limite Superior"
    assert row["med_var_mes"] == 0.33
    assert row["periodo"] == "200107" and row["assunto"] == "Fatura Zerada - Patamar"


def test_group_without_zero_invoice_has_no_alarm(spark):
    # Trap 11b: no gap filling
    billing = [billing_row("200107", 1, 10, 5)]
    plan = AlarmPlan(sources(spark, customers=[(10, "SP", "12")], billing=billing), CTX)
    assert plan.all_alarms().count() == 0


def test_latest_snapshot_without_qualifying_lines(spark):
    # Trap 15: system 1's newest snapshot only has non-qualifying lines -> nothing
    new, old = dt.date(2001, 8, 31), dt.date(2001, 7, 31)
    tax1 = [tax_row(1, 500, old), tax_row(1, 0, new), tax_row(1, 300, new, code=4000000)]
    tax2 = [tax_row(1, 100, new), tax_row(1, 120, new, code=1000000), tax_row(1, 999, old),
            tax_row(2, 100, new)]  # invoice 2 was never billed
    billing = [billing_row("199901", 1, 10, 3, day=1)]  # billed, but outside the window
    plan = AlarmPlan(sources(spark, billing=billing, tax1=tax1, tax2=tax2), CTX)
    assert _rows(plan.invoice_tax, "bill_ref_no", "tax") == [(1, Decimal("2.20"))]


def test_tax_is_rounded_sum_of_cents(spark):
    tax2 = [tax_row(1, "12.5"), tax_row(1, "0.01")]
    billing = [billing_row("200107", 1, 10, 0)]
    plan = AlarmPlan(sources(spark, billing=billing, tax2=tax2), CTX)
    assert _rows(plan.invoice_tax, "tax") == [(Decimal("0.13"),)]
    assert _rows(plan.billing_with_tax, "sum_tax") == [(Decimal("0.13"),)]


def test_missing_tax_is_zero(spark):
    billing = [billing_row("200107", 1, 10, 4)]
    plan = AlarmPlan(sources(spark, billing=billing), CTX)
    assert _rows(plan.billing_with_tax, "sum_tax") == [(Decimal("0.00"),)]


def test_rule_scope_is_an_inclusive_code_range_per_field(spark):
    rules = [
        rule_row("PAT0501400", "ESTADO", "B2B", "SP"),
        rule_row("PAT0501401", "ESTADO", "B2B", "SP"),
        rule_row("PAT0501700", "ESTADO", "B2B", "SP"),
        rule_row("PAT0501701", "ESTADO", "B2B", "SP"),
        rule_row("PAT0501550", "PERIODO", "B2B", "PERIODO"),
        rule_row("PAT050140", "ESTADO", "B2B", "SP"),       # text order: below the range
        rule_row("PAT0501699X", "ESTADO", "B2B", "SP"),     # text order: inside the range
    ]
    factor = sources(spark, rules=rules).alarm_factor
    assert _rows(A.rules(factor, A.SCOPE_STATE), "cod") == [
        ("PAT0501401",), ("PAT0501699X",), ("PAT0501700",)]
    assert _rows(A.rules(factor, A.SCOPE_PERIOD), "cod") == [("PAT0501550",)]
