"""Column expressions: segment, state key, tax default, ratios, limits, flags."""

import decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from zerobill.functions import (
    alarm_flag,
    alarm_label,
    level_lower,
    level_upper,
    mean_variation,
    segment,
    six_month_mean,
    state_key,
    tax_or_zero,
    variation,
)


def _one(spark, col, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(col).collect()]


def test_segment_codes(spark):
    cats = [("12",), ("13",), ("14",), ("15",), ("21",), ("22",), ("17",), ("18",), ("19",),
            ("20",), ("16",), ("11",), ("23",), (None,), ("",)]
    out = _one(spark, segment("c"), cats, "c string")
    assert out == ["B2B"] * 6 + ["CONTAS N FATURAVEIS"] * 4 + ["USO PROPRIO"] + ["B2C"] * 4


def test_segment_on_numeric_codes(spark):
    out = _one(spark, segment("c"), [(12,), (16,), (18,), (99,), (None,)], "c int")
    assert out == ["B2B", "USO PROPRIO", "CONTAS N FATURAVEIS", "B2C", "B2C"]


def test_state_key(spark):
    out = _one(spark, state_key("s"), [(None,), ("NULL",), ("SEM UF",), ("ASIA",), ("null",)], "s string")
    assert out == ["SEM UF", "SEM UF", "SEM UF", "ASIA", "null"]


def test_tax_or_zero(spark):
    schema = T.StructType([T.StructField("t", T.DecimalType(29, 2))])
    out = _one(spark, tax_or_zero("t"), [(None,), (decimal.Decimal("1.50"),)], schema)
    assert out == [decimal.Decimal("0.00"), decimal.Decimal("1.50")]


def test_variation_division_by_zero_is_null(spark):
    df = spark.createDataFrame([(3, 0), (0, 0), (3, 2), (1, 8)], "a long, b long")
    out = [r[0] for r in df.select(F.round(variation("a", "b"), 2)).collect()]
    assert out == [None, None, 0.5, -0.88]


def test_round_is_half_up_on_both_signs(spark):
    df = spark.createDataFrame([(0.125,), (-0.125,), (1.005,)], "x double")
    assert [r[0] for r in df.select(F.round("x", 2)).collect()] == [0.13, -0.13, 1.01]


def test_mean_variation_first_term_signed(spark):
    # Trap 4: v1 = -0.5, v2 = +0.5, others 0 -> 0.0 (only the outer abs covers v1)
    df = spark.createDataFrame([(-0.5, 0.5, 0.0, 0.0, 0.0, 0.0)], "v1 double, v2 double, v3 double, v4 double, v5 double, v6 double")
    out = df.select(mean_variation([F.col(f"v{k}") for k in range(1, 7)])).first()[0]
    assert out == 0.0
    # with the sign flipped the terms add up: |0.5 + 0.5| / 6
    df2 = spark.createDataFrame([(0.5, 0.5, None, 0.0, 0.0, 0.0)], "v1 double, v2 double, v3 double, v4 double, v5 double, v6 double")
    assert df2.select(mean_variation([F.col(f"v{k}") for k in range(1, 7)])).first()[0] == 0.17


def _limits(spark, current, history, inf, sup):
    df = spark.createDataFrame(
        [(current, *history, inf, sup)],
        "c0 long, c1 long, c2 long, c3 long, c4 long, c5 long, c6 long, inf double, sup double",
    )
    m = six_month_mean([F.col(f"c{k}") for k in range(1, 7)])
    lo, hi = level_lower(m, "inf"), level_upper(m, "sup")
    return df.select(
        F.round(m, 2), F.round(lo, 2), F.round(hi, 2),
        alarm_flag(F.col("c0"), lo, hi), alarm_label(F.col("c0"), lo, hi),
    ).first()


def test_flag_below_is_flagged_but_normal(spark):
    # Trap 1: mean 10, limits 9 and 11
    assert tuple(_limits(spark, 8, [10] * 6, 0.1, 0.1)) == (10.0, 9.0, 11.0, "s", "Normal")


def test_flag_above(spark):
    assert tuple(_limits(spark, 12, [10] * 6, 0.1, 0.1))[3:] == ("s", "Ultrapassou Limite Superior")


def test_flag_uses_unrounded_strict_limits(spark):
    # Trap 2: a count equal to a limit is not a breach
    assert tuple(_limits(spark, 11, [10] * 6, 0.1, 0.1))[3:] == ("n", "Normal")
    assert tuple(_limits(spark, 9, [10] * 6, 0.1, 0.1))[3:] == ("n", "Normal")
    # mean 1/6: lower limit 0.15 (rounded) but 0 < 0.15 -> flagged on the raw value
    row = _limits(spark, 0, [1, 0, 0, 0, 0, 0], 0.1, 0.1)
    assert row[0] == 0.17 and row[1] == 0.15 and row[3] == "s"


def test_flag_without_rule(spark):
    # Trap 3: no rule -> NULL factors -> NULL limits -> 'n' / 'Normal'
    row = _limits(spark, 100, [1] * 6, None, None)
    assert row[1] is None and row[2] is None and tuple(row)[3:] == ("n", "Normal")


def test_history_zero_current_positive(spark):
    # Trap 11: mean 0, limits 0, current 1 -> above
    assert tuple(_limits(spark, 1, [0] * 6, 0.1, 0.1)) == (0.0, 0.0, 0.0, "s", "Ultrapassou Limite Superior")
