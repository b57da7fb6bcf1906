"""Adapter from the driver's TPC-H-like test tables to the five logical inputs.

The mapping is fixed by FIXTURES.md and is mirrored expression for expression
by the DuckDB oracle (``zerobill.oracle``). Every row of ``customer``, of
``lineitem`` and of ``lineitem`` with its order enters an input. The modulo
rules below drop nothing; they give a row its role: a customer or an invoice
moved to a number that nothing else refers to (so the orders of that customer
have no customer row, and the tax of that order no invoice), a second state
for one account, and so on. So all the edge cases of the job appear in data of
any size.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zerobill import schemas
from zerobill.sources import Sources
from zerobill.sources.catalog import conform

# ---------------------------------------------------------------------------
# Fixed values of the fixture (FIXTURES.md section 2).
# ---------------------------------------------------------------------------
EXTRA_STATE = "ALT_STATE"
# numbers above every key of the test tables, at any scale
UNREFERENCED = 10**15
TAX_TYPE_STEP = 700000
OLD_SNAPSHOT = dt.date(2001, 7, 31)
NEW_SNAPSHOT = dt.date(2001, 8, 31)
RULE_TIPO = "Patamar"
RULE_SISTEMA = "Faturamento"
RULE_ETAPA = "Fatura"
RULE_PONTO = "Fatura Zerada"
STATE_RULE_SEGMENTS = ("B2B", "B2C", "CONTAS N FATURAVEIS")
STATE_RULE_KEYS = ("SEM UF", "ASIA", "EUROPE", "MIDDLE EAST")
# (cod, campo, segment, key, fator_perc_inf, fator_perc_sup)
PERIOD_RULES = (
    ("PAT0501501", "PERIODO", "B2B", "PERIODO", 0.25, 0.25),
    ("PAT0501502", "PERIODO", "B2B", "PERIODO", 0.25, 0.05),
    ("PAT0501503", "PERIODO", "B2C", "PERIODO", 0.25, 0.25),
    ("PAT0501504", "PERIODO", "CONTAS N FATURAVEIS", "PERIODO", 0.25, 0.25),
    ("PAT0501505", "PERIODO", "USO PROPRIO", "PERIODO", 0.25, 0.25),
)
DECOY_RULES = (
    ("PAT0501400", "ESTADO", "B2B", "ASIA", 0.50, 0.50),
    ("PAT0501701", "PERIODO", "B2B", "PERIODO", 0.50, 0.50),
    ("PAT0501600", "CIDADE", "B2B", "ASIA", 0.50, 0.50),
)
# ---------------------------------------------------------------------------


# Columns the adapter reads from each test table, with their stored types.
# Declaring them (as a catalog would) avoids a schema-inference job per file
# and prunes every other column at the scan.
TEST_TABLE_COLUMNS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_nationkey INT",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
        "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
        "l_linestatus STRING"
    ),
}


class DriverTables:
    """The driver's parquet tables in one folder, each opened once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            reader = self.spark.read
            if name in TEST_TABLE_COLUMNS:
                reader = reader.schema(TEST_TABLE_COLUMNS[name])
            self._frames[name] = reader.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._frames[name]


def _money(c: Column) -> Column:
    return c.cast(T.DecimalType(18, 2))


def _rate(c: Column) -> Column:
    return c.cast(T.DecimalType(4, 2))


def _moved(key: Column, every: int) -> Column:
    """Each ``every``-th key moves to a number that no other table refers to."""
    return F.when(key % every == 0, key + F.lit(UNREFERENCED)).otherwise(key)


def _category(custkey: Column) -> Column:
    return (F.lit(10) + custkey % 14).cast(T.StringType())


def customer(tables: DriverTables) -> DataFrame:
    c = tables["customer"].select("c_custkey", "c_nationkey")
    n = tables["nation"].select("n_nationkey", "n_regionkey")
    r = tables["region"].select("r_regionkey", "r_name")
    key = F.col("c_custkey")
    base = (
        c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            _moved(key, 20).alias("account_no"),
            F.when(F.col("r_regionkey") == 0, F.lit(None).cast("string"))
            .when(F.col("r_regionkey") == 1, F.lit("NULL"))
            .otherwise(F.col("r_name"))
            .alias("cust_state"),
            F.when(key % 33 == 0, F.lit(None).cast("string"))
            .otherwise(_category(key))
            .alias("account_category"),
        )
    )
    extra = c.filter(key % 17 == 0).select(
        _moved(key, 20).alias("account_no"),
        F.lit(EXTRA_STATE).alias("cust_state"),
        _category(key).alias("account_category"),
    )
    return conform(base.unionByName(extra), schemas.CUSTOMER, "customer")


def billing_line(tables: DriverTables) -> DataFrame:
    line = tables["lineitem"]
    orders = tables["orders"].select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"
    )
    price = _money(F.col("l_extendedprice"))
    joined = line.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    out = joined.select(
        F.col("o_orderdate").alias("prep_date"),
        _moved(F.col("l_orderkey"), 11).alias("bill_ref_no"),
        F.col("o_custkey").alias("account_no"),
        F.when(F.col("l_returnflag") == "R", _money(F.lit(0)))
        .otherwise(price)
        .alias("amount"),
        (price * _rate(F.col("l_tax"))).alias("tax"),
        (price * _rate(F.col("l_discount"))).alias("discount"),
        F.col("l_linenumber").alias("type_code"),
        F.when(F.col("l_suppkey") % 10 == 0, "0").otherwise("1").alias("prep_status"),
        F.when(F.col("o_orderpriority") == "5-LOW", "1").otherwise("0").alias("backout_status"),
        F.when(F.col("l_linestatus") == "O", F.lit(None).cast("int"))
        .when(F.col("l_partkey") % 10 == 3, F.lit(7))
        .otherwise(F.lit(0))
        .alias("prep_error_code"),
    )
    return conform(out, schemas.BILLING_LINE, "billing_line")


def stored_billing(tables: DriverTables) -> DataFrame:
    """Billing lines as another system might store them: dates and invoice
    numbers as text (every second line of an order under a number with leading
    zeros, which is another invoice), signed amounts of four decimals, codes
    as decimals, statuses as numbers.

    Returned lines come twice, charged and credited, and cancel exactly; some
    amounts are NULL, some 0.0040, which two decimals would take for zero.
    """
    price, key = _money(F.col("l_extendedprice")), F.col("l_orderkey").cast("string")
    sign = F.col("sign").cast(T.DecimalType(1, 0))
    lines = tables["lineitem"].withColumn("sign", F.explode(F.when(F.col("l_returnflag") == "R", F.array(F.lit(1), F.lit(-1))).otherwise(F.array(F.lit(1)))))
    amount = (
        F.when((F.col("l_returnflag") == "A") & (F.col("l_partkey") % 3 == 0), F.lit(None))
        .when((F.col("l_returnflag") != "R") & (F.col("l_partkey") % 7 == 0), F.lit("0.0040").cast(T.DecimalType(20, 4)))
        .otherwise((price * _rate(F.col("l_discount")) * sign).cast(T.DecimalType(20, 4)))
    )
    joined = lines.join(tables["orders"].select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("prep_date"),
        F.when(F.col("l_linenumber") % 2 == 0, F.lpad(key, 20, "0")).otherwise(key).alias("bill_ref_no"),
        F.col("o_custkey").alias("account_no"),
        amount.alias("amount"),
        (price * _rate(F.col("l_tax")) * sign).cast(T.DecimalType(23, 4)).alias("tax"),
        (price * _rate(F.col("l_discount")) * sign).cast(T.DecimalType(23, 4)).alias("discount"),
        (F.col("l_linenumber").cast(T.DecimalType(4, 1)) + F.when(F.col("l_partkey") % 5 == 0, F.lit("0.7")).otherwise("0.0").cast(T.DecimalType(4, 1)))
        .cast(T.DecimalType(4, 1))
        .alias("type_code"),
        F.when(F.col("l_suppkey") % 10 == 0, 0).otherwise(1).alias("prep_status"),
        F.when(F.col("o_orderpriority") == "5-LOW", "1").otherwise("0").alias("backout_status"),
        F.when(F.col("l_linestatus") == "O", F.lit(None).cast("bigint")).when(F.col("l_partkey") % 10 == 3, F.lit(7)).otherwise(F.lit(0)).cast("bigint").alias("prep_error_code"),
    )


def tax_line(tables: DriverTables, system: int) -> DataFrame:
    line = tables["lineitem"]
    price = _money(F.col("l_extendedprice"))
    out = line.filter(F.col("l_suppkey") % 2 == system % 2).select(
        F.col("l_orderkey").alias("bill_ref_no"),
        (F.col("l_linenumber") * TAX_TYPE_STEP).alias("tax_type_code"),
        _money(price * _rate(F.col("l_tax")) * F.lit(100)).alias("federal_tax"),
        F.when(F.col("l_partkey") % 5 == 0, F.lit(OLD_SNAPSHOT))
        .otherwise(F.lit(NEW_SNAPSHOT))
        .alias("dt_foto"),
    )
    return conform(out, schemas.TAX_LINE, f"tax_line_{system}")


def alarm_factor_rows() -> list[tuple]:
    """The 20 rule rows of the fixture, in FIXTURES.md order."""
    specs = []
    code = 401
    for seg in STATE_RULE_SEGMENTS:
        for key in STATE_RULE_KEYS:
            specs.append((f"PAT0501{code}", "ESTADO", seg, key, 0.10, 0.10))
            code += 1
    specs.extend(PERIOD_RULES)
    specs.extend(DECOY_RULES)
    return [
        (cod, campo, seg, key, RULE_TIPO, RULE_SISTEMA, RULE_ETAPA, RULE_PONTO,
         inf, sup, 0.0, 0.0, 0.0)
        for cod, campo, seg, key, inf, sup in specs
    ]


def _sql_literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(value)


def inline_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A small constant table as a SQL ``VALUES`` list: planned as a local
    relation with exact statistics, so the planner knows it is tiny."""
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in row) + ")" for row in rows)
    names = ", ".join(f.name for f in schema.fields)
    table = spark.sql(f"SELECT * FROM VALUES {values} AS t({names})")
    return conform(table, schema, "inline table")


def alarm_factor(spark: SparkSession) -> DataFrame:
    return inline_table(spark, alarm_factor_rows(), schemas.ALARM_FACTOR)


def fixture_sources(spark: SparkSession, sf_dir: str) -> Sources:
    tables = DriverTables(spark, sf_dir)
    return Sources(
        customer=customer(tables),
        billing_line=billing_line(tables),
        tax_line_1=tax_line(tables, 1),
        tax_line_2=tax_line(tables, 2),
        alarm_factor=alarm_factor(spark),
    )
