"""Tiny inline inputs in the logical schemas, for unit tests."""

import datetime as dt
from decimal import Decimal

from zerobill import schemas
from zerobill.sources import Sources

D = Decimal


def ts(month: str, day: int = 10) -> dt.datetime:
    return dt.datetime(int(month[:4]), int(month[4:]), day, 12, 0)


def billing_row(month, bill, account, amount, type_code=2, prep_status="1",
                backout_status="0", prep_error_code=0, day=10):
    amt = None if amount is None else D(str(amount)).quantize(D("0.01"))
    return (ts(month, day), bill, account, amt, D("0.0000"), D("0.0000"), type_code,
            prep_status, backout_status, prep_error_code)


def tax_row(bill, cents, snapshot=dt.date(2001, 8, 31), code=1400000):
    return (bill, code, D(str(cents)).quantize(D("0.01")), snapshot)


def rule_row(cod, campo, segment, key, inf=0.1, sup=0.1):
    return (cod, campo, segment, key, "t", "s", "e", "p", inf, sup, 0.0, 0.0, 0.0)


def sources(spark, customers=(), billing=(), tax1=(), tax2=(), rules=()):
    def df(rows, schema):
        return spark.createDataFrame(list(rows), schema)

    return Sources(
        customer=df(customers, schemas.CUSTOMER),
        billing_line=df(billing, schemas.BILLING_LINE),
        tax_line_1=df(tax1, schemas.TAX_LINE),
        tax_line_2=df(tax2, schemas.TAX_LINE),
        alarm_factor=df(rules, schemas.ALARM_FACTOR),
    )
