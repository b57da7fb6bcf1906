"""Read the logical inputs from catalog tables or files, keeping their values.

Each input is projected to the columns the job uses (so the scan prunes the
rest). What a column may become depends on the role it plays:

=========  ==================================================================
role       ingest
=========  ==================================================================
key        kept as stored when every input that has the key stores it alike
           (``'0012'`` and ``'12'`` stay two invoices); integral types are
           widened to bigint; anything else becomes bigint, checked
code       kept when numeric, so a list or range is compared, and pushed to
           the scan, in the stored type (2.7 is not type 2); text is checked
status     kept when integral or text
day        kept when date, timestamp or text
measure    kept when decimal; integral types widen; others are checked
text       cast to string
factor     double, checked
=========  ==================================================================

"Checked" means that the cast is undone: a value that the logical type cannot
hold exactly (``0.004`` in two decimals, ``'abc'`` in a code) fails the job,
whatever ``spark.sql.ansi.enabled`` says, instead of becoming NULL, a rounded
amount or another key.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zerobill import schemas
from zerobill.sources import Sources


class SchemaError(ValueError):
    """An input misses a required column."""


_TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)
_INTEGRAL_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_NUMERIC = (T.IntegralType, T.DecimalType)
#: Exact for any bigint and any amount of up to 18 decimals.
_WIDE = T.DecimalType(38, 18)


def _integral(dtype: T.DataType) -> bool:
    return type(dtype) in _INTEGRAL_DIGITS


def _kept(src: T.DataType, role: str) -> bool:
    """Stored types that the job reads as they are."""
    if role == schemas.CODE:
        return isinstance(src, _NUMERIC)
    if role == schemas.STATUS:
        return _integral(src) or isinstance(src, T.StringType)
    if role == schemas.DAY:
        return isinstance(src, (*_TEMPORAL, T.StringType))
    if role == schemas.MEASURE:
        return isinstance(src, T.DecimalType)
    return False


def _widens(src: T.DataType, dst: T.DataType) -> bool:
    """Casts that cannot fail or lose information."""
    if isinstance(dst, T.StringType):
        return True
    if _integral(src) and _integral(dst):
        return _INTEGRAL_DIGITS[type(src)] <= _INTEGRAL_DIGITS[type(dst)]
    if _integral(src) and isinstance(dst, T.DecimalType):
        return dst.precision - dst.scale >= _INTEGRAL_DIGITS[type(src)]
    if isinstance(src, T.DecimalType) and isinstance(dst, T.DecimalType):
        return dst.scale >= src.scale and dst.precision - dst.scale >= src.precision - src.scale
    return isinstance(src, T.FloatType) and isinstance(dst, T.DoubleType)


def lossless_cast(c: Column, src: T.DataType, dst: T.DataType, label: str, exact_text: bool = False) -> Column:
    """``c`` as ``dst``; a value that casting back does not restore fails the job.

    Text is compared by its number, once exactly and once as a double (which
    sees digits beyond the exact form); with ``exact_text`` by its characters,
    so that ``'0012'`` is not taken for 12.
    """
    converted = c.try_cast(dst)
    if not isinstance(src, T.StringType):
        same = converted.try_cast(src) == c
    elif exact_text:
        same = converted.cast("string") == c
    elif isinstance(dst, T.DoubleType):
        same = converted.isNotNull()
    elif isinstance(dst, _NUMERIC):
        same = (c.try_cast(_WIDE) == converted.cast(_WIDE)) & (c.try_cast("double") == converted.cast("double"))
    else:
        same = converted.isNotNull()
    return (
        F.when(c.isNull() | same, converted)
        .otherwise(F.raise_error(F.concat(F.lit(f"{label}: not exactly {dst.simpleString()}: "), c.cast("string"))).cast(dst))
    )


def _target(src: T.DataType, field: T.StructField, role: str, keys: Mapping[str, T.DataType]) -> T.DataType:
    """The type ``conform`` gives the column."""
    if role == schemas.KEY:
        return keys.get(field.name, field.dataType)
    if src == field.dataType or _kept(src, role):
        # a narrower decimal takes the logical type at no cost in precision
        return field.dataType if _widens(src, field.dataType) and role == schemas.MEASURE else src
    if _integral(src) and role == schemas.MEASURE:
        return T.DecimalType(_INTEGRAL_DIGITS[type(src)] + field.dataType.scale, field.dataType.scale)
    if role == schemas.CODE and isinstance(src, T.StringType):
        return T.LongType()
    return field.dataType


def conform(
    df: DataFrame, schema: T.StructType, name: str = "input", keys: Mapping[str, T.DataType] | None = None
) -> DataFrame:
    """Select ``schema``'s columns from ``df``, each in its stored or logical type.

    ``keys`` gives the type of key columns where it is not the logical one
    (``read_sources`` finds the type that all inputs share).
    """
    fields = df.schema.fields
    if not keys and [(f.name, f.dataType) for f in fields] == [(f.name, f.dataType) for f in schema.fields]:
        return df  # already the logical layout: nothing to project or convert
    present = {f.name.lower(): f for f in fields}
    missing = [f.name for f in schema.fields if f.name.lower() not in present]
    if missing:
        raise SchemaError(f"{name}: missing columns {missing}")
    cols = []
    for field in schema.fields:
        src = present[field.name.lower()]
        role = schemas.role(field.name)
        dst = _target(src.dataType, field, role, keys or {})
        c = F.col(f"`{src.name}`")
        if src.dataType == dst:
            pass
        elif _widens(src.dataType, dst):
            c = c.cast(dst)
        else:
            c = lossless_cast(c, src.dataType, dst, f"{name}.{field.name}", exact_text=role == schemas.KEY)
        cols.append(c.alias(field.name))
    return df.select(*cols)


def key_types(frames: Mapping[str, DataFrame]) -> dict[str, T.DataType]:
    """The type of each key over the inputs that have it: the stored one if
    they agree and it compares exactly, else the logical bigint."""
    stored: dict[str, list[T.DataType]] = {}
    for name, schema in schemas.SOURCES.items():
        have = {f.name.lower(): f.dataType for f in frames[name].schema.fields}
        for f in schema.fields:
            if schemas.role(f.name) == schemas.KEY and f.name.lower() in have:
                stored.setdefault(f.name, []).append(have[f.name.lower()])
    return {
        k: kinds[0]
        for k, kinds in stored.items()
        if all(t == kinds[0] for t in kinds) and isinstance(kinds[0], (T.StringType, T.DecimalType))
    }


def read_input(spark: SparkSession, location: str, fmt: str | None = None) -> DataFrame:
    """A catalog table name (``db.table``) or, with ``fmt``, a file path."""
    if fmt is None:
        return spark.table(location)
    return spark.read.format(fmt).load(location)


def conform_sources(frames: Mapping[str, DataFrame]) -> Sources:
    """The five inputs, each conformed, with keys in one type across them."""
    keys = key_types(frames)
    return Sources(**{name: conform(frames[name], schema, name, keys) for name, schema in schemas.SOURCES.items()})


def read_sources(
    spark: SparkSession,
    locations: Mapping[str, str],
    fmt: str | None = None,
) -> Sources:
    """Read and conform the five inputs named in ``locations``.

    ``locations`` maps each of ``customer``, ``billing_line``, ``tax_line_1``,
    ``tax_line_2`` and ``alarm_factor`` to a table name (or path with ``fmt``).
    """
    return conform_sources({name: read_input(spark, locations[name], fmt) for name in schemas.SOURCES})
