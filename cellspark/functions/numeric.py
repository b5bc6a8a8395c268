"""Integer wrap-around, narrowing and the numeric and text casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}
INTEGERS = tuple(BITS)
FLOATS = ("float", "double")
# Fixed value: the text form of a timestamp.
TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss.SSS'Z'"


def _dec(n: int) -> Column:
    return F.lit(str(n)).cast("decimal(38,0)")


def wrap(value: Column, to: str) -> Column:
    """An exact decimal reduced modulo 2^n to the signed integer type ``to``."""
    half, full = 1 << (BITS[to] - 1), 1 << BITS[to]
    shifted = F.pmod(value.cast("decimal(38,0)") + _dec(half), _dec(full))
    return (shifted - _dec(half)).cast(to)


def _wrap_small(value: Column, to: str) -> Column:
    """Wrap a bigint into a narrower type with bit operations only."""
    if to == "bigint":
        return value.cast("bigint")
    bits = BITS[to]
    low = value.bitwiseAND(F.lit((1 << bits) - 1).cast("bigint"))
    return F.when(low >= (1 << (bits - 1)), low - (1 << bits)).otherwise(low).cast(to)


def _saturate(value: Column, to: str) -> Column:
    bits = BITS[to]
    low, high = -(1 << (bits - 1)), (1 << (bits - 1)) - 1
    d = value.cast("double")
    return (
        F.when(d.isNull(), F.lit(None))
        .when(F.isnan(d), F.lit(0))
        .when(d >= float(high), F.lit(high))
        .when(d <= float(low), F.lit(low))
        .otherwise(d.cast("bigint"))
        .cast(to)
    )


def cast_integer(value: Column, source: str, to: str) -> Column:
    """Cast to an integer type: integers and decimals wrap, floats saturate, NaN is 0."""
    if source in FLOATS:
        wide = _saturate(value, "bigint" if to == "bigint" else "int")
        return _wrap_small(wide.cast("bigint"), to)
    if source in INTEGERS:
        return _wrap_small(value.cast("bigint"), to)
    truncated = F.when(value < 0, F.ceil(value)).otherwise(F.floor(value))
    return wrap(truncated, to)


def cast_decimal(value: Column, source: str, scale: int = 10) -> Column:
    """Cast to decimal; floats go through their shortest text form."""
    target = f"decimal(38,{scale})"
    if source in FLOATS:
        return value.cast("double").cast("string").cast(target)
    if source.startswith("decimal"):
        return value.cast(target)
    return value.cast("bigint").cast(target)


def cast_varint(value: Column, source: str) -> Column:
    return cast_integer(value, source, "bigint").cast("decimal(38,0)")


def cast_text(value: Column, source: str) -> Column:
    if source == "timestamp":
        return F.date_format(value, TIMESTAMP_TEXT)
    return value.cast("string")


def cast_to(value: Column, source: str, to: str, scale: int = 10) -> Column:
    """The cast from ``source`` to ``to`` (null stays null)."""
    from cellspark.functions import timeuuid as tu

    source = {"counter": "bigint"}.get(source, source)
    if source == "timeuuid" and to in ("date", "timestamp"):
        return tu.to_date(value) if to == "date" else tu.to_timestamp(value)
    if to in INTEGERS:
        return cast_integer(value, source, to)
    if to in FLOATS:
        return value.cast(to)
    if to == "decimal":
        return cast_decimal(value, source, scale)
    if to == "varint":
        return cast_varint(value, source)
    if to in ("text", "ascii"):
        return cast_text(value, source)
    if to == "date":
        return value.cast("date")
    if to == "timestamp":
        return value.cast("timestamp")
    raise ValueError(f"no cast from {source} to {to}")
