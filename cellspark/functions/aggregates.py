"""Aggregates whose result keeps the input type.

Integer sums add up bit slices of the value in plain longs, so the aggregate stays a
hash aggregate in generated code and cannot overflow; the slices are put together once
per group and then wrapped to the input type.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cellspark.functions.numeric import FLOATS, INTEGERS, wrap

_SLICE = 22


def count_rows() -> Column:
    return F.count(F.lit(1))


def count(value: Column) -> Column:
    return F.count(value)


def _exact_sum(value: Column) -> Column:
    v = value.cast("bigint")
    mask = F.lit((1 << _SLICE) - 1).cast("bigint")
    low = F.sum(v.bitwiseAND(mask))
    mid = F.sum(F.shiftright(v, _SLICE).bitwiseAND(mask))
    high = F.sum(F.shiftright(v, 2 * _SLICE))

    def d(x, power):
        factor = F.lit(str(1 << power)).cast("decimal(14,0)")
        return x.cast("decimal(20,0)") * factor

    return (d(high, 2 * _SLICE) + d(mid, _SLICE) + d(low, 0)).cast("decimal(38,0)")


def _exact_mean(value: Column) -> Column:
    """Mean of integers of up to 38 digits, truncated towards zero; the sum may need more digits.

    The upper and lower 19 digits are summed apart. Null for an empty group.
    """
    base = F.lit("1" + "0" * 19).cast("decimal(20,0)")
    v = value.cast("decimal(38,0)")
    n = F.count(value).cast("decimal(19,0)")
    quotient = lambda a: ((a - a % n) / n).cast("decimal(38,0)")
    high = F.sum(((v - v % base) / base).cast("decimal(28,0)"))
    low = F.sum((v % base).cast("decimal(28,0)"))
    upper = quotient(high)
    rest = (high % n) * base + low
    # both parts are cut towards zero; with opposite signs the lower one has to be cut the other way
    turn = F.when((rest % n != 0) & (F.signum(upper) * F.signum(rest) < 0), F.signum(rest)).otherwise(0)
    lower = quotient(rest) + turn.cast("decimal(1,0)")
    return F.when(n > 0, (upper.cast("decimal(20,0)") * base + lower).cast("decimal(38,0)"))


def sum_of(value: Column, kind: str, scale: int = 2) -> Column:
    """SUM: wraps for integers, 0 on an empty group, same type as the input."""
    if kind in INTEGERS or kind == "counter":
        to = "bigint" if kind == "counter" else kind
        return F.coalesce(wrap(_exact_sum(value), to), F.lit(0).cast(to))
    if kind in FLOATS:
        return F.coalesce(F.sum(value.cast("double")).cast(kind), F.lit(0.0).cast(kind))
    if kind == "varint":
        scale = 0
    target = f"decimal(38,{scale})"
    return F.coalesce(F.sum(value.cast(target)), F.lit(0).cast(target)).cast(target)


def avg_of(value: Column, kind: str, scale: int = 2) -> Column:
    """AVG: integers truncate towards zero, decimals round half even, 0 on an empty group."""
    if kind in INTEGERS or kind == "counter":
        to = "bigint" if kind == "counter" else kind
        n = F.count(value)
        mean = F.when(n > 0, F.call_function("div", _exact_sum(value), n.cast("decimal(20,0)")))
        return F.coalesce(mean, F.lit(0)).cast(to)
    if kind in FLOATS:
        return F.coalesce(F.avg(value.cast("double")), F.lit(0.0)).cast(kind)
    if kind == "varint":
        return F.coalesce(_exact_mean(value), F.lit(0).cast("decimal(38,0)"))
    total, n = F.sum(value), F.count(value).cast("decimal(19,0)")
    mean = F.when(n > 0, F.bround(total / n, scale))
    return F.coalesce(mean, F.lit(0)).cast(f"decimal(38,{scale})")


def min_of(value: Column) -> Column:
    return F.min(value)


def max_of(value: Column) -> Column:
    return F.max(value)
