"""Durations as struct<months int, days int, nanos bigint>."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cellspark.functions.literals import groups

# The four text forms, and the size of each time unit in nanoseconds.
STANDARD = (
    r"^(-?)(?:(\d+)y)?(?:(\d+)mo)?(?:(\d+)w)?(?:(\d+)d)?(?:(\d+)h)?(?:(\d+)m)?(?:(\d+)s)?"
    r"(?:(\d+)ms)?(?:(\d+)(?:us|µs))?(?:(\d+)ns)?$"
)
ISO = r"^(-?)P(?:(\d+)Y)?(?:(\d+)M)?(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)S)?)?$"
ISO_WEEKS = r"^(-?)P(\d+)W$"
ISO_ALTERNATIVE = r"^(-?)P(\d{4})-(\d{2})-(\d{2})T(\d{2}):(\d{2}):(\d{2})$"
NANOS = {"h": 3600 * 10**9, "m": 60 * 10**9, "s": 10**9, "ms": 10**6, "us": 10**3, "ns": 1}

SCHEMA = "struct<months:int,days:int,nanos:bigint>"


def _build(text: Column, pattern: str, layout: list[str]) -> Column:
    """The duration of a text that matches ``pattern``: a sign, then one number per unit."""

    def total(parts: list[Column]) -> Column:
        number = lambda c: F.when(c == "", F.lit(0)).otherwise(c.cast("bigint")).cast("bigint")
        sign = F.when(parts[0] == "-", -1).otherwise(1)
        months = days = nanos = F.lit(0).cast("bigint")
        for part, unit in zip(parts[1:], layout, strict=True):
            n = number(part)
            if unit in ("y", "mo"):
                months = months + n * (12 if unit == "y" else 1)
            elif unit in ("w", "d"):
                days = days + n * (7 if unit == "w" else 1)
            else:
                nanos = nanos + n * NANOS[unit]
        return duration(months * sign, days * sign, nanos * sign)

    matching = F.when(text.rlike(pattern), text)
    return groups(matching, pattern, len(layout) + 1, total)


def parse_duration(text: Column) -> Column:
    """Read any of the four duration forms; other text is an error, null stays null."""
    lowered = F.lower(text)
    empty = text.rlike("^-?$")
    return (
        F.when(text.isNull(), F.lit(None).cast(SCHEMA))
        .when(~empty & lowered.rlike(STANDARD),
              _build(lowered, STANDARD, ["y", "mo", "w", "d", "h", "m", "s", "ms", "us", "ns"]))
        .when(text.rlike(ISO_WEEKS), _build(text, ISO_WEEKS, ["w"]))
        .when(text.rlike(ISO_ALTERNATIVE),
              _build(text, ISO_ALTERNATIVE, ["y", "mo", "d", "h", "m", "s"]))
        .when(text.rlike(ISO), _build(text, ISO, ["y", "mo", "d", "h", "m", "s"]))
        .otherwise(F.raise_error(F.concat(F.lit("not a duration: "), text)).cast(SCHEMA))
    )


def duration(months: Column, days: Column, nanos: Column) -> Column:
    return F.struct(months.cast("int").alias("months"), days.cast("int").alias("days"),
                    nanos.cast("bigint").alias("nanos"))


def duration_text(d: Column) -> Column:
    """The short text form, e.g. ``1y2mo3d4h5m6s``."""
    months, days, nanos = F.abs(d["months"]), F.abs(d["days"]), F.abs(d["nanos"])
    negative = (d["months"] < 0) | (d["days"] < 0) | (d["nanos"] < 0)
    div = lambda a, b: F.call_function("div", a, F.lit(b).cast("bigint"))
    parts = [(div(months, 12), "y"), (months % 12, "mo"), (days, "d")]
    rest = nanos
    for unit, size in NANOS.items():
        parts.append((div(rest, size), unit))
        rest = rest % size
    shown = [F.when(n > 0, F.concat(n.cast("string"), F.lit(u))).otherwise("") for n, u in parts]
    text = F.concat(F.when(negative, "-").otherwise(""), *shown)
    return F.when(d.isNotNull(), text)


def add_duration(ts: Column, d: Column, sign: int = 1) -> Column:
    """Timestamp plus (or minus) a duration; calendar months and days first, then time."""
    seconds = (d["nanos"] / F.lit(10**9)).cast("decimal(18,6)") * sign
    interval = F.make_interval(months=d["months"] * sign, days=d["days"] * sign, secs=seconds)
    return ts + interval
