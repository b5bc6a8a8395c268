"""Text forms of timestamps, dates and times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values. The accepted timestamp patterns are every combination of
#   yyyy-MM-dd [(' ' or 'T') HH:mm [:ss [.SSS]]]
# with no zone, an offset as +HH, +HHmm, +HH:mm or Z, or a blank and a zone name;
# a whole number is milliseconds since the epoch.
TIMESTAMP = (
    r"^(\d{4}-\d{1,2}-\d{1,2})(?:[ T](\d{1,2}):(\d{2})(?::(\d{2})(?:\.(\d{1,3}))?)?)?"
    r"(Z|[+-]\d{2}(?::?\d{2})?| [A-Za-z][A-Za-z0-9_/+:-]*)?$"
)
NUMBER = r"^-?\d+$"
TIME = r"^(\d{1,2}):(\d{1,2}):(\d{1,2})(?:\.(\d{1,9}))?$"
DAY_NANOS = 86400 * 10**9


def _error(kind: str, text: Column, to: str) -> Column:
    return F.raise_error(F.concat(F.lit(f"not a {kind}: "), text)).cast(to)


def groups(text: Column, pattern: str, n: int, build) -> Column:
    """``build(list of group texts)`` for a text that matches, after a single match.

    The groups are written into one delimited text and split again; the one-element array
    binds them, so that the pattern is not matched once per group. Missing groups are empty.
    """
    joined = F.regexp_replace(text, pattern, "|".join(f"${i}" for i in range(1, n + 1)))
    return F.element_at(F.transform(F.array(F.split(joined, r"\|", -1)), lambda parts: build(
        [F.get(parts, F.lit(i)) for i in range(n)])), 1)


def _timestamp_of(g: list[Column]) -> Column:
    date, hour, minute, second, millis, zone_part = g
    or_zero = lambda c, width: F.lpad(F.when(c == "", "0").otherwise(c), width, "0")
    zone = F.trim(zone_part)
    offset = (
        F.when(zone.isin("", "Z"), "+00:00")
        .when(zone.rlike(r"^[+-]\d{2}$"), F.concat(zone, F.lit(":00")))
        .when(zone.rlike(r"^[+-]\d{4}$"), F.regexp_replace(zone, r"(\d{2})$", ":$1"))
        .when(zone.rlike(r"^[+-]"), zone)
        .otherwise(F.concat(F.lit(" "), zone))
    )
    clock = F.concat(date, F.lit(" "), or_zero(hour, 2), F.lit(":"), or_zero(minute, 2), F.lit(":"),
                     or_zero(second, 2), F.lit("."), or_zero(millis, 3))
    return F.concat(clock, offset).cast("timestamp")


def parse_timestamp(text: Column) -> Column:
    """Timestamp from any accepted text form; other text is an error, null stays null."""
    fits = text.rlike(TIMESTAMP)
    return (
        F.when(text.isNull(), F.lit(None).cast("timestamp"))
        .when(text.rlike(NUMBER), F.timestamp_millis(F.when(text.rlike(NUMBER), text).cast("bigint")))
        .when(fits, groups(F.when(fits, text), TIMESTAMP, 6, _timestamp_of))
        .otherwise(_error("timestamp", text, "timestamp"))
    )


def parse_date(text: Column) -> Column:
    """Date from yyyy-mm-dd, or from the unsigned day number whose epoch is 2^31."""
    raw = F.when(text.rlike(NUMBER), text).cast("bigint")
    iso = F.when(text.rlike(r"^-?\d{4,}-\d{1,2}-\d{1,2}$"), text)
    return (
        F.when(text.isNull(), F.lit(None).cast("date"))
        .when(raw.isNotNull() & (raw >= 0) & (raw < (1 << 32)),
              F.date_from_unix_date((raw - (1 << 31)).cast("int")))
        .when(iso.isNotNull(), iso.cast("date"))
        .otherwise(_error("date", text, "date"))
    )


def parse_time(text: Column) -> Column:
    """Nanoseconds since midnight from hh:mm:ss[.fffffffff] or a raw number."""
    raw = F.when(text.rlike(NUMBER), text).cast("bigint")
    fits = text.rlike(TIME)

    def build(g: list[Column]) -> Column:
        fraction = F.rpad(F.when(g[3] == "", "0").otherwise(g[3]), 9, "0").cast("bigint")
        h, m, s = (x.cast("bigint") for x in g[:3])
        return F.when((h < 24) & (m < 60) & (s < 60), ((h * 60 + m) * 60 + s) * 10**9 + fraction)

    nanos = groups(F.when(fits, text), TIME, 4, build)
    return (
        F.when(text.isNull(), F.lit(None).cast("bigint"))
        .when(raw.isNotNull() & (raw >= 0) & (raw < DAY_NANOS), raw)
        .otherwise(F.coalesce(nanos, _error("time", text, "bigint")))
    )


def time_text(nanos: Column) -> Column:
    div = lambda a, b: F.call_function("div", a, F.lit(b).cast("bigint"))
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    seconds = div(nanos, 10**9)
    return F.concat(two(div(seconds, 3600)), F.lit(":"), two(div(seconds, 60) % 60), F.lit(":"),
                    two(seconds % 60), F.lit("."), F.lpad((nanos % 10**9).cast("string"), 9, "0"))
