"""Time-based UUIDs as canonical text, and the date/time conversions on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 100 ns ticks between 1582-10-15 and the Unix epoch, and the smallest and
# largest lower halves in byte order.
EPOCH_TICKS = 122192928000000000
TICKS_PER_MS = 10000
MIN_LOW = "8080-808080808080"
MAX_LOW = "7f7f-7f7f7f7f7f7f"


def _hex(value: Column, width: int) -> Column:
    return F.lower(F.lpad(F.hex(value), width, "0"))


def from_ticks(ticks: Column, low: Column) -> Column:
    """UUID text of a tick count (since 1582) and an ``xxxx-xxxxxxxxxxxx`` lower part."""
    mask = lambda v, m: v.bitwiseAND(F.lit(m).cast("bigint"))
    return F.concat_ws(
        "-",
        _hex(mask(ticks, 0xFFFFFFFF), 8),
        _hex(mask(F.shiftright(ticks, 32), 0xFFFF), 4),
        _hex(mask(F.shiftright(ticks, 48), 0x0FFF).bitwiseOR(F.lit(0x1000).cast("bigint")), 4),
        low,
    )


def _guard(ts: Column, value: Column) -> Column:
    return F.when(ts.isNotNull(), value)


def min_timeuuid(ts: Column) -> Column:
    ticks = unix_millis(ts) * TICKS_PER_MS + EPOCH_TICKS
    return _guard(ts, from_ticks(ticks, F.lit(MIN_LOW)))


def max_timeuuid(ts: Column) -> Column:
    ticks = (unix_millis(ts) + 1) * TICKS_PER_MS + (EPOCH_TICKS - 1)
    return _guard(ts, from_ticks(ticks, F.lit(MAX_LOW)))


def timeuuid_of(ts: Column, salt: Column) -> Column:
    """A time-based UUID at ``ts`` (µs precision) whose lower half comes from ``salt`` (text)."""
    micros = F.unix_micros(ts.cast("timestamp"))
    digest = F.md5(salt)
    low = F.concat(F.lit("8"), F.substring(digest, 2, 3), F.lit("-"), F.substring(digest, 5, 12))
    return _guard(ts, from_ticks(micros * 10 + EPOCH_TICKS, low))


def now() -> Column:
    """A fresh time-based UUID for each row (not deterministic)."""
    u = F.uuid()
    return timeuuid_of(F.current_timestamp(), u)


def random_uuid() -> Column:
    return F.uuid()


def ticks(u: Column) -> Column:
    """100 ns ticks since 1582-10-15 held in a time-based UUID."""
    digits = F.concat(F.substring(u, 16, 3), F.substring(u, 10, 4), F.substring(u, 1, 8))
    return F.conv(digits, 16, 10).cast("bigint")


def to_unix_millis(u: Column) -> Column:
    since = ticks(u) - EPOCH_TICKS
    return F.call_function("div", since, F.lit(TICKS_PER_MS))


def to_timestamp(u: Column) -> Column:
    return F.timestamp_millis(to_unix_millis(u))


def to_date(u: Column) -> Column:
    return to_timestamp(u).cast("date")


# deprecated names kept for callers that still use them
date_of = to_timestamp
unix_timestamp_of = to_unix_millis


def date_to_timestamp(d: Column) -> Column:
    return d.cast("timestamp")


def unix_millis(t: Column) -> Column:
    """Milliseconds since the epoch of a date or timestamp (UTC session)."""
    return F.unix_millis(t.cast("timestamp"))


def timestamp_to_date(t: Column) -> Column:
    return t.cast("date")


def order_key(u: Column) -> Column:
    """Sort key of time-based UUIDs: embedded time first, then the lower half's signed bytes."""
    low = F.concat(F.substring(u, 20, 4), F.substring(u, 25, 12))
    # signed byte order equals unsigned order after flipping each byte's top bit
    signed = F.concat(*[
        F.concat(F.translate(F.substring(low, i, 1), "0123456789abcdef", "89abcdef01234567"),
                 F.substring(low, i + 1, 1))
        for i in range(1, 17, 2)
    ])
    return F.struct(ticks(u).alias("ticks"), signed.alias("low"))


def current_timestamp() -> Column:
    return F.current_timestamp()


def current_date() -> Column:
    return F.current_date()


def current_time_nanos() -> Column:
    return F.expr("unix_micros(current_timestamp()) % 86400000000") * 1000
