"""Conversions between native types and big-endian blobs."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellspark.functions.token import WIDTH


@F.pandas_udf(T.BinaryType())
def _double_bytes(x: pd.Series) -> pd.Series:
    return x.map(lambda v: struct.pack(">d", v), na_action="ignore")


@F.pandas_udf(T.BinaryType())
def _float_bytes(x: pd.Series) -> pd.Series:
    return x.map(lambda v: struct.pack(">f", v), na_action="ignore")


@F.pandas_udf(T.DoubleType())
def _bytes_double(x: pd.Series) -> pd.Series:
    return x.map(lambda v: struct.unpack(">d", v)[0], na_action="ignore").astype("float64")


@F.pandas_udf(T.FloatType())
def _bytes_float(x: pd.Series) -> pd.Series:
    return x.map(lambda v: struct.unpack(">f", v)[0], na_action="ignore").astype("float32")


def as_blob(value: Column, kind: str) -> Column:
    """``<kind>AsBlob``: the serialized form of a value."""
    if kind in WIDTH:
        n = 2 * WIDTH[kind]
        return F.unhex(F.substring(F.lpad(F.hex(value.cast("bigint")), 16, "0"), -n, n))
    if kind in ("text", "ascii", "varchar"):
        return F.encode(value, "UTF-8")
    if kind == "boolean":
        return F.unhex(F.when(value, "01").when(~value, "00"))
    if kind == "timestamp":
        return as_blob(F.unix_millis(value.cast("timestamp")), "bigint")
    if kind == "time":
        return as_blob(value, "bigint")
    if kind == "date":
        # days since the epoch, shifted so that the epoch is 2^31
        days = F.unix_date(value).cast("bigint") + (1 << 31)
        return F.unhex(F.lpad(F.hex(days), 8, "0"))
    if kind in ("uuid", "timeuuid"):
        return F.unhex(F.regexp_replace(value, "-", ""))
    if kind == "double":
        return _double_bytes(value)
    if kind == "float":
        return _float_bytes(value)
    raise ValueError(f"no blob form for {kind}")


def _sized(b: Column, size: int, value: Column, kind: str) -> Column:
    bad = F.raise_error(F.concat(F.lit(f"blobAs{kind}: expected {size} bytes, got "),
                                 F.octet_length(b).cast("string")))
    return F.when(b.isNull(), F.lit(None)).when(F.octet_length(b) == size, value).otherwise(bad)


def blob_as(b: Column, kind: str) -> Column:
    """``blobAs<kind>``: read a value back; a wrong length is an error."""
    if kind in WIDTH:
        size = WIDTH[kind]
        unsigned = F.conv(F.hex(b), 16, -10).cast("bigint")
        if size < 8:
            half, full = 1 << (8 * size - 1), 1 << (8 * size)
            unsigned = F.when(unsigned >= half, unsigned - full).otherwise(unsigned)
        return _sized(b, size, unsigned.cast(kind), kind)
    if kind in ("text", "ascii", "varchar"):
        return F.decode(b, "UTF-8")
    if kind == "boolean":
        return _sized(b, 1, F.hex(b) != "00", kind)
    if kind == "timestamp":
        return F.timestamp_millis(blob_as(b, "bigint"))
    if kind == "time":
        return blob_as(b, "bigint")
    if kind == "date":
        days = F.conv(F.hex(b), 16, 10).cast("bigint") - (1 << 31)
        return _sized(b, 4, F.date_from_unix_date(days.cast("int")), kind)
    if kind in ("uuid", "timeuuid"):
        return _sized(b, 16, F.regexp_replace(
            F.lower(F.hex(b)), "(.{8})(.{4})(.{4})(.{4})(.{12})", "$1-$2-$3-$4-$5"), kind)
    if kind == "double":
        return _sized(b, 8, _bytes_double(F.when(F.octet_length(b) == 8, b)), kind)
    if kind == "float":
        return _sized(b, 4, _bytes_float(F.when(F.octet_length(b) == 4, b)), kind)
    raise ValueError(f"no value of {kind} from a blob")
