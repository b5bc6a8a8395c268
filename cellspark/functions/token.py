"""Partition tokens.

``xxhash64`` is the default for splitting and ordering because it stays in generated
code. ``murmur3`` gives the 64-bit token users of the original data know; it is a
vectorised function over Arrow batches.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Multipliers and addends of the 128-bit murmur3 hash.
C1 = 0x87C37B91114253D5
C2 = 0x4CF5AD432745937F
N1 = 0x52DCE729
N2 = 0x38495AB5
MIX1 = 0xFF51AFD7ED558CCD
MIX2 = 0xC4CEB9FE1A85EC53

WIDTH = {"tinyint": 1, "smallint": 2, "int": 4, "bigint": 8}


def key_bytes(columns: list[tuple[Column, str]]) -> Column:
    """Serialized partition key: the value's bytes, or length-prefixed parts if composite."""
    parts = [_value_bytes(c, t) for c, t in columns]
    if len(parts) == 1:
        return parts[0]
    framed = []
    for part in parts:
        size = F.unhex(F.lpad(F.hex(F.octet_length(part).cast("bigint")), 4, "0"))
        framed += [size, part, F.unhex(F.lit("00"))]
    return F.concat(*framed)


def _value_bytes(c: Column, kind: str) -> Column:
    if kind in WIDTH:
        return F.unhex(F.substring(F.lpad(F.hex(c.cast("bigint")), 16, "0"), -2 * WIDTH[kind], 2 * WIDTH[kind]))
    if kind == "timestamp":
        return _value_bytes(F.unix_millis(c.cast("timestamp")), "bigint")
    if kind == "uuid":
        return F.unhex(F.regexp_replace(c, "-", ""))
    if kind == "boolean":
        return F.unhex(F.when(c, "01").otherwise("00"))
    if kind in ("text", "ascii"):
        return F.encode(c, "UTF-8")
    if kind == "blob":
        return c
    raise ValueError(f"no key bytes for type {kind}")


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def _fmix(x: np.ndarray) -> np.ndarray:
    for m in (MIX1, MIX2):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(m)
    return x ^ (x >> np.uint64(33))


def _word_1(k):
    return _rotl(k * np.uint64(C1), 31) * np.uint64(C2)


def _word_2(k):
    return _rotl(k * np.uint64(C2), 33) * np.uint64(C1)


def murmur3_batch(keys: np.ndarray) -> np.ndarray:
    """Tokens of ``n`` equally long keys given as an ``(n, length)`` array of uint8."""
    n, length = keys.shape
    h1 = np.zeros(n, np.uint64)
    h2 = np.zeros(n, np.uint64)
    whole = length // 16 * 16
    words = np.ascontiguousarray(keys[:, :whole]).view("<u8").reshape(n, -1)
    with np.errstate(over="ignore"):
        for i in range(0, words.shape[1], 2):
            h1 = (_rotl(h1 ^ _word_1(words[:, i]), 27) + h2) * np.uint64(5) + np.uint64(N1)
            h2 = (_rotl(h2 ^ _word_2(words[:, i + 1]), 31) + h1) * np.uint64(5) + np.uint64(N2)
        # the bytes after the last block enter sign-extended
        tail = keys[:, whole:].view(np.int8).astype(np.int64).view(np.uint64)
        k = [np.zeros(n, np.uint64), np.zeros(n, np.uint64)]
        for j in range(tail.shape[1]):
            k[j // 8] = k[j // 8] ^ (tail[:, j] << np.uint64(8 * (j % 8)))
        h1, h2 = h1 ^ _word_1(k[0]), h2 ^ _word_2(k[1])
        h1, h2 = h1 ^ np.uint64(length), h2 ^ np.uint64(length)
        h1 = h1 + h2
        h2 = h2 + h1
        token = (_fmix(h1) + _fmix(h2)).view(np.int64).copy()
    lowest, highest = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    token[token == lowest] = highest
    if length == 0:
        token[:] = lowest
    return token


@F.pandas_udf(T.LongType())
def murmur3(keys: pd.Series) -> pd.Series:
    out = pd.Series(pd.NA, index=keys.index, dtype="Int64")
    present = keys[keys.notna()]
    for length, group in present.groupby(present.str.len()):
        flat = np.frombuffer(b"".join(group.tolist()), np.uint8).reshape(len(group), int(length))
        out.loc[group.index] = murmur3_batch(flat)
    return out


def token(columns: list, kinds: list[str] | None = None, method: str = "xxhash64") -> Column:
    """The token of a partition key; ``kinds`` (column types) is needed for murmur3 only."""
    cols = [F.col(c) if isinstance(c, str) else c for c in columns]
    if method == "xxhash64":
        return F.xxhash64(*cols)
    any_null = cols[0].isNull()
    for c in cols[1:]:
        any_null = any_null | c.isNull()
    if method == "murmur3":
        return F.when(~any_null, murmur3(key_bytes(list(zip(cols, kinds)))))
    if method == "md5":
        return F.when(~any_null, md5_token(key_bytes(list(zip(cols, kinds)))))
    if method == "ordered":
        return cols[0] if len(cols) == 1 else F.struct(*cols)
    raise ValueError(f"unknown token method {method}")


def md5_token(key: Column) -> Column:
    """Absolute value of the MD5 digest read as a signed big integer, as 32 hex digits.

    The number needs 128 bits, one more digit than a decimal column holds; equally long
    lower-case hex text sorts the same way.
    """
    digest = F.md5(key)
    high = F.conv(F.substring(digest, 1, 16), 16, -10).cast("bigint")
    low = F.conv(F.substring(digest, 17, 16), 16, -10).cast("bigint")
    lowest = F.lit(-(1 << 63)).cast("bigint")
    neg_low = F.when(low == lowest, low).otherwise(F.bitwise_not(low) + 1)
    carry = F.when(low == 0, F.lit(1)).otherwise(F.lit(0))
    inv = F.bitwise_not(high)
    neg_high = F.when((low == 0) & (high == lowest), high).otherwise(inv + carry)
    text = lambda h, l: F.lower(F.concat(F.lpad(F.hex(h), 16, "0"), F.lpad(F.hex(l), 16, "0")))
    return F.when(high < 0, text(neg_high, neg_low)).otherwise(digest)
