"""The two 64-bit tokens of a bigint key as plain SQL, for the oracle side only.

Words are UHUGEINT values below 2^64; every step is its own CTE.
"""

from __future__ import annotations

from cellspark.functions import token as K

_FULL = "18446744073709551616::UHUGEINT"
# Multipliers of the xxhash64 function, and the seed Spark uses.
P1, P2, P3 = 11400714785074694791, 14029467366897019727, 1609587929392839161
P4, P5, SEED = 9650029242287828579, 2870177450012600261, 42


def _mul(a: str, m: int) -> str:
    return f"(({a}) * {m}::UHUGEINT % {_FULL})"


def _add(a: str, b: str) -> str:
    return f"((({a}) + ({b})) % {_FULL})"


def _xor(a: str, b: str) -> str:
    return f"xor(({a})::UBIGINT, ({b})::UBIGINT)::UHUGEINT"


def _rotl(a: str, r: int) -> str:
    return f"((({a}) * {1 << r}::UHUGEINT) % {_FULL} + ({a}) // {1 << (64 - r)}::UHUGEINT)"


def _shr(a: str, r: int) -> str:
    return f"(({a}) // {1 << r}::UHUGEINT)"


def _signed(a: str) -> str:
    return f"(CASE WHEN {a} >= 9223372036854775808 THEN ({a})::HUGEINT - {_FULL}::HUGEINT ELSE ({a})::HUGEINT END)::BIGINT"


class _Steps:
    """A chain of CTEs that each add or replace columns of the one before."""

    def __init__(self, source: str):
        self.ctes, self.known = [f"h0 AS ({source})"], set()

    def add(self, **columns: str) -> None:
        named = ", ".join(f"{sql} AS {name}" for name, sql in columns.items())
        old = [c for c in columns if c in self.known]
        star = f"* EXCLUDE ({', '.join(old)})" if old else "*"
        self.ctes.append(f"h{len(self.ctes)} AS (SELECT {star}, {named} FROM h{len(self.ctes) - 1})")
        self.known.update(columns)

    def finish(self, word: str) -> str:
        left = f"SELECT * EXCLUDE ({', '.join(sorted(self.known))}), {_signed(word)} AS token FROM h{len(self.ctes) - 1}"
        return ", ".join(self.ctes) + f", tokens AS ({left})"


def xxhash64(source: str, key: str) -> str:
    """CTEs ending in ``tokens``: the columns of ``source`` and ``token``."""
    s = _Steps(source)
    s.add(w=f"((({key})::HUGEINT + {_FULL}::HUGEINT) % {_FULL}::HUGEINT)::UHUGEINT")
    s.add(w=_mul("w", P2))
    s.add(w=_mul(_rotl("w", 31), P1))
    s.add(h=_xor(f"{SEED + P5 + 8}::UHUGEINT", "w"))
    s.add(h=_add(_mul(_rotl("h", 27), P1), f"{P4}::UHUGEINT"))
    for shift, factor in ((33, P2), (29, P3)):
        s.add(h=_xor("h", _shr("h", shift)))
        s.add(h=_mul("h", factor))
    s.add(h=_xor("h", _shr("h", 32)))
    return s.finish("h")


def murmur3(source: str, key: str) -> str:
    """CTEs ending in ``tokens``: an 8-byte key is all tail, each byte sign-extended."""
    s = _Steps(source)
    s.add(w=f"((({key})::HUGEINT + {_FULL}::HUGEINT) % {_FULL}::HUGEINT)::UHUGEINT")
    s.add(k="0::UHUGEINT")
    for i in range(8):
        s.add(b=f"w // {1 << (8 * (7 - i))}::UHUGEINT % 256")
        extension = (1 << 64) - (1 << (8 * i + 8))
        s.add(k=_xor("k", f"(b * {1 << (8 * i)}::UHUGEINT + CASE WHEN b >= 128 THEN {extension}::UHUGEINT ELSE 0::UHUGEINT END)"))
    s.add(k=_mul("k", K.C1))
    s.add(k=_mul(_rotl("k", 31), K.C2))
    s.add(g="8::UHUGEINT", h=_xor("k", "8::UHUGEINT"))
    s.add(h=_add("h", "g"))
    s.add(g=_add("g", "h"))
    for c in "gh":
        s.add(**{c: _xor(c, _shr(c, 33))})
        s.add(**{c: _mul(c, K.MIX1)})
        s.add(**{c: _xor(c, _shr(c, 33))})
        s.add(**{c: _mul(c, K.MIX2)})
        s.add(**{c: _xor(c, _shr(c, 33))})
    s.add(h=_add("h", "g"))
    return s.finish("h")
