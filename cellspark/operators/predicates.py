"""Row predicates on key and regular columns. A null never matches."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellspark.functions.token import token as token_of

_OPS: dict[str, Callable] = {
    "=": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def all_of(*predicates: Column) -> Column:
    return reduce(lambda a, b: a & b, predicates)


def compare(column, op: str, value) -> Column:
    return _OPS[op](_col(column), _lit(value))


def is_in(column, values: list) -> Column:
    """IN over a short list; duplicates are dropped and an empty list matches nothing."""
    distinct = list(dict.fromkeys(values))
    return _col(column).isin(distinct) if distinct else F.lit(False)


def semi_in(df: DataFrame, columns: list[str], values: DataFrame) -> DataFrame:
    """IN over a value table of any size; Spark broadcasts it only if it is small."""
    return df.join(values.select(*columns).distinct(), columns, "left_semi")


def tuple_eq(columns: list[str], values: tuple) -> Column:
    return all_of(*[compare(c, "=", v) for c, v in zip(columns, values, strict=True)])


def tuple_in(columns: list[str], rows: list[tuple]) -> Column:
    distinct = list(dict.fromkeys(rows))
    if not distinct:
        return F.lit(False)
    # the per-column lists can be pushed to the scan; the row test decides
    hints = [is_in(c, [r[i] for r in distinct]) for i, c in enumerate(columns)]
    exact = reduce(lambda a, b: a | b, [tuple_eq(columns, r) for r in distinct])
    return all_of(*hints, exact)


def tuple_slice(columns: list[str], op: str, values: tuple) -> Column:
    """Lexicographic comparison of the first ``len(values)`` columns with a tuple."""
    used = columns[:len(values)]
    left = F.struct(*[F.col(c) for c in used])
    right = F.struct(*[_lit(v).alias(c) for c, v in zip(used, values)])
    no_null = all_of(*[F.col(c).isNotNull() for c in used])
    # the bound on the first column can be pushed to the scan
    lead = compare(used[0], op if len(used) == 1 else op[0] + "=", values[0])
    return all_of(lead, no_null, _OPS[op](left, right))


def clustering_slice(prefix: dict, column: str | None = None, lower=None, upper=None,
                     lower_inclusive: bool = True, upper_inclusive: bool = True) -> Column:
    """Equality on leading clustering columns and a range on the next one."""
    terms = [compare(c, "=", v) for c, v in prefix.items()]
    if lower is not None:
        terms.append(compare(column, ">=" if lower_inclusive else ">", lower))
    if upper is not None:
        terms.append(compare(column, "<=" if upper_inclusive else "<", upper))
    return all_of(*terms)


def token_range(columns: list[str], after: int | None, upto: int | None,
                kinds: list[str] | None = None, method: str = "xxhash64") -> Column:
    """``after < token(pk) <= upto``."""
    t = token_of(columns, kinds, method)
    terms = [t > after] if after is not None else []
    terms += [t <= upto] if upto is not None else []
    return all_of(*terms) if terms else F.lit(True)


def contains(column, value, is_map: bool = False) -> Column:
    """A list or set element, or a map value."""
    c = F.map_values(_col(column)) if is_map else _col(column)
    return F.array_contains(c, _lit(value))


def contains_key(column, key) -> Column:
    return F.map_contains_key(_col(column), key)


def entry_equals(column, key, value) -> Column:
    return F.try_element_at(_col(column), _lit(key)) == _lit(value)


def not_null(column) -> Column:
    return _col(column).isNotNull()


def whole_equals(column, value: Column, kind: str) -> Column:
    """Equality of frozen collections: sets in any order, maps by sorted entries."""
    c = _col(column)
    if kind == "set":
        return F.array_sort(c) == F.array_sort(value)
    if kind == "map":
        return F.array_sort(F.map_entries(c)) == F.array_sort(F.map_entries(value))
    return c == value


def like_kind(pattern: str) -> tuple[str, str]:
    """(prefix | suffix | contains | equals, text) of a LIKE pattern with % at the ends only."""
    starts, ends = pattern.startswith("%"), pattern.endswith("%") and len(pattern) > 1
    text = pattern[1 if starts else 0: len(pattern) - 1 if ends else len(pattern)]
    if not text or text == "%":
        raise ValueError("LIKE value cannot be empty")
    if "%" in text:
        raise ValueError("LIKE supports % only at the ends of the pattern")
    kind = {(False, False): "equals", (False, True): "prefix",
            (True, False): "suffix", (True, True): "contains"}[(starts, ends)]
    return kind, text


def like(column, pattern: str, mode: str = "index") -> Column:
    """LIKE on a value; without wildcards ``index`` mode is equality, ``row_filter`` is contains."""
    kind, text = like_kind(pattern)
    c = _col(column)
    if kind == "equals" and mode == "row_filter":
        kind = "contains"
    return {"equals": c == text, "prefix": c.startswith(text),
            "suffix": c.endswith(text), "contains": c.contains(text)}[kind]


class Expressions:
    """Named predicates supplied by the caller: ``expr(name, text)``."""

    def __init__(self):
        self._known: dict[str, Callable[[str], Column]] = {}

    def register(self, name: str, build: Callable[[str], Column]) -> None:
        self._known[name] = build

    def expr(self, name: str, text: str) -> Column:
        if name not in self._known:
            raise KeyError(f"no predicate named {name}")
        return self._known[name](text)
