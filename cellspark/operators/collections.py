"""Edits of list, set, map and user-type cells, as expressions on the current value.

An empty non-frozen collection reads as null, so every edit ends in ``_null_if_empty``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _null_if_empty(c: Column) -> Column:
    return F.when(F.size(c) > 0, c)


def _or_empty_list(c: Column, like: Column) -> Column:
    return F.coalesce(c, F.slice(like, 1, 0))


def list_append(c: Column, items: Column) -> Column:
    return _null_if_empty(F.concat(_or_empty_list(c, items), items))


def list_prepend(c: Column, items: Column) -> Column:
    """The given order is kept in front of the list."""
    return _null_if_empty(F.concat(items, _or_empty_list(c, items)))


def _checked(c: Column, index: Column, value: Column, kind: str) -> Column:
    ok = (index >= 0) & (index < F.coalesce(F.size(c), F.lit(0)))
    return F.when(ok, value).otherwise(F.raise_error(F.lit("list index out of bounds")).cast(kind))


def list_set(c: Column, index, value: Column, kind: str) -> Column:
    """Replace by position; ``kind`` is the list's type. A null value deletes the position."""
    i = index if isinstance(index, Column) else F.lit(index)
    put = F.transform(c, lambda x, n: F.when(n == i, value).otherwise(x))
    return _checked(c, i, F.when(value.isNull(), list_delete_at(c, i, kind)).otherwise(put), kind)


def list_delete_at(c: Column, index, kind: str) -> Column:
    i = index if isinstance(index, Column) else F.lit(index)
    return _checked(c, i, _null_if_empty(F.filter(c, lambda x, n: n != i)), kind)


def list_discard(c: Column, values: Column) -> Column:
    """Remove every occurrence of the given values."""
    return _null_if_empty(F.filter(c, lambda x: ~F.array_contains(values, x)))


def set_add(c: Column, items: Column) -> Column:
    return _null_if_empty(F.array_sort(F.array_union(_or_empty_list(c, items), items)))


def set_remove(c: Column, items: Column) -> Column:
    return _null_if_empty(F.array_sort(F.array_except(c, items)))


def map_put(c: Column, entries: Column) -> Column:
    """Given entries replace those with the same key; a null value deletes the entry."""
    base = F.map_filter(F.coalesce(c, F.map_filter(entries, lambda k, v: F.lit(False))),
                        lambda k, v: ~F.map_contains_key(entries, k))
    merged = F.map_filter(F.map_concat(base, entries), lambda k, v: v.isNotNull())
    return _null_if_empty(F.map_from_entries(F.array_sort(F.map_entries(merged))))


def map_remove(c: Column, keys: Column) -> Column:
    return _null_if_empty(F.map_filter(c, lambda k, v: ~F.array_contains(keys, k)))


def field_set(c: Column, field: str, value: Column) -> Column:
    return c.withField(field, value)


def field_delete(c: Column, field: str, kind: str) -> Column:
    return c.withField(field, F.lit(None).cast(kind))
