"""Index tables: values and terms to row keys, and lookups through them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellspark.operators.text import Analyzer, term_matches, terms_table
from cellspark.operators.predicates import like_kind
from cellspark.spec import TableSpec


def term_index(df: DataFrame, column: str, analyzer: Analyzer, spec: TableSpec,
               mode: str = "prefix") -> DataFrame:
    """Inverted index rows: ``term`` and the key. ``contains`` mode indexes every suffix."""
    terms = terms_table(df, column, analyzer, spec.key)
    if mode == "prefix":
        return terms
    if mode != "contains":
        raise ValueError("mode must be prefix or contains")
    starts = F.sequence(F.lit(1), F.length("term"))
    suffixes = F.transform(starts, lambda i: F.struct(
        F.col("term").substr(i, F.length("term")).alias("suffix"), (i == 1).alias("whole")))
    return terms.withColumn("_s", F.explode(suffixes)).select(
        F.col("_s.suffix").alias("suffix"), F.col("_s.whole").alias("whole"), "term", *spec.key)


START, END = "\x02", "\x03"  # around a term, so that its ends have grams of their own
GRAM = 3


def gram_index(terms: DataFrame, n: int = GRAM) -> DataFrame:
    """Postings (``gram``, ``term``) of the distinct terms: as many as they have characters, for searches inside them."""
    marked = F.concat(F.lit(START), F.col("term"), F.lit(END))
    places = F.sequence(F.lit(1), F.greatest(F.length(marked) - (n - 1), F.lit(1)))
    grams = F.array_distinct(F.transform(places, lambda i: F.substring(marked, i, F.lit(n))))
    return terms.select("term").distinct().select(F.explode(grams).alias("gram"), "term")


def grams_of(kind: str, text: str, n: int = GRAM) -> list[str]:
    """The grams that every matching term has; none if the text is too short."""
    whole = (START if kind in ("prefix", "equals") else "") + text + (END if kind in ("suffix", "equals") else "")
    return sorted({whole[i : i + n] for i in range(len(whole) - n + 1)})


def gram_lookup(grams: DataFrame, terms: DataFrame, pattern: str, spec: TableSpec, n: int = GRAM) -> DataFrame:
    """Distinct keys of ``terms`` (``term``, key) with a term that is LIKE ``pattern``.

    The postings of the pattern's grams are intersected and what is left is checked. A pattern without a whole gram
    goes through the distinct terms.
    """
    kind, text = like_kind(pattern)
    wanted = grams_of(kind, text, n)
    if wanted:
        found = grams.filter(F.col("gram").isin(wanted)).groupBy("term").agg(F.count("*").alias("n")).filter(F.col("n") == len(wanted))
    else:
        found = grams.select("term").distinct()
    found = found.select("term").filter(term_matches(kind, text)(F.col("term")))
    return terms.join(found, "term", "left_semi").select(*spec.key).distinct()


def value_index(df: DataFrame, target: str, spec: TableSpec, kind: str = "value") -> DataFrame:
    """Secondary index rows (``value``, key) on a cell, a key column or inside a collection.

    ``kind``: value | values (list or set elements, map values) | keys | entries.
    """
    c = F.col(target)
    is_map = df.schema[target].dataType.typeName() == "map"
    if kind == "value":
        return df.filter(c.isNotNull()).select(c.alias("value"), *spec.key)
    items: Column = {
        "values": F.array_distinct(F.map_values(c) if is_map else c),
        "keys": F.map_keys(c) if is_map else c,
        "entries": F.map_entries(c) if is_map else c,
    }[kind]
    return df.select(F.explode(items).alias("value"), *spec.key)


def leading(value: Column) -> Column:
    """The first three characters of a string as a number, in the order of the strings; missing ones count as zero."""
    at = lambda i: F.coalesce(F.ascii(F.substring(value, i, 1)), F.lit(0)).cast("long")
    return F.shiftleft(at(1), 42) + F.shiftleft(at(2), 21) + at(3)


def write_index(index: DataFrame, path: str, by: str, mode: str = "overwrite", only_leading: bool = False) -> None:
    """Store an index as files that are each sorted by its value, so that a lookup reads few pages of a file.

    Every task writes the rows it makes. One order over all files would need a sample of the rows first, which
    makes them twice, and a shuffle of them all. A value shared by many rows lies in the files of its rows.
    ``only_leading`` sorts by the value's first three characters alone, all that a gram has: one number sorts in
    linear time, while rows of equal grams are compared whole, again and again. Their terms stay in any order.
    """
    order = [leading(F.col(by))] if only_leading else [by] + [c for c in index.columns if c != by]
    index.sortWithinPartitions(*order).write.mode(mode).parquet(path)


def lookup(index: DataFrame, predicate: Column, spec: TableSpec) -> DataFrame:
    """Distinct keys of the index rows that match."""
    return index.filter(predicate).select(*spec.key).distinct()


def fetch(df: DataFrame, keys: DataFrame, spec: TableSpec, recheck: Column | None = None) -> DataFrame:
    """Rows of the found keys; ``recheck`` drops index entries that are out of date."""
    rows = df.join(keys, spec.key, "left_semi")
    return rows if recheck is None else rows.filter(recheck)


def like_predicate(pattern: str, mode: str = "prefix") -> Column:
    """LIKE against index rows; in ``contains`` mode infix search is a prefix of a suffix."""
    kind, text = like_kind(pattern)
    if mode == "contains":
        s = F.col("suffix")
        return {"prefix": F.col("whole") & s.startswith(text), "suffix": s == text,
                "contains": s.startswith(text), "equals": F.col("whole") & (s == text)}[kind]
    return term_matches(kind, text)(F.col("term"))


def numeric_range(column: str, lower=None, upper=None, lower_inclusive: bool = True,
                  upper_inclusive: bool = True) -> Column:
    """Bounds of several predicates on one indexed column, combined into one range."""
    terms = []
    if lower is not None:
        terms.append(F.col(column) >= lower if lower_inclusive else F.col(column) > lower)
    if upper is not None:
        terms.append(F.col(column) <= upper if upper_inclusive else F.col(column) < upper)
    out = terms[0]
    for t in terms[1:]:
        out = out & t
    return out
