"""What the operators share: columns appended in Arrow batches, safe input columns, tokenizer files."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer file; it is installed on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def without(df: DataFrame, names: list[str]) -> list[str]:
    """Columns of ``df`` that don't clash with ``names``, which differ by more than case."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


#: What tasks of this worker keep for later ones, by the operator's module, and how to let it go.
_kept: dict[str, Callable[[], None]] = {}


def keep(owner: str, release: Callable[[], None]) -> None:
    """Something is kept in this worker for the next tasks of ``owner``; the first task of another operator releases it."""
    _kept[owner] = release


def release_others(owner: str) -> None:
    for other in [o for o in _kept if o != owner]:
        _kept.pop(other)()


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError, TypeError):  # another C library
    _trim = None


def give_back() -> None:
    """Hands freed memory back to the system: a worker lives on for other tasks, and what it keeps counts for the executor."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def append_columns(
    df: DataFrame,
    inputs: list[str],
    fields: list[StructField],
    make: Callable[[], Callable[..., list[pa.Array]]],
    rows: int = 256,
) -> DataFrame:
    """Append columns that Python computes from ``inputs``, in Arrow batches of at most ``rows`` rows.

    ``make`` runs once in each task and returns the function of the input arrays. A column of
    ``df`` with the name of a new one is replaced. No shuffle; rows keep their place, so a lost
    executor costs a rerun of its own tasks.
    """
    kept = without(df, [f.name for f in fields])
    schema = StructType([df.schema[c] for c in kept] + fields)
    places = {c: i for i, c in enumerate(df.columns)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_others(make.__module__)
        compute = make()
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                new = compute(*[part.column(places[c]) for c in inputs])
                yield pa.RecordBatch.from_arrays([part.column(places[c]) for c in kept] + new, names=schema.names)
        give_back()

    return df.mapInArrow(run, schema)


def whole(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the key and the text, under fixed names: extra columns can't clash with anything."""
    return df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def texts(column: pa.Array) -> list[str]:
    """Texts of a batch; null counts as empty."""
    return [t or "" for t in column.to_pylist()]


#: White space for ``str.split`` that is part of a word here.
_INSIDE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def words(text: str) -> list[str]:
    """Maximal runs of characters other than blank, tab, line feed and their kin (9 to 13)."""
    return _WORDS.findall(text) if _INSIDE.search(text) else text.split()


#: A found span: code points, end exclusive. ``place`` is the rank of its kind among spans that start together.
SPAN = StructType([
    StructField("start", IntegerType()), StructField("place", IntegerType()),
    StructField("kind", StringType()), StructField("end", IntegerType())])


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def replace_spans(text: Column, spans: Column, mask: Callable[[Column], Column]) -> Column:
    """The text with every span replaced by ``mask(span)``; spans sorted by start, a later overlap keeps its rest."""
    start = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))

    def step(acc, s):
        begin = F.greatest(acc["at"], s["start"])
        return F.when(s["end"] <= acc["at"], acc).otherwise(F.struct(
            F.concat(acc["done"], F.substring(text, acc["at"] + 1, begin - acc["at"]), mask(s)).alias("done"),
            s["end"].alias("at")))

    whole_length = F.length(text)
    return F.aggregate(spans, start, step, lambda acc: F.concat(
        acc["done"], F.substring(text, acc["at"] + 1, whole_length - acc["at"])))
