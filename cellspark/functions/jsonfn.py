"""JSON text of values and rows, and parsing back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the JSON form of a timestamp.
TIMESTAMP_JSON = "yyyy-MM-dd HH:mm:ss.SSS'Z'"
KEEP_NULLS = {"ignoreNullFields": "false"}


def _jsonable(value: Column, dtype: T.DataType) -> Column:
    """Give blobs and timestamps their JSON text forms at any depth."""
    if isinstance(dtype, T.BinaryType):
        return F.concat(F.lit("0x"), F.lower(F.hex(value)))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(value, TIMESTAMP_JSON)
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda x: _jsonable(x, dtype.elementType))
    if isinstance(dtype, T.MapType):
        return F.transform_values(value, lambda k, v: _jsonable(v, dtype.valueType))
    if isinstance(dtype, T.StructType):
        inner = F.struct(*[_jsonable(value[f.name], f.dataType).alias(f.name) for f in dtype.fields])
        return F.when(value.isNotNull(), inner)
    return value


def to_json(value: Column, dtype: T.DataType) -> Column:
    """JSON text of any value; null gives the text ``null``."""
    shown = _jsonable(value, dtype)
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        text = F.to_json(shown, KEEP_NULLS)
    else:
        # scalars: render as a one-element array and drop the brackets
        text = F.regexp_extract(F.to_json(F.array(shown), KEEP_NULLS), r"(?s)^\[(.*)\]$", 1)
        text = F.when(value.isNotNull(), text)
    return F.coalesce(text, F.lit("null"))


def tuple_json(value: Column, dtype: T.StructType) -> Column:
    """JSON text of a tuple: an array of its fields."""
    parts = [to_json(value[f.name], f.dataType) for f in dtype.fields]
    text = F.concat(F.lit("["), F.concat_ws(", ", *parts), F.lit("]"))
    return F.coalesce(F.when(value.isNotNull(), text), F.lit("null"))


def quoted(name: str) -> str:
    """Names that are not all lower case keep their case through an extra pair of quotes."""
    return name if name == name.lower() else f'"{name}"'


def row_json(df: DataFrame, columns: list[str] | None = None) -> Column:
    """``SELECT JSON``: one text column holding the whole row."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    columns = columns or list(fields)
    return F.to_json(
        F.struct(*[_jsonable(F.col(c), fields[c]).alias(quoted(c)) for c in columns]), KEEP_NULLS)


def _lenient(dtype: T.DataType) -> T.DataType:
    """Numbers may come as text: read leaves as text first."""
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_lenient(dtype.elementType))
    if isinstance(dtype, T.MapType):
        return T.MapType(T.StringType(), _lenient(dtype.valueType))
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _lenient(f.dataType)) for f in dtype.fields])
    return T.StringType()


def _typed(value: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda x: _typed(x, dtype.elementType))
    if isinstance(dtype, T.MapType):
        return F.transform_values(
            F.transform_keys(value, lambda k, v: _typed(k, dtype.keyType)),
            lambda k, v: _typed(v, dtype.valueType))
    if isinstance(dtype, T.StructType):
        made = F.struct(*[_typed(value[f.name], f.dataType).alias(f.name) for f in dtype.fields])
        return F.when(value.isNotNull(), made)
    if isinstance(dtype, T.BinaryType):
        return F.unhex(F.substring(value, 3, 1 << 30))
    return value.cast(dtype)


def from_json(text: Column, dtype: T.DataType) -> Column:
    """Parse JSON text into ``dtype``; numbers given as text are accepted, bad input is an error.

    Fields of a struct are found by the case rule (quoted names keep their case, others are
    lower); an unknown field is an error.
    """
    if isinstance(dtype, T.StructType):
        known = F.array(*[F.lit(f.name) for f in dtype.fields])

        def build(m: Column) -> Column:
            made = F.struct(*[_cell(F.try_element_at(m, F.lit(f.name)), f.dataType).alias(f.name)
                              for f in dtype.fields])
            unknown = F.array_except(F.map_keys(m), known)
            error = F.raise_error(F.concat(F.lit("unknown field in JSON: "), F.array_join(unknown, ", ")))
            return F.when(F.size(unknown) > 0, error.cast(dtype)).otherwise(made)

        present = text.isNotNull() & (text != "null")
        # the one-element array binds the parsed map, so that it is not parsed once per field
        return F.when(present, F.element_at(F.transform(F.array(_named(text)), build), 1))
    wrapper = T.StructType([T.StructField("x", _lenient(dtype))])
    parsed = F.from_json(F.concat(F.lit('{"x":'), text, F.lit("}")), wrapper, {"mode": "FAILFAST"})
    return _typed(parsed["x"], dtype)


def _cell(text: Column, dtype: T.DataType) -> Column:
    """A value out of a map of JSON texts: nested values are JSON, scalars bare text."""
    nested = isinstance(dtype, (T.ArrayType, T.MapType, T.StructType))
    return from_json(text, dtype) if nested else _typed(text, dtype)


def _named(text: Column) -> Column:
    """A JSON object as a map of name (case rule applied) to text."""
    raw = F.from_json(text, T.MapType(T.StringType(), T.StringType()), {"mode": "FAILFAST"})
    return F.transform_keys(raw, lambda k, v: F.when(
        k.rlike('^".*"$'), F.regexp_replace(k, '^"|"$', "")).otherwise(F.lower(k)))


def row_from_json(df: DataFrame, text: str, schema: T.StructType) -> DataFrame:
    """``INSERT JSON``: typed columns, the names present, and an error on unknown names.

    ``_set`` lists the names that occur in the text, so that a caller can tell an
    explicit null from a missing name.
    """
    known = F.array(*[F.lit(f.name) for f in schema.fields])
    unknown = F.array_except(F.map_keys(F.col("_raw")), known)

    def read(f: T.StructField) -> Column:
        return _cell(F.try_element_at(F.col("_raw"), F.lit(f.name)), f.dataType)

    parsed = df.withColumn("_raw", _named(F.col(text)))
    checked = F.when(F.size(unknown) > 0, F.raise_error(
        F.concat(F.lit("unknown column in JSON: "), F.array_join(unknown, ", "))).cast("array<string>")
    ).otherwise(F.map_keys(F.col("_raw")))
    return parsed.select("*", *[read(f).alias(f.name) for f in schema.fields],
                         checked.alias("_set")).drop("_raw")
