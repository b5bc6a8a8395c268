"""CSV export and import of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellspark.functions.token import token as token_of
from cellspark.spec import TableSpec


def export_rows(df: DataFrame, spec: TableSpec, columns: list[str] | None = None, null_value: str = "",
                decimal_sep: str = ".", thousands_sep: str = "", bool_style: tuple[str, str] = ("True", "False"),
                begin_token: int | None = None, end_token: int | None = None) -> DataFrame:
    """Every cell as the text the CSV file will hold."""
    rows = df
    if begin_token is not None:
        rows = rows.filter(token_of(spec.pk) >= begin_token)
    if end_token is not None:
        rows = rows.filter(token_of(spec.pk) < end_token)
    out = []
    for name in columns or spec.columns:
        kind = df.schema[name].dataType
        c = F.col(name)
        if isinstance(kind, T.BooleanType):
            text = F.when(c, bool_style[0]).when(~c, bool_style[1])
        elif isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType, T.ByteType, T.ShortType,
                               T.IntegerType, T.LongType)):
            text = c.cast("string")
            if thousands_sep:
                whole = F.regexp_replace(F.regexp_extract(text, r"^(-?\d+)", 1),
                                         r"(\d)(?=(\d{3})+$)", "$1" + thousands_sep)
                fraction = F.regexp_extract(text, r"^-?\d+(.*)$", 1)
                text = F.concat(whole, F.replace(fraction, F.lit("."), F.lit(decimal_sep)))
            elif decimal_sep != ".":
                text = F.replace(text, F.lit("."), F.lit(decimal_sep))
        else:
            text = c.cast("string")
        out.append(F.coalesce(text, F.lit(null_value)).alias(name))
    return rows.select(*out)


def export_csv(rows: DataFrame, path: str, header: bool = False, delimiter: str = ",",
               max_rows_per_file: int | None = None) -> None:
    writer = rows.write.mode("overwrite").option("header", header).option("sep", delimiter).option(
        "emptyValue", "").option("escape", '"')
    if max_rows_per_file:
        writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    writer.csv(path)


def import_csv(spark: SparkSession, path: str, schema: T.StructType, key: list[str], header: bool = False,
               delimiter: str = ",", null_value: str = "", decimal_sep: str = ".", thousands_sep: str = "",
               bool_style: tuple[str, str] = ("True", "False"),
               skip_columns: tuple[str, ...] = (), max_rows: int = -1) -> tuple[DataFrame, DataFrame]:
    """(rows, errors) of a CSV folder.

    Lines that do not parse, and rows without a full key, are kept in ``errors`` with the
    reason; :func:`check_errors` applies a limit to them. ``max_rows`` reads at most that
    many lines. Quoted cells may hold line breaks, so a file is read by one task: export
    with ``max_rows_per_file`` to keep files small.
    """
    raw_schema = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields]
                              + [T.StructField("_corrupt", T.StringType())])
    raw = spark.read.schema(raw_schema).csv(
        path, header=header, sep=delimiter, mode="PERMISSIVE", escape='"',
        columnNameOfCorruptRecord="_corrupt", enforceSchema=True, multiLine=True)
    if max_rows >= 0:
        raw = raw.limit(max_rows)

    def text_of(f: T.StructField) -> Column:
        c = F.col(f.name)
        return F.when(c.isNotNull() & (c != null_value), c)

    def value(f: T.StructField) -> Column:
        text = text_of(f)
        if isinstance(f.dataType, T.BooleanType):
            return F.when(text == bool_style[0], True).when(text == bool_style[1], False)
        if isinstance(f.dataType, T.StringType):
            return text
        if thousands_sep:
            text = F.replace(text, F.lit(thousands_sep), F.lit(""))
        if decimal_sep != ".":
            text = F.replace(text, F.lit(decimal_sep), F.lit("."))
        return text.try_cast(f.dataType)

    used = [f for f in schema.fields if f.name not in skip_columns]
    bad = [F.when(text_of(f).isNotNull() & value(f).isNull(), F.lit(f.name)) for f in used]
    no_key = [F.when(value(f).isNull(), F.concat(F.lit("no key: "), F.lit(f.name)))
              for f in used if f.name in key]
    reason = F.when(F.col("_corrupt").isNotNull(), "wrong number of columns").otherwise(
        F.nullif(F.concat_ws(", ", *bad, *no_key), F.lit("")))
    judged = raw.withColumn("_reason", reason)
    rows = judged.filter(F.col("_reason").isNull()).select(*[value(f).alias(f.name) for f in used])
    line = F.coalesce(F.col("_corrupt"), F.concat_ws(delimiter, *[
        F.coalesce(F.col(f.name), F.lit("")) for f in schema.fields]))
    errors = judged.filter(F.col("_reason").isNotNull()).select(
        line.alias("line"), F.col("_reason").alias("reason"))
    return rows, errors


def check_errors(errors: DataFrame, limit: int) -> int:
    """Number of rejected lines; more than ``limit`` (if not negative) is an error."""
    n = errors.count()
    if 0 <= limit < n:
        raise ValueError(f"{n} lines could not be imported, more than {limit}")
    return n
