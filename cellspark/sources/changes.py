"""A table's state as cells, as ordered change statements and as a JSON dump."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellspark.functions import jsonfn
from cellspark.spec import TableSpec


def _text(state: DataFrame, c: str) -> Column:
    return F.col(f"{c}.v").cast("string") if state.schema[c].dataType["v"].dataType.typeName() not in (
        "array", "map", "struct") else jsonfn.to_json(F.col(f"{c}.v"), state.schema[c].dataType["v"].dataType)


def cells(state: DataFrame, spec: TableSpec) -> DataFrame:
    """One row per stored cell: key, column, value text, write time, ttl, deletion time, dead."""
    one = lambda c: F.when(F.col(c).isNotNull(), F.struct(
        F.lit(c).alias("column"), _text(state, c).alias("value"), F.col(f"{c}.ts").alias("ts"),
        F.col(f"{c}.ttl").alias("ttl"), F.col(f"{c}.ldt").alias("ldt"), F.col(f"{c}.dead").alias("dead")))
    every = F.array_compact(F.array(*[one(c) for c in spec.regular]))
    return state.select(*spec.key, F.explode(every).alias("_c")).select(*spec.key, "_c.*")


def to_changes(state: DataFrame, spec: TableSpec, table: str | None = None) -> DataFrame:
    """Change statements that rebuild a table, one per row, kind, timestamp and TTL.

    Columns: key, ``kind`` (insert, update, delete, delete_row), ``ts``, ``ttl``, ``set``
    (column to value text) and ``statement``. The cells of one row written at the same time
    share a statement. Everything is built inside the row: no shuffle.
    """
    name = table or spec.name
    lowest = F.lit(None).cast("int")
    parts = [
        F.when(F.col(c).isNotNull(), F.struct(
            F.when(F.col(f"{c}.dead"), "delete").when(
                F.col(f"{c}.ts").eqNullSafe(F.col("_live.ts"))
                & F.col(f"{c}.ttl").eqNullSafe(F.col("_live.ttl")), "insert").otherwise("update").alias("kind"),
            F.col(f"{c}.ts").alias("ts"), F.when(~F.col(f"{c}.dead"), F.col(f"{c}.ttl")).alias("ttl"),
            F.lit(c).alias("name"), _text(state, c).alias("value")))
        for c in spec.regular
    ]
    row_marks = [
        F.when(F.col("_live").isNotNull(), F.struct(
            F.lit("insert").alias("kind"), F.col("_live.ts").alias("ts"), F.col("_live.ttl").alias("ttl"),
            F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("value"))),
        F.when(F.col("_del").isNotNull(), F.struct(
            F.lit("delete_row").alias("kind"), F.col("_del.ts").alias("ts"), lowest.alias("ttl"),
            F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("value"))),
    ]
    every = F.array_compact(F.array(*row_marks, *parts))
    heads = F.array_distinct(F.transform(every, lambda x: F.struct(x["kind"], x["ts"], x["ttl"])))
    grouped = F.transform(heads, lambda h: F.struct(
        h["kind"].alias("kind"), h["ts"].alias("ts"), h["ttl"].alias("ttl"),
        F.filter(every, lambda x: (x["kind"] == h["kind"]) & (x["ts"] == h["ts"])
                 & x["ttl"].eqNullSafe(h["ttl"]) & x["name"].isNotNull()).alias("items")))
    rows = state.select(*spec.key, F.explode(grouped).alias("_g")).select(
        *spec.key, "_g.kind", "_g.ts", "_g.ttl",
        F.map_from_entries(F.transform("_g.items", lambda x: F.struct(x["name"], x["value"]))).alias("set"))
    return rows.withColumn("statement", _statement(rows, spec, name))


def _quoted(df: DataFrame, c: str) -> Column:
    kind = df.schema[c].dataType.typeName()
    text = F.col(c).cast("string")
    numeric = kind in ("byte", "short", "integer", "long", "float", "double", "decimal", "boolean")
    return text if numeric else F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("''")), F.lit("'"))


def _statement(rows: DataFrame, spec: TableSpec, table: str) -> Column:
    """Readable text of a change; values appear as quoted text."""
    where = F.concat_ws(" AND ", *[F.concat(F.lit(f"{c} = "), _quoted(rows, c)) for c in spec.key])
    key_values = F.concat_ws(", ", *[_quoted(rows, c) for c in spec.key])
    quote = lambda v: F.coalesce(
        F.concat(F.lit("'"), F.replace(v, F.lit("'"), F.lit("''")), F.lit("'")), F.lit("null"))
    names = F.array_join(F.map_keys("set"), ", ")
    values = F.array_join(F.transform(F.map_values("set"), quote), ", ")
    pairs = F.array_join(F.transform(F.map_entries("set"), lambda e: F.concat(
        e["key"], F.lit(" = "), quote(e["value"]))), ", ")
    stamp = F.concat(F.lit(" USING TIMESTAMP "), F.col("ts").cast("string"))
    ttl = F.when(F.col("ttl").isNotNull(), F.concat(F.lit(" AND TTL "), F.col("ttl").cast("string"))).otherwise("")
    comma = F.when(F.size("set") > 0, ", ").otherwise("")
    keys = ", ".join(spec.key)
    return (
        F.when(F.col("kind") == "insert", F.concat(
            F.lit(f"INSERT INTO {table} ({keys}"), comma, names, F.lit(") VALUES ("), key_values, comma,
            values, F.lit(")"), stamp, ttl))
        .when(F.col("kind") == "update", F.concat(
            F.lit(f"UPDATE {table}"), stamp, ttl, F.lit(" SET "), pairs, F.lit(" WHERE "), where))
        .when(F.col("kind") == "delete", F.concat(
            F.lit("DELETE "), names, F.lit(f" FROM {table}"), stamp, F.lit(" WHERE "), where))
        .otherwise(F.concat(F.lit(f"DELETE FROM {table}"), stamp, F.lit(" WHERE "), where)))


def range_changes(ranges: DataFrame, spec: TableSpec, table: str | None = None) -> DataFrame:
    """Change statements of range tombstones."""
    first = spec.ck[0]
    bound = lambda side, inc, ops: F.when(F.col(side).isNotNull(), F.concat(
        F.lit(f"{first} "), F.when(F.col(inc), ops[0]).otherwise(ops[1]), F.lit(" "), F.col(side).cast("string")))
    where = F.concat_ws(" AND ", *[F.concat(F.lit(f"{c} = "), _quoted(ranges, c)) for c in spec.pk],
                        bound("lo", "lo_incl", (">=", ">")), bound("hi", "hi_incl", ("<=", "<")))
    text = F.concat(F.lit(f"DELETE FROM {table or spec.name} USING TIMESTAMP "),
                    F.col("_ts").cast("string"), F.lit(" WHERE "), where)
    return ranges.select(*spec.pk, F.lit("delete_range").alias("kind"), F.col("_ts").alias("ts"),
                         text.alias("statement"))


def dump_json(state: DataFrame, spec: TableSpec, now: int, keys: DataFrame | None = None,
              exclude: DataFrame | None = None, raw_times: bool = False) -> DataFrame:
    """A JSON document per row of the table (one line per row).

    Fields: partition key, type, clustering, liveness_info, deletion_info and cells. Lines
    instead of one document per partition keep a hot partition from becoming one value.
    """
    rows = state
    if keys is not None:
        rows = rows.join(keys.select(*spec.pk).distinct(), spec.pk, "left_semi")
    if exclude is not None:
        rows = rows.join(exclude.select(*spec.pk).distinct(), spec.pk, "left_anti")
    micros = lambda c: c.cast("string") if raw_times else F.date_format(
        F.timestamp_micros(c), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    seconds = lambda c: c.cast("string") if raw_times else F.date_format(
        F.timestamp_seconds(c), "yyyy-MM-dd'T'HH:mm:ss'Z'")

    def cell(c: str) -> Column:
        x = F.col(c)
        return F.when(x.isNotNull(), F.struct(
            F.lit(c).alias("name"), F.when(~x["dead"] | x["ttl"].isNotNull(), _text(state, c)).alias("value"),
            micros(x["ts"]).alias("tstamp"), x["ttl"].alias("ttl"),
            F.when(x["ttl"].isNotNull(), seconds(x["ldt"])).alias("expires_at"),
            F.when(x["ttl"].isNotNull(), x["ldt"] <= now).alias("expired"),
            F.when(x["dead"] & x["ttl"].isNull(), F.struct(
                seconds(x["ldt"]).alias("local_delete_time"))).alias("deletion_info")))

    live, gone = F.col("_live"), F.col("_del")
    doc = F.struct(
        F.struct(F.array(*[F.col(c).cast("string") for c in spec.pk]).alias("key")).alias("partition"),
        F.lit("row").alias("type"),
        F.array(*[F.col(c).cast("string") for c in spec.ck]).alias("clustering"),
        F.when(live.isNotNull(), F.struct(
            micros(live["ts"]).alias("tstamp"), live["ttl"].alias("ttl"),
            F.when(live["expiring"], seconds(live["exp"])).alias("expires_at"),
            F.when(live["expiring"], live["expired"]).alias("expired"))).alias("liveness_info"),
        F.when(gone.isNotNull(), F.struct(
            micros(gone["ts"]).alias("marked_deleted"),
            seconds(gone["ldt"]).alias("local_delete_time"))).alias("deletion_info"),
        F.array_compact(F.array(*[cell(c) for c in spec.regular])).alias("cells"))
    return rows.select(*spec.key, F.to_json(doc).alias("json"))


def dump_keys(state: DataFrame, spec: TableSpec) -> DataFrame:
    """Only the partition keys, as JSON arrays."""
    keys = state.select(*spec.pk).distinct()
    return keys.select(F.to_json(F.array(*[F.col(c).cast("string") for c in spec.pk])).alias("json"))

