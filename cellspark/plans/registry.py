"""Queries over the given tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from cellspark.spec import TableSpec

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

ORDERS = TableSpec(["o_custkey"], ["o_orderdate", "o_orderkey"], (),
                   ["o_orderstatus", "o_totalprice", "o_orderpriority"], name="orders")
EVENTS = TableSpec(["user_id"], ["ts", "event_id"], (), ["event_type", "value", "props"], name="events")
TURNS = TableSpec(["conv_id"], ["turn"], (), ["role", "text"], name="conversations")
LINES = TableSpec(["l_orderkey"], ["l_linenumber"], (),
                  ["l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus"], name="lineitem")
DOCS = TableSpec(["doc_id"], (), (), ["text", "lang", "source", "n_chars"], name="documents")


class Tables:
    """The given tables as attributes: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        if spark.conf.get("spark.sql.session.timeZone", "") != "UTC":
            spark.conf.set("spark.sql.session.timeZone", "UTC")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"


def _run(fn, spark: SparkSession, folder: str) -> DataFrame:
    return fn(Tables(spark, folder))


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)`` under ``name`` with its oracle SQL."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = partial(_run, fn)
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add
