"""Prices of a half over a bucket's bound fall where the oracle SQL puts them."""

import duckdb

from cellspark.plans import ORACLE, QUERIES


def test_halves_go_to_the_even_price(spark, tmp_path, rows):
    prices = [0.5, 1.5, 2.5, 3.5, 4.5, 12.5, 14.5, 102.5, 104.5, 20.49, 20.51, 0.0, -2.5, 9999.5] + [float(b) + 0.5 for b in range(200)]
    path = str(tmp_path / "lineitem.parquet")
    duckdb.sql(f"COPY (SELECT unnest({prices})::DOUBLE AS l_extendedprice) TO '{path}' (FORMAT parquet)")
    want = duckdb.sql(ORACLE["n1_histogram"].replace("FROM lineitem", f"FROM '{path}'")).fetchall()
    assert rows(QUERIES["n1_histogram"](spark, str(tmp_path))) == sorted(want)
