import datetime as dt
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellspark.functions import aggregates as A
from cellspark.functions import blob, duration, jsonfn, literals, numeric, timeuuid, token
from cellspark.functions.stemming import stem_english


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


# Public values: tokens of single int keys.
@pytest.mark.parametrize("key, expected", [
    (0, -3485513579396041028), (1, -4069959284402364209), (2, -3248873570005575792), (3, 9010454139840013625)])
def test_murmur3_of_int_keys(spark, key, expected):
    assert one(spark, token.token([F.lit(key)], ["int"], "murmur3")) == (expected,)


def test_murmur3_empty_and_null(spark):
    assert one(spark, token.token([F.lit("")], ["text"], "murmur3")) == (-(1 << 63),)
    assert one(spark, token.token([F.lit(None).cast("string")], ["text"], "murmur3")) == (None,)


def test_murmur3_batches_agree_with_single_keys(spark):
    rng = np.random.default_rng(5)
    for length in (1, 7, 8, 15, 16, 17, 31, 32, 40):
        keys = rng.integers(0, 256, (20, length), dtype=np.uint8)
        together = token.murmur3_batch(keys)
        alone = np.concatenate([token.murmur3_batch(keys[i:i + 1]) for i in range(20)])
        assert (together == alone).all()


def test_murmur3_tail_is_sign_extended():
    # a tail byte above 127 must not act like the unsigned byte: flipping its sign bit changes
    # the high word of the block as well, so the two differ from a plain unsigned hash
    a = token.murmur3_batch(np.array([[0x80]], np.uint8))[0]
    assert a != token.murmur3_batch(np.array([[0x00]], np.uint8))[0]


def test_composite_key_bytes(spark):
    got = one(spark, token.key_bytes([(F.lit(1), "int"), (F.lit("ab"), "text")]))[0]
    assert bytes(got) == b"\x00\x04\x00\x00\x00\x01\x00" + b"\x00\x02ab\x00"


@pytest.mark.parametrize("value, kind", [
    (-5, "tinyint"), (300, "smallint"), (-70000, "int"), (1 << 40, "bigint"), ("zoë", "text"), (True, "boolean"),
    (2.5, "double"), (-0.25, "float"), (dt.date(1969, 12, 31), "date"),
    ("123e4567-e89b-12d3-a456-426655440000", "uuid")])
def test_blob_round_trip(spark, value, kind):
    sql = {"text": "string", "uuid": "string"}.get(kind, kind)
    c = F.lit(value).cast(sql)
    assert one(spark, blob.blob_as(blob.as_blob(c, kind), kind)) == (value,)


def test_blob_layout(spark):
    got = one(spark, blob.as_blob(F.lit(1.5), "double"), blob.as_blob(F.lit(-2), "int"),
              blob.as_blob(F.lit(dt.date(1970, 1, 1)), "date"))
    assert [bytes(b) for b in got] == [struct.pack(">d", 1.5), b"\xff\xff\xff\xfe", b"\x80\x00\x00\x00"]


def test_blob_wrong_length(spark):
    with pytest.raises(Exception, match="expected 4 bytes"):
        one(spark, blob.blob_as(F.unhex(F.lit("0102")), "int"))


def test_timeuuid_bounds(spark):
    ts = F.lit("2012-05-30 13:44:37.123").cast("timestamp")
    low, high = one(spark, timeuuid.min_timeuuid(ts), timeuuid.max_timeuuid(ts))
    assert low.endswith("-8080-808080808080") and high.endswith("-7f7f-7f7f7f7f7f7f")
    assert low[14] == high[14] == "1"
    ms = one(spark, timeuuid.to_unix_millis(F.lit(low)), timeuuid.to_unix_millis(F.lit(high)))
    assert ms == (1338385477123, 1338385477123)


def test_timeuuid_order(spark):
    ids = ["00000000-0000-1000-8080-808080808080", "00000000-0000-1000-ff00-000000000000",
           "00000000-0000-1000-0000-000000000000", "00000000-0000-1000-7f7f-7f7f7f7f7f7f",
           "00000001-0000-1000-8080-808080808080", "00000000-0001-1000-8080-808080808080"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(ids)], "i int, u string")
    assert [r.i for r in df.orderBy(timeuuid.order_key(F.col("u"))).collect()] == [0, 1, 2, 3, 4, 5]


def test_now_is_version_1(spark):
    u = spark.range(3).select(timeuuid.now().alias("u")).collect()
    assert len({r.u for r in u}) == 3 and all(r.u[14] == "1" for r in u)


@pytest.mark.parametrize("text, expected", [
    ("1y2mo", (14, 0, 0)), ("-1y2mo", (-14, 0, 0)), ("5m20s", (0, 0, 320 * 10**9)), ("2w3d", (0, 17, 0)),
    ("10ms5us7ns", (0, 0, 10005007)), ("10MS", (0, 0, 10**7)), ("P1Y2M10D", (14, 10, 0)), ("P3W", (0, 21, 0)),
    ("PT1H30M", (0, 0, 5400 * 10**9)), ("-PT10S", (0, 0, -10**10)), ("P0000-01-02T03:04:05", (1, 2, 11045 * 10**9))])
def test_duration(spark, text, expected):
    assert tuple(one(spark, duration.parse_duration(F.lit(text)))[0]) == expected


@pytest.mark.parametrize("text", ["", "1x", "2d1y", "1y1y"])
def test_bad_duration(spark, text):
    with pytest.raises(Exception):
        one(spark, duration.parse_duration(F.lit(text)))


@pytest.mark.parametrize("text, micros", [
    ("2011-02-03 04:05", 1296705900000000), ("2011-02-03 04:05:06.078", 1296705906078000),
    ("2011-02-03T04:05+0000", 1296705900000000), ("2011-02-03 04:05-03", 1296716700000000),
    ("2011-02-03T04:05:06.078+01:30", 1296700506078000), ("2011-02-03+0000", 1296691200000000),
    ("2011-02-03 04:05:00 UTC", 1296705900000000), ("-1", -1000)])
def test_timestamp_literals(spark, text, micros):
    assert one(spark, F.unix_micros(literals.parse_timestamp(F.lit(text)))) == (micros,)


def test_bad_literals(spark):
    for c in (literals.parse_timestamp(F.lit("yesterday")), literals.parse_date(F.lit("2011/01/01")),
              literals.parse_time(F.lit("25:00:00"))):
        with pytest.raises(Exception, match="not a"):
            one(spark, c)


def test_date_and_time_literals(spark):
    got = one(spark, literals.parse_date(F.lit("2147483648")), literals.parse_date(F.lit("2147483647")),
              literals.parse_time(F.lit("23:59:59.999999999")), literals.time_text(F.lit(86399999999999)))
    assert got == (dt.date(1970, 1, 1), dt.date(1969, 12, 31), 86399999999999, "23:59:59.999999999")


def test_integer_casts(spark):
    c = lambda v, s, d: numeric.cast_to(F.lit(v).cast(s), s, d)
    assert one(spark, c(300, "int", "tinyint"), c(-129, "int", "tinyint"), c(3e10, "double", "int"),
               c(-1e30, "double", "bigint"), c(float("nan"), "double", "int"), c(1e10, "double", "smallint"),
               c(None, "int", "tinyint")) == (44, 127, 2147483647, -(1 << 63), 0, -1, None)


def test_decimal_casts(spark):
    got = one(spark, numeric.cast_to(F.lit(1.1), "double", "decimal", 3),
              numeric.cast_to(F.lit("99999999999.7").cast("decimal(20,1)"), "decimal(20,1)", "int"))
    assert [str(x) for x in got] == ["1.100", "1215752191"]


def test_sum_and_avg_wrap(spark):
    df = spark.range(5).select(F.lit(2147483647).alias("i"), F.lit(9223372036854775807).alias("b"))
    got = df.agg(A.sum_of(F.col("i"), "int"), A.avg_of(F.col("i"), "int"), A.sum_of(F.col("b"), "bigint"),
                 A.avg_of(F.col("b"), "bigint")).first()
    assert tuple(got) == (2147483643, 2147483647, 9223372036854775803, 9223372036854775807)


def test_avg_rounds_half_even_and_truncates(spark):
    df = spark.createDataFrame([(1, "0.10"), (2, "0.15")], "i int, d string").withColumn("d", F.col("d").cast("decimal(10,2)"))
    got = df.agg(A.avg_of(F.col("i"), "int").alias("a"), A.avg_of(-F.col("i"), "int").alias("b"),
                 A.avg_of(F.col("d"), "decimal", 2).alias("c")).first()
    assert (got.a, got.b, str(got.c)) == (1, -1, "0.12")


def test_aggregates_of_nothing(spark):
    got = spark.range(0).agg(A.sum_of(F.col("id"), "bigint"), A.avg_of(F.col("id"), "bigint"),
                             A.sum_of(F.col("id"), "double"), A.avg_of(F.col("id"), "double"),
                             A.count_rows(), A.max_of(F.col("id"))).first()
    assert tuple(got) == (0, 0, 0.0, 0.0, 0, None)


def test_json_of_values(spark):
    df = spark.createDataFrame([({"a": 1, "b": None}, bytearray(b"ab"), 'q"x')], "m map<string,int>, b binary, s string")
    kinds = {f.name: f.dataType for f in df.schema.fields}
    got = df.select(*[jsonfn.to_json(F.col(c), kinds[c]).alias(c) for c in df.columns]).first()
    assert tuple(got) == ('{"a":1,"b":null}', '"0x6162"', '"q\\"x"')


def test_json_in(spark):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.ArrayType(T.LongType()))])
    df = spark.createDataFrame([('{"A": "12", "b": [1, "2"]}',)], "j string")
    got = jsonfn.row_from_json(df, "j", schema).first()
    assert (got.a, got.b, sorted(got._set)) == (12, [1, 2], ["a", "b"])
    bad = spark.createDataFrame([('{"nope": 1}',)], "j string")
    with pytest.raises(Exception, match="unknown column"):
        jsonfn.row_from_json(bad, "j", schema).collect()


def test_user_type_from_json(spark):
    kind = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("Big", T.StringType()),
                         T.StructField("u", T.StructType([T.StructField("x", T.LongType())]))])
    parse = lambda text: one(spark, jsonfn.from_json(F.lit(text), kind))[0]
    assert parse('{"A": "7", "\\"Big\\"": "y", "u": {"X": 5}}').asDict(recursive=True) == {"a": 7, "Big": "y", "u": {"x": 5}}
    assert parse("null") is None
    with pytest.raises(Exception, match="unknown field"):
        parse('{"nope": 1}')


@pytest.mark.parametrize("word, stem", [
    ("caresses", "caress"), ("ponies", "poni"), ("cats", "cat"), ("agreed", "agre"), ("plastered", "plaster"),
    ("motoring", "motor"), ("hopping", "hop"), ("filing", "file"), ("happy", "happi"), ("relational", "relat"),
    ("conditional", "condit"), ("triplicate", "triplic"), ("goodness", "good"), ("revival", "reviv"),
    ("adjustment", "adjust"), ("adoption", "adopt"), ("probate", "probat"), ("controll", "control"), ("sky", "sky"),
    ("été", "été")])
def test_porter_examples(word, stem):
    assert stem_english(word) == stem
