"""User-defined function and aggregate queries."""

from pyspark.sql import functions as F

from cellspark.functions import udf
from cellspark.plans.registry import query


@query("u1_column_function", """
SELECT doc_id, CASE WHEN quality IS NOT NULL AND toxic IS NOT NULL THEN quality * 10 + toxic END AS strict,
  coalesce(quality, -1) * 10 + coalesce(toxic, -1) AS lenient
FROM documents LEFT JOIN labels USING (doc_id)""")
def column_function(t):
    rows = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    strict = udf.column_function(lambda q, x: q * 10 + x)
    lenient = udf.column_function(lambda q, x: F.coalesce(q, F.lit(-1)) * 10 + F.coalesce(x, F.lit(-1)), udf.CALLED)
    return rows.select("doc_id", strict("quality", "toxic").alias("strict"), lenient("quality", "toxic").alias("lenient"))


@query("u1_python_function", """
SELECT p_partkey, string_agg(upper(w[1]) || w[2:], ' ' ORDER BY i) AS title
FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w, generate_subscripts(string_split(p_name, ' '), 1) AS i FROM part) GROUP BY p_partkey""")
def python_function(t):
    title = udf.python_function(lambda s: " ".join(w[:1].upper() + w[1:] for w in s.split(" ")), "string")
    return t.part.select("p_partkey", title("p_name").alias("title"))


@query("u1_sql_function", "SELECT p_partkey, p_size * 2 + 1 AS y FROM part")
def sql_function(t):
    udf.register_expression(t.spark, "twice_plus_one", "x INT", "INT", "x * 2 + 1", replace=True)
    return t.part.select("p_partkey", F.expr("twice_plus_one(p_size)").alias("y"))


@query("u1_vector_function", "SELECT p_partkey, p_retailprice * 2 AS y FROM part")
def vector_function(t):
    double = udf.vector_function(lambda s: s * 2, "double")
    return t.part.select("p_partkey", double("p_retailprice").alias("y"))


_MOD = 1000003


@query("u3_fold_in_order", f"""
SELECT user_id, list_reduce(list(event_id ORDER BY ts, event_id), lambda a, x: (a * 31 + x) % {_MOD}, 7::BIGINT) AS value FROM events GROUP BY user_id""")
def fold_in_order(t):
    return udf.fold_groups(t.events, ["user_id"], ["ts", "event_id"], ["event_id"],
                           lambda s, x: (s * 31 + int(x)) % _MOD, "bigint", initial=7)


@query("u3_fold_with_merge", """
SELECT user_id, sum(event_id)::DOUBLE / count(*) AS value FROM events GROUP BY user_id""")
def fold_with_merge(t):
    return udf.fold_groups(
        t.events, ["user_id"], ["ts", "event_id"], ["event_id"],
        lambda s, x: [s[0] + int(x), s[1] + 1], "array<bigint>", initial=[0, 0],
        merge=lambda a, b: [a[0] + b[0], a[1] + b[1]], final=lambda s: s[0] / s[1] if s[1] else None, result_type="double")


@query("u4_nested_calls", "SELECT p_partkey, lower(p_name) || '!' || abs(p_size - 25) AS y FROM part WHERE length(p_name) > 9")
def nested_calls(t):
    mark = udf.column_function(lambda s: F.concat(s, F.lit("!")))
    gap = udf.column_function(lambda n: F.abs(n - 25))
    rows = t.part.filter(F.length("p_name") > 9)
    return rows.select("p_partkey", F.concat(mark(F.lower("p_name")), gap("p_size").cast("string")).alias("y"))


@query("u5_struct_result", """
SELECT p_partkey, string_split(p_name, ' ')[1] AS first, len(string_split(p_name, ' '))::INTEGER AS n_words FROM part""")
def struct_result(t):
    parts = udf.python_function(lambda s: {"first": s.split(" ")[0], "n_words": len(s.split(" "))},
                                "struct<first:string,n_words:int>")
    return t.part.select("p_partkey", parts("p_name").alias("u")).select("p_partkey", "u.*")
