"""Quality rules: in-document repetition, and lines that recur across the documents of a host.

Lines are normalised (case, digits, punctuation at the ends and white space don't count) and hashed.
For every host the distinct documents of each line are counted; lines above the limit are taken off
(``clean`` gives the text without them), and a document that keeps too few of its words is rejected. Base rules reject texts with under ten
words, or with over a fifth of their words in five-word windows that recur in the text.

One pass over the texts writes a small record per row (counts, and the hash and word count of each
distinct line); all counting and joining works on these. Counts are combined before each shuffle, so a
line of a third of all documents costs one row per task. Null text: no words, rejected. Null host: a
host of its own. Repeated rows of one document count once; a null ``doc_id`` counts as one document.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from cellspark.llm.common import append_columns, texts, words
from cellspark.session import materialize

#: Fixed values of the contract.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS, WINDOW, REPEAT_PERCENT = 10, 5, 20

LINE = StructType([StructField("hash", LongType()), StructField("n", LongType())])
_DIGITS = re.compile("[0-9]+")


def repeated_words(found: list[str]) -> int:
    """Words in five-word windows that occur at least twice."""
    n = len(found) - WINDOW + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, found), np.int64, len(found)).view(np.uint64)
    mixed = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        mixed = (mixed ^ h[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    order = np.argsort(mixed, kind="stable")
    same = mixed[order[1:]] == mixed[order[:-1]]
    twice = np.zeros(n + 1, np.int64)
    twice[order[1:][same]] = 1
    twice[order[:-1][same]] = 1
    edge = np.zeros(len(found) + 1, np.int64)
    edge[:n] += twice[:n]
    edge[WINDOW : WINDOW + n] -= twice[:n]
    return int(np.count_nonzero(np.cumsum(edge[:-1])))


def line_key(line: str) -> int:
    """Hash of a line without what doesn't make it another line."""
    plain = _DIGITS.sub("0", " ".join(words(line.lower())).strip(" .,;:!?*#-|\"'()"))
    return xxhash.xxh3_64_intdigest(plain.encode()) - (1 << 63)


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """Append n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the distinct ``lines``."""
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def make():
        def one(t: str) -> tuple:
            found, seen, lines, dup = words(t), set(), {}, 0
            for line in t.split("\n"):
                if in_line := words(line):
                    dup += line in seen
                    seen.add(line)
                    key = line_key(line)
                    lines[key] = lines.get(key, 0) + len(in_line)
            return (len(found), sum(map(len, found)), sum(map(t.count, SYMBOLS)), dup, repeated_words(found),
                    [{"hash": k, "n": n} for k, n in lines.items()])

        def compute(column):
            kinds = [pa.int64()] * 5 + [pa.list_(pa.struct([("hash", pa.int64()), ("n", pa.int64())]))]
            rows = [one(t) for t in texts(column)]
            return [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]

        return compute

    return append_columns(df, [text], [StructField(c, LongType()) for c in counts] + [StructField("lines", ArrayType(LINE))], make)


def over_frequent(rows: DataFrame, max_documents: int) -> DataFrame:
    """(host, hash, n_documents) of the lines of ``rows`` in over ``max_documents`` documents of a host."""
    lines = rows.select("doc_id", "host", F.explode("lines").alias("line")).select("doc_id", "host", "line.hash")
    counts = lines.distinct().groupBy("host", "hash").agg(F.count("*").alias("n_documents"))
    return counts.filter(F.col("n_documents") > max_documents)


def clean(
    df: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", max_documents: int = 100, out: str = "clean_text",
) -> DataFrame:
    """Append ``out``: the text without the lines that ``judge`` counts as over-frequent. A null text stays null."""
    docs = df.withColumns({"__host": F.col(host).cast("string"), "__key": F.xxhash64(F.col(text).cast("string")), "__text": F.col(text).cast("string")})
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col("__host").alias("host"), F.col("__key").alias("key"), F.col("__text").alias("text"))
    rows = materialize(measure(rows).select("doc_id", "host", "key", "lines"), "lines")
    hits = rows.select("host", "key", F.explode("lines").alias("line")).select("host", "key", "line.hash").distinct()
    frequent = over_frequent(rows, max_documents)
    cut = (
        hits.join(frequent, (hits.host.eqNullSafe(frequent.host)) & (hits["hash"] == frequent["hash"]))
        .groupBy(hits.host.alias("__cut_host"), hits.key.alias("__cut_key")).agg(F.collect_list(hits["hash"]).alias("__cut"))
    )
    marked = docs.join(cut, F.col("__host").eqNullSafe(F.col("__cut_host")) & (F.col("__key") == F.col("__cut_key")), "left")

    def make():
        def left(t: str | None, gone: list[int] | None) -> str | None:
            if not t or not gone:
                return t
            own = set(gone)
            return "\n".join(x for x in t.split("\n") if not words(x) or line_key(x) not in own)

        return lambda column, gone: [pa.array(map(left, column.to_pylist(), gone.to_pylist()), pa.string())]

    done = append_columns(marked, ["__text", "__cut"], [StructField(out, StringType())], make)
    return done.drop("__host", "__key", "__text", "__cut_host", "__cut_key", "__cut")


def judge(
    df: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", max_documents: int = 100,
    least_left: float = 0.3,
) -> DataFrame:
    """One row per row of ``df``: its key, counts, ``base_failed``, words on over-frequent lines, and ``kept``.

    A line is over-frequent if more than ``max_documents`` documents of the host have it; a document
    that isn't left with ``least_left`` of its words is rejected.
    """
    rows = df.select(F.col(key).cast("long").alias("doc_id"), F.col(host).cast("string").alias("host"), F.col(text).cast("string").alias("text"))
    rows = materialize(measure(rows).drop("text"), "quality")
    frequent = over_frequent(rows, max_documents)
    numbered = rows.withColumn("row", F.xxhash64(F.col("doc_id"), F.col("host"), F.col("n_words"), F.col("lines")))
    hits = numbered.select("host", "row", F.explode(F.array_distinct("lines")).alias("line")).select("host", "row", "line.*").distinct()
    cut = (
        hits.join(frequent, (hits.host.eqNullSafe(frequent.host)) & (hits["hash"] == frequent["hash"]))
        .groupBy("row").agg(F.sum("n").alias("n_cut_words"))
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    out = numbered.join(cut, "row", "left").withColumn("n_cut_words", F.coalesce("n_cut_words", F.lit(0).cast("long")))
    depleted = F.col("n_words") - F.col("n_cut_words") < F.col("n_words") * least_left
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & ~depleted).alias("kept"), "n_cut_words")
