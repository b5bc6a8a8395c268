"""A corpus pipeline: language, near duplicates, repeated passages, personal data, packing.

Each stage takes all rows that the one before kept and returns the columns of ``documents``, but for
the last, which returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellspark.llm import langid, minhash, packing, passages, pii
from cellspark.llm.common import tokenizer_file
from cellspark.session import materialize


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a language: null texts and texts without a letter.

    The network rejects nothing beyond these: a text with a letter stays whatever its language and score,
    and if nothing is labelled, so that there is no network.
    """
    network = langid.train(docs.filter(~langid.held_out(F.col("doc_id"))))
    if network is None:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    return langid.predict(docs, network, lang="__lang", score="__score").filter(F.col("__lang") != langid.NO_LANGUAGE).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near duplicates: the smallest id, then the smallest hash of the text.

    Five-word shingles and 80 percent, the rule for stages; op9 has other values by contract. With 10 parts
    a link at the limit is missed with a probability under 1e-4. Rows without a word have no duplicates.
    """
    found = minhash.groups(docs, size=5, percent=80, parts=10).filter("n_shingles > 0")
    kept = found.groupBy("label").agg(F.min(F.struct("doc_id", "text_key")).alias("one")).select(F.col("one.doc_id").alias("__id"), F.col("one.text_key").alias("__key"))
    has_word = F.coalesce(F.col("text").rlike("[^\\x20\\x09-\\x0D]"), F.lit(False))
    named = docs.filter(has_word).withColumn("__id", F.coalesce(F.col("doc_id").cast("long"), F.lit(minhash.LAST))).withColumn("__key", F.xxhash64("text"))
    once = named.dropDuplicates(["__id", "__key"]).join(kept, ["__id", "__key"], "left_semi")
    return once.select(docs.columns).union(docs.filter(~has_word))


def passages_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that a document with a smaller id has; a document of which only white space is left goes.

    Bytes of a character that the cut went through go with it. ``n_chars`` follows.
    """
    named = {c: f"__{c}" for c in docs.columns}
    cut = passages.remove_repeats(docs.withColumnsRenamed(named), "__doc_id", "__text", tuple(named[c] for c in docs.columns if c not in ("doc_id", "text")))
    left = F.col("kept").cast("string")
    left = F.when(F.is_valid_utf8(left), left).otherwise(F.replace(F.make_valid_utf8(left), F.lit("\ufffd"), F.lit("")))
    cut = cut.withColumn("__text", left).filter((F.col("n_removed") == 0) | F.col("__text").rlike(r"\S"))
    out = cut.select(*[F.col(new).alias(c) for c, new in named.items()])
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Generalises personal data and removes what gives it away; ``n_chars`` follows."""
    return pii.sanitise(docs, **pii.WHOLE).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens."""
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [("language ID", language), ("MinHash", near_duplicates), ("suffix array", passages_once), ("PII", personal_data), ("packing", pack)]

#: The stages run models, hashes and tokenizers that SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
