"""Information-theoretic sanitisation of personal data.

Spans of four base kinds are found by pattern. Each is a mention of an entity (its normalised value).
The method adds terms that give an entity away: for a word of a text with a mention, the corpus tells
how many distinct texts hold the word at all, the entity, and both together. The share of the entity's
information that the word discloses is

    disclosure = pmi(word, entity) / ic(entity)
               = log(N * n_both / (n_word * n_entity)) / log(N / n_entity)

which is 1 if the word occurs with the entity only. A word at or over the threshold becomes a ``term``
span. ``sanitise`` generalises base spans to their kind and removes terms.

With ``WHOLE``, all counts are over whole texts, and a term is marked wherever it stands in a text that
mentions its entity. In place of a least number of texts, which no rare entity reaches, word and entity
must be together more often than chance explains: with m = n_word * n_entity / N texts expected, the
Chernoff bound exp(n_both - m) * (m / n_both) ** n_both on seeing n_both or more must be at most
``chance``. One text is enough from N = e / chance on. A word of a text that doesn't mention the entity
stays: nothing is left there or elsewhere that ties it to the entity. Without ``WHOLE``, only words
within ``reach`` characters of a mention count, with ``least_texts`` distinct texts at least.

Word counts cover the whole corpus, each distinct text once: each task counts the words of its texts where
they lie and sends one row per distinct word. What copies count too much is taken off again: only texts that may have
copies, by a bitmap of ``BITS`` bits of the repeated texts' hashes, are sent to be told apart. For ``WHOLE``, texts with a mention send their distinct words once; as
n_both <= n_entity, a word in over n_entity ** threshold * N ** (1 - threshold) texts can't reach the
threshold, so frequent words go before any pair is made. What is left are pairs of a text's entities with
its rare words. Null text counts as empty and has no spans; repeated rows give the same spans and count
once.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from cellspark.llm.common import SPAN, append_columns, give_back, replace_spans, texts, words
from cellspark.session import materialize

KINDS = ("email", "ip", "card", "phone")

#: Fixed values of the contract, written so that no text takes more than linear time.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile("[^0-9]")

#: Punctuation that isn't part of a term.
EDGES = ".,;:!?*#$%&|<>()[]{}\"'«»¿¡"
#: A term: letters, marks and digits of any script, with apostrophes and hyphens inside.
_TERM = regex.compile(r"[\p{L}\p{M}\p{N}]+(?:['\u2019\u2010\u2011-][\p{L}\p{M}\p{N}]+)*")
#: Size of the bitmap of repeated texts, 8 MB at most. Texts beyond what it tells apart are sent, which changes no count.
BITS = 1 << 26
BUCKET = 1 << 15  # bits of a row that Spark's bitmap functions make

#: Options of ``find`` and ``sanitise`` that take terms from whole texts and let rare entities have them.
WHOLE = {"reach": None, "least_texts": 1, "chance": 0.05}

PLACE = StructType([StructField("start", IntegerType()), StructField("end", IntegerType())])
TERM = StructType([StructField("term", LongType()), StructField("places", ArrayType(PLACE))])
CONTEXT = StructType([
    StructField("entity", LongType()), StructField("term", LongType()),
    StructField("start", IntegerType()), StructField("end", IntegerType())])


def digest(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each ``@`` with the longest free local part before it and a domain after it."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and _LOCAL.match(text[start - 1]):
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            last = m.end()
            yield start, last
        at = text.find("@", max(at + 1, last))


def base_spans(text: str) -> list[tuple[int, int, str, int]]:
    """(start, place of the kind, kind, end) of every base span, sorted."""
    out = [(a, 0, "email", b) for a, b in emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, "ip", m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(d := _NOT_DIGIT.sub("", m.group())) <= 19 and luhn(d):
            out.append((m.start(), 2, "card", m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                out.append((m.start(), 3, "phone", m.end()))
    return sorted(out)


def term_of(word: str) -> str:
    """The word as it is counted: case and punctuation at its ends don't matter. Empty: not a term."""
    plain = word.strip(EDGES).lower()
    return plain if plain.isalnum() or _TERM.fullmatch(plain) else ""


_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def entity_of(text: str, span: tuple) -> int:
    start, _, kind, end = span
    value = text[start:end].lower() if kind in ("email", "ip") else _NOT_DIGIT.sub("", text[start:end])
    return digest(f"{kind}:{value}")


def contexts(text: str, spans: list[tuple], reach: int) -> list[tuple[int, int, int, int]]:
    """(entity, term, start, end) of the terms within ``reach`` characters of each mention."""
    out = {}
    for span in spans:
        start, end, entity = span[0], span[3], entity_of(text, span)
        low, high = max(0, start - reach), min(len(text), end + reach)
        while 0 < low < start and not text[low - 1].isspace() and start - low < 2 * reach:
            low -= 1
        for m in _WORD.finditer(text, low, high):
            a, b = m.span()
            if any(a < s[3] and s[0] < b for s in spans):
                continue
            if (term := term_of(m.group())) and (b < high or high == len(text)):
                lead = a + len(m.group()) - len(m.group().lstrip(EDGES))
                out[entity, digest(term), lead, lead + len(term)] = None
    return list(out)


def whole_text(text: str, spans: list[tuple]) -> dict[int, list[tuple[int, int]]]:
    """Places of every distinct term of the text, but for words that overlap a base span."""
    out, ends, at = {}, 0, 0
    for m in _WORD.finditer(text):
        a, b = m.span()
        while at < len(spans) and spans[at][0] < b:
            ends = max(ends, spans[at][3])
            at += 1
        if ends <= a and (term := term_of(m.group())):
            lead = a + len(m.group()) - len(m.group().lstrip(EDGES))
            out.setdefault(term, []).append((lead, lead + len(term)))
    return {digest(term): places for term, places in out.items()}


def mentions(df: DataFrame, text: str = "text", reach: int | None = 80) -> DataFrame:
    """Append ``base`` spans, ``contexts`` or (no ``reach``) ``entities`` and ``terms``, and the text's hash ``text_key``."""
    kinds = [
        pa.list_(pa.struct([("start", pa.int32()), ("place", pa.int32()), ("kind", pa.string()), ("end", pa.int32())])),
        pa.list_(pa.struct([("entity", pa.int64()), ("term", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])),
        pa.list_(pa.int64()),
        pa.list_(pa.struct([("term", pa.int64()), ("places", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])),
        pa.int64()]

    def make():
        def compute(column):
            rows = []
            for t in texts(column):
                spans = base_spans(t)
                near = contexts(t, spans, reach) if spans and reach is not None else []
                held = whole_text(t, spans) if spans and reach is None else {}
                rows.append(([dict(zip(SPAN.fieldNames(), s)) for s in spans],
                             [dict(zip(CONTEXT.fieldNames(), c)) for c in near],
                             sorted({entity_of(t, s) for s in spans}),
                             [{"term": k, "places": [{"start": a, "end": b} for a, b in v]} for k, v in held.items()], digest(t)))
            return [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]

        return compute

    fields = [StructField("base", ArrayType(SPAN)), StructField("contexts", ArrayType(CONTEXT)), StructField("entities", ArrayType(LongType())),
              StructField("terms", ArrayType(TERM)), StructField("text_key", LongType())]
    return append_columns(df, [text], fields, make)


def term_counts(df: DataFrame, text: str = "text", weight: str | None = None, held: int = 200_000) -> DataFrame:
    """(term, n) over all rows, each with its ``weight`` or 1: a task counts in a table of ``held`` terms, then sends it on."""

    def run(batches):
        counts: Counter[str] = Counter()

        def flush():
            counts.pop("", None)
            out = pa.RecordBatch.from_arrays(
                [pa.array([*map(digest, counts)], pa.int64()), pa.array([*counts.values()], pa.int64())], names=["term", "n"])
            counts.clear()
            return out

        for batch in batches:
            weights = batch.column(1).to_pylist() if weight else [1] * batch.num_rows
            for t, w in zip(texts(batch.column(0)), weights):
                own = set(map(term_of, set(words(t))))
                if w == 1:
                    counts.update(own)
                else:
                    for term in own:
                        counts[term] += w
                if len(counts) > held:
                    yield flush()
        yield flush()
        give_back()

    return df.select(text, *([weight] if weight else [])).mapInArrow(run, "term long, n long")


def repeated(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """(text, n) of the texts of more than one row. ``keys`` are the hashes of those texts."""
    place = F.pmod(F.col("text_key"), F.lit(BITS)) + 1  # the bitmap functions count from 1
    rows = keys.select(place.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")).collect()
    if not rows:
        return docs.select("text").limit(0).groupBy("text").agg(F.count("*").alias("n"))
    packed = {r.bucket - 1: bytes(r.bits) for r in rows}

    def run(batches):
        for batch in batches:
            keep = []
            for t in texts(batch.column(0)):
                bucket, bit = divmod(digest(t) % BITS, BUCKET)
                own = packed.get(bucket)
                keep.append(own is not None and bool(own[bit >> 3] >> (bit & 7) & 1))
            yield batch.filter(pa.array(keep, pa.bool_()))

    some = docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, "text string")
    return some.groupBy("text").agg(F.count("*").alias("n")).filter("n > 1")


def distinct_counts(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """(term, n_term) over the distinct texts."""
    surplus = repeated(docs, keys).select("text", (1 - F.col("n")).alias("surplus"))
    every = term_counts(docs).union(term_counts(surplus, weight="surplus"))
    return every.groupBy("term").agg(F.sum("n").alias("n_term"))


def find(
    df: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.8, least_texts: int = 3, reach: int | None = 80,
    chance: float = 1.0,
) -> DataFrame:
    """One row per row of ``df``: doc_id, ``base`` spans, all ``spans``, and ``text_key``.

    A term needs a disclosure of ``threshold``, ``least_texts`` distinct texts with the entity, and a
    bound of ``chance`` on being so often with it by accident. Without ``reach``, whole texts count.
    """
    docs = df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = materialize(mentions(docs, reach=reach).drop("text"), "mentions")
    copies = materialize(rows.groupBy("text_key").agg(F.count("*").alias("copies")), "copies")
    n, log = F.lit(float(copies.count())), F.log
    counts = distinct_counts(docs, copies.filter("copies > 1"))
    span = F.struct(F.col("start"), F.lit(len(KINDS)).alias("place"), F.lit("term").alias("kind"), F.col("end"))
    if reach is None:
        owners = rows.select("text_key", F.explode("entities").alias("entity")).distinct()
        entities = materialize(owners.groupBy("entity").agg(F.count("*").alias("n_entity")), "entities")
        most = F.lit(entities.agg(F.max("n_entity")).first()[0])
        fits = lambda c: F.col("n_term") <= F.pow(c, F.lit(threshold)) * F.pow(n, F.lit(1 - threshold)) * (1 + 1e-9)
        held = rows.select("text_key", F.explode("terms").alias("t")).select("text_key", "t.*")
        held = materialize(held.join(counts.filter(fits(most)), "term").dropDuplicates(["text_key", "term"]), "terms")
        near = held.select("text_key", "term", "n_term").join(owners.join(entities, "entity"), "text_key").filter(fits(F.col("n_entity")))
        both = near.groupBy("entity", "term", "n_entity", "n_term").agg(F.count("*").alias("n_both"))
    else:
        near = rows.select("text_key", F.explode("contexts").alias("c")).select("text_key", "c.*").distinct()
        entities = near.select("entity", "text_key").distinct().groupBy("entity").agg(F.count("*").alias("n_entity"))
        both = near.select("entity", "term", "text_key").distinct().groupBy("entity", "term").agg(F.count("*").alias("n_both"))
        both = both.filter(F.col("n_both") >= least_texts).join(entities, "entity").join(counts, "term")
    expected = F.col("n_term") * F.col("n_entity") / n
    excess = F.col("n_both") * log(F.col("n_both") / expected) - F.col("n_both") + expected
    disclosed = (
        both.withColumn("disclosure", (log(n) + log("n_both") - log("n_term") - log("n_entity")) / (log(n) - log("n_entity")))
        .filter((F.col("disclosure") >= threshold) & (n > F.col("n_entity")) & (F.col("n_both") >= least_texts))
        .filter(F.lit(chance >= 1) | ((F.col("n_both") > expected) & (excess >= -math.log(chance))))
        .select("entity", "term")
    )
    marked = near.join(disclosed, ["entity", "term"])
    if reach is None:
        marked = marked.select("text_key", "term").distinct().join(held, ["text_key", "term"]).select("text_key", F.explode("places").alias("p"))
        marked = marked.select("text_key", "p.*")
    added = marked.groupBy("text_key").agg(F.collect_set(span).alias("terms"))
    none = F.array().cast(ArrayType(SPAN))
    return rows.drop("terms").join(added, "text_key", "left").select(
        "doc_id", "text_key", "base", F.array_sort(F.concat("base", F.coalesce("terms", none))).alias("spans"))


def sanitise(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``df`` with base spans of the text replaced by their kind in angle brackets, and terms removed."""
    keyed = df.withColumn("__key", F.xxhash64(F.col(key).cast("long"), F.coalesce(F.col(text), F.lit(""))))
    found = find(keyed.select(F.col("__key").alias("doc_id"), F.col(text).alias("text")), **options)
    marked = found.filter(F.size("spans") > 0).groupBy(F.col("doc_id").alias("__key")).agg(F.first("spans").alias("__spans"))
    mask = lambda s: F.when(s["kind"] == "term", F.lit("")).otherwise(F.concat(F.lit("<"), s["kind"], F.lit(">")))
    clean = F.when(F.col("__spans").isNull(), F.col(text)).otherwise(replace_spans(F.col(text), F.col("__spans"), mask))
    return keyed.join(marked, "__key", "left").withColumn(text, clean).drop("__key", "__spans")
