"""Text analysis and term search."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellspark.functions import snowball
from cellspark.functions.stemming import stem_english
from cellspark.operators.predicates import like_kind

# Fixed value: a word is a run of letters, marks, digits and underscores, which a single
# inner apostrophe, full stop, colon or middle dot does not end; a Han or kana character
# is a word of its own.
WORD = (
    r"[\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}\x{3040}-\x{30FF}]"
    r"|[\p{L}\p{N}\p{M}_]+(?:['’.:·][\p{L}\p{N}\p{M}_]+)*"
)
MAX_TOKEN = 255

# Short stop-word lists, one per language. The English one is the common public list
# of 33 words; the others are the most frequent function words.
STOP_WORDS = {
    "ar": "من في على أن إلى هذا هذه التي الذي و لا ما",
    "bg": "и в на с за не се да от по е",
    "cs": "a i v na s z se je že to do",
    "de": "der die das und in zu den von mit ist des im für auf nicht ein eine",
    "en": "a an and are as at be but by for if in into is it no not of on or such that the their then there these they this to was will with",
    "es": "el la los las de y en que a un una por con para es no se",
    "fi": "ja on ei se että oli hän mutta ovat",
    "fr": "le la les de des du et un une en que qui est dans pour par au aux ce ne pas",
    "hi": "और के का में है की से को पर यह",
    "hu": "a az és hogy nem is egy van ez meg",
    "it": "il lo la i gli le di e in che un una per con non è",
    "pl": "i w na z że do nie się to jest",
    "pt": "o a os as de e em que um uma para com não do da",
    "ro": "și în la de cu pe nu un o că este",
    "ru": "и в не на что с он как это по но из",
    "sv": "och i att det som en på är av för inte den",
}


@dataclass(frozen=True)
class Analyzer:
    """How a text column becomes terms. Filters run in the order case, stop words, stemming."""

    kind: str = "standard"  # standard | whole | delimiter | none
    case: str | None = None  # lower | upper
    stop_words: str | None = None  # language
    delimiter: str = ","
    min_length: int = 0
    max_length: int = MAX_TOKEN
    stem: str | None = None  # language: en | de | es | fr

    def fold(self, x: Column) -> Column:
        return {"lower": F.lower, "upper": F.upper, None: lambda v: v}[self.case](x)

    def terms(self, text: Column) -> Column:
        """All terms of a text in order, duplicates kept."""
        found = self.unstemmed(text)
        return stems_in(self.stem)(found) if self.stem else found

    def unstemmed(self, text: Column) -> Column:
        if self.kind == "none":
            return F.array(text)
        if self.kind == "whole":
            return F.array(self.fold(text))
        if self.kind == "delimiter":
            parts = F.split(text, re.escape(self.delimiter))
            return F.transform(F.filter(parts, lambda x: x != ""), self.fold)
        if self.kind != "standard":
            raise ValueError(f"unknown analyzer {self.kind}")
        found = lambda x: F.filter(tokens(x), self.fits)
        if self.case == "lower":
            # Lower-casing the text first is one fast pass. It equals lower-casing each token except
            # for two letters: the capital sigma, whose lower form depends on what follows, and the
            # dotted capital I, which becomes two characters. Texts with one of them take the slow way.
            special = text.contains("Σ") | text.contains("İ")
            folded = F.when(special, F.transform(found(text), F.lower)).otherwise(found(F.lower(text)))
        else:
            folded = F.transform(found(text), self.fold) if self.case else found(text)
        return F.filter(folded, self.no_stop_word) if self.stop_words else folded

    def fits(self, token: Column) -> Column:
        """The length rule of the standard analyzer, for a token as it stands in the text."""
        return F.length(token).between(max(self.min_length, 1), self.max_length)

    def no_stop_word(self, term: Column) -> Column:
        return ~term.isin(STOP_WORDS[self.stop_words].split())


def tokens(text: Column) -> Column:
    """The words of a text as they stand there."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def term_rows(df: DataFrame, column: str, analyzer: Analyzer, key: list[str], distinct: bool = False) -> DataFrame:
    """One row per key and term occurrence (or per distinct term).

    Tokens are exploded first, so that length, case and stop words are tests on plain rows
    in generated code instead of functions over arrays.
    """
    if distinct or analyzer.kind != "standard":
        terms = analyzer.terms(F.col(column))
        return df.select(*key, F.explode(F.array_distinct(terms) if distinct else terms).alias("term"))
    rows = df.select(*key, F.explode(tokens(F.col(column))).alias("term")).filter(analyzer.fits(F.col("term")))
    rows = rows.withColumn("term", analyzer.fold(F.col("term")))
    rows = rows.filter(analyzer.no_stop_word(F.col("term"))) if analyzer.stop_words else rows
    return with_stems(rows, language=analyzer.stem) if analyzer.stem else rows


def terms_table(df: DataFrame, column: str, analyzer: Analyzer, key: list[str]) -> DataFrame:
    """One row per key and distinct term."""
    return term_rows(df, column, analyzer, key, distinct=True)


def stems_in(language: str):
    """A function of arrays of terms that gives arrays of their stems."""
    if language not in snowball.STEMMERS:
        raise ValueError(f"no stems for {language}: {sorted(snowball.STEMMERS)}")

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def stems(arrays: pd.Series) -> pd.Series:
        return arrays.map(lambda terms: None if terms is None else [snowball.stem(x, language) if x is not None else None for x in terms])

    return stems


def _stem_rows(make):
    @F.pandas_udf(T.StringType())
    def stems(terms: pd.Series) -> pd.Series:
        # each distinct term of a batch is worked out once
        codes, distinct = pd.factorize(terms)
        stemmed = pd.Series([make(x) for x in distinct] + [None], dtype=object)
        return stemmed.take(codes).reset_index(drop=True)

    return stems


def with_stems(terms: DataFrame, term: str = "term", language: str | None = None) -> DataFrame:
    """Replace terms by their stems, batch by batch and without a shuffle; without a language by the older English rules."""
    make = stem_english if language is None else snowball.STEMMERS[language]
    return terms.withColumn(term, _stem_rows(make)(F.col(term)))


def term_matches(kind: str, text: str):
    return {"prefix": lambda t: t.startswith(text), "suffix": lambda t: t.endswith(text),
            "contains": lambda t: t.contains(text), "equals": lambda t: t == text}[kind]


def search(df: DataFrame, column: str, pattern: str, analyzer: Analyzer, negate: bool = False) -> DataFrame:
    """Rows whose terms match a LIKE pattern.

    The pattern's text goes through the same analyzer; several resulting terms are OR-ed.
    """
    return df.filter(matches(column, pattern, analyzer, negate))


def matches(column: str, pattern: str, analyzer: Analyzer, negate: bool = False) -> Column:
    return matches_all(column, [(pattern, negate)], analyzer)


def matches_all(column: str, patterns: list[tuple[str, bool]], analyzer: Analyzer) -> Column:
    """AND of several LIKE predicates (pattern, negated) over one analysis of the text."""
    value = F.col(column)
    tests, hints = [], []
    for pattern, negate in patterns:
        kind, text = like_kind(pattern)
        wanted = _query_terms(text, analyzer)

        def test(terms: Column, kind=kind, wanted=wanted, negate=negate) -> Column:
            hits = [F.exists(terms, term_matches(kind, w)) for w in wanted]
            found = reduce(lambda a, b: a | b, hits) if hits else F.lit(False)
            return ~found if negate else found

        tests.append(test)
        if not negate and wanted and not analyzer.stem and analyzer.case != "upper" and all(w.isascii() for w in wanted):
            # a matching term lies inside the (folded) text: a cheap test before the analysis
            folded = analyzer.fold(value)
            hints.append(reduce(lambda a, b: a | b, [folded.contains(w) for w in wanted]))
    # the one-element array binds the terms, so that the text is analysed once
    bound = F.transform(F.array(analyzer.terms(value)), lambda terms: reduce(
        lambda a, b: a & b, [t(terms) for t in tests]))
    decided = F.element_at(bound, 1)
    negative = reduce(lambda a, b: a & b, [F.lit(negate) for _, negate in patterns])
    decided = F.when(value.isNull(), negative).otherwise(decided)
    return reduce(lambda a, b: a & b, [F.coalesce(h, F.lit(False)) for h in hints] + [decided])


def _query_terms(text: str, analyzer: Analyzer) -> list[str]:
    """Terms of the (short) query text, by the expression that the documents go through."""
    return SparkSession.active().range(1).select(analyzer.terms(F.lit(text)).alias("terms")).first()["terms"]


def word_count(df: DataFrame, column: str, separator: str = r"\s+") -> DataFrame:
    """Occurrences of each word of a text column."""
    words = df.select(F.explode(F.split(column, separator)).alias("word")).filter("word <> ''")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def total_count(counts: DataFrame) -> DataFrame:
    return counts.agg(F.sum("n").alias("total"))
