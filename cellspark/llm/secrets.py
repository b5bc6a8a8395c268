"""Secret scan over a trigram inverted index.

Each rule's regular expression is turned into a Boolean query over trigrams that every match must
contain. Documents are indexed in blocks: for every trigram that some rule asks for, the sorted list
of the block's documents that hold it. A rule's query is evaluated by intersecting and uniting these
postings, and its expression runs over the remaining candidates only. A rule without a mandatory
trigram, such as a long run of hexadecimal digits, runs over every document. The index is over
UTF-8 bytes with A-Z lowered, so it serves rules in either case.

A block is a few hundred rows of one partition: no shuffle, and work in proportion to the text.
Null and empty texts have no spans. Repeated rows give the same spans each.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product
from re import _constants as ops
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField

from cellspark.llm.common import SPAN, append_columns, replace_spans, texts


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has ``least`` characters at least."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    either_case: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.either_case else 0))


#: The three rules of the contract.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2, True),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: Rules of our own: well-known shapes of issued keys.
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("pay", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url", r"[a-z][a-z0-9+.-]{1,15}://[^\s:/@]{1,64}:[^\s:/@]{6,64}@"),
)

#: Strings of one part of an expression are joined with the next part's up to so many.
EXACT = 64

Query = bool | int | tuple  # True: any document; a trigram's code; ("and" | "or", parts)


def join(kind: str, parts: list[Query]) -> Query:
    """``and`` or ``or`` of queries, without what says nothing."""
    if kind == "or" and any(p is True for p in parts):
        return True
    parts = list(dict.fromkeys(p for p in parts if p is not True))
    return True if not parts else parts[0] if len(parts) == 1 else (kind, tuple(parts))


def of_strings(strings: set[bytes]) -> Query:
    """Documents that hold one of the strings, as far as trigrams can tell."""
    return join("or", [
        join("and", [int.from_bytes(s[i : i + 3], "big") for i in range(len(s) - 2)]) for s in sorted(strings)])


def characters(items: list) -> set[bytes] | None:
    """The lowered characters of a set, if it is small."""
    out: set[bytes] = set()
    for op, arg in items:
        if op is ops.LITERAL:
            out.add(chr(arg).encode().lower())
        elif op is ops.RANGE and arg[1] - arg[0] < 8:
            out |= {chr(c).encode().lower() for c in range(arg[0], arg[1] + 1)}
        else:
            return None
    return out if len(out) <= 8 else None


def part(node) -> tuple[set[bytes] | None, Query]:
    """(all its strings, or None if they are many; what every match must contain)."""
    op, arg = node
    if op is ops.LITERAL:
        return {chr(arg).encode().lower()}, True
    if op is ops.IN:
        return characters(arg), True
    if op is ops.SUBPATTERN:
        return sequence(arg[3])
    if op is ops.ATOMIC_GROUP:
        return sequence(arg)
    if op is ops.BRANCH:
        exact, queries = set(), []
        for branch in arg[1]:
            strings, query = sequence(branch)
            exact = None if exact is None or strings is None else exact | strings
            queries.append(query if strings is None else of_strings(strings))
        return (exact if exact is not None and len(exact) <= EXACT else None), join("or", queries)
    if op in (ops.MAX_REPEAT, ops.MIN_REPEAT, ops.POSSESSIVE_REPEAT):
        least, most, inner = arg
        strings, query = sequence(inner)
        if strings is not None and most == 1:
            return strings | ({b""} if least == 0 else set()), True
        if least == 0:
            return None, True
        return None, query if strings is None else of_strings(strings)
    if op is ops.AT:
        return {b""}, True
    return None, True


def sequence(nodes) -> tuple[set[bytes] | None, Query]:
    held, queries, exact = {b""}, [], True
    for node in nodes:
        strings, query = part(node)
        if strings is not None and len(held) * len(strings) <= EXACT:
            held = {a + b for a, b in product(held, strings)}
            continue
        queries.append(of_strings(held))
        exact, held = False, {b""} if strings is None else strings
        queries.append(query)
    if exact:
        return held, True
    return None, join("and", [*queries, of_strings(held)])


def query_of(rule: Rule) -> Query:
    """The trigram query of a rule; True if it has no mandatory trigram."""
    strings, query = sequence(_parser.parse(rule.pattern))
    return query if strings is None else of_strings(strings)


def trigrams(query: Query) -> set[int]:
    if isinstance(query, tuple):
        return set().union(*map(trigrams, query[1]))
    return set() if query is True else {query}


class Index:
    """Postings of the asked-for trigrams over blocks of documents."""

    def __init__(self, asked: set[int]):
        self.codes = np.array(sorted(asked), np.int64)
        self.wanted = np.zeros(1 << 24, np.bool_)
        self.wanted[self.codes] = True

    def postings(self, block: list[bytes]) -> dict[int, np.ndarray]:
        ends = np.cumsum([len(t) + 2 for t in block])
        data = np.frombuffer(b"\0\0".join(block) + b"\0\0", np.uint8).astype(np.int32)
        codes = data[:-2] << 16 | data[1:-1] << 8 | data[2:]
        at = np.flatnonzero(self.wanted[codes])
        found, owner = codes[at], np.searchsorted(ends, at, side="right")
        order = np.argsort(found, kind="stable")
        found, owner = found[order], owner[order]
        first = np.searchsorted(found, self.codes, side="left")
        last = np.searchsorted(found, self.codes, side="right")
        return {int(c): np.unique(owner[a:b]) for c, a, b in zip(self.codes, first, last)}


def candidates(query: Query, postings: dict[int, np.ndarray], n: int) -> np.ndarray:
    """The block's documents that can hold a match."""
    if query is True:
        return np.arange(n)
    if not isinstance(query, tuple):
        return postings[query]
    lists = [candidates(q, postings, n) for q in query[1]]
    if query[0] == "or":
        return np.unique(np.concatenate(lists))
    lists.sort(key=len)
    out = lists[0]
    for other in lists[1:]:
        out = np.intersect1d(out, other, assume_unique=True)
    return out


def scan(df: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, text: str = "text", spans: str = "secrets") -> DataFrame:
    """Append ``spans``: every rule's leftmost non-overlapping matches, by start, then in the rules' order."""

    def make():
        queries = [query_of(r) for r in rules]
        patterns = [r.compiled() for r in rules]
        index = Index(set().union(*map(trigrams, queries)))

        def compute(column):
            block = texts(column)
            found: list[list[tuple]] = [[] for _ in block]
            postings = index.postings([t.encode().lower() for t in block]) if block else {}
            for place, (rule, query, pattern) in enumerate(zip(rules, queries, patterns)):
                for i in candidates(query, postings, len(block)):
                    for m in pattern.finditer(block[i]):
                        if m.end(rule.group) - m.start(rule.group) >= rule.least:
                            found[i].append((m.start(), place, rule.kind, m.end()))
            names = SPAN.fieldNames()
            kind = pa.list_(pa.struct([("start", pa.int32()), ("place", pa.int32()), ("kind", pa.string()), ("end", pa.int32())]))
            return [pa.array([[dict(zip(names, s)) for s in sorted(f)] for f in found], kind)]

        return compute

    return append_columns(df, [text], [StructField(spans, ArrayType(SPAN))], make)


def redact(text: Column, spans: Column) -> Column:
    """The text with every secret replaced by its kind in angle brackets."""
    return replace_spans(F.coalesce(text, F.lit("")), spans, lambda s: F.concat(F.lit("<"), s["kind"], F.lit(">")))
