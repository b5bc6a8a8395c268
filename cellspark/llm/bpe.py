"""Byte-level BPE as a streaming transducer with bounded lookahead, and its inverse.

**Encoding.** A difference between two texts that share a prefix can move left through the merges
only by a chain of overlapping merges of rising rank: a merge of ``(a, b)`` is decided otherwise
only if ``b`` ends at, or spans, a boundary that an earlier merge decided otherwise. The longest
such chain, in bytes, is a property of the merge list (``sufficient_lookahead``): a token that ends
so many bytes before the end of what was read is final. The encoder therefore holds one window,
emits the stable tokens of it and goes on, in memory that doesn't depend on the text.

**Decoding.** Bytes of the ids go through an incremental UTF-8 state machine, whose state is the at
most three bytes of an unfinished character.

Null texts encode as empty ones. Ids outside the vocabulary decode to nothing.
"""

from __future__ import annotations

import codecs
import heapq
import json
import re
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StringType, StructField

from cellspark.llm.common import append_columns, texts

#: Fixed value: how the vocabulary's public format splits text before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Units kept by a task for words that come again.
REMEMBERED = 1_000_000


def _byte_alphabet() -> dict[str, int]:
    """The format writes each byte as one printable character: itself, or the next free one above 255."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    signs = {chr(b): b for b in plain}
    for shift, b in enumerate(b for b in range(256) if b not in set(plain)):
        signs[chr(256 + shift)] = b
    return signs


class Vocabulary:
    """Merges by pair of ids, bytes by id, and the strings that are ids of their own."""

    def __init__(self, merges: list[tuple[bytes, bytes]], ids: dict[bytes, int], special: dict[str, int]):
        self.ids, self.special = ids, special
        self.rank_of, self.merged = {}, []
        for rank, (a, b) in enumerate(merges):
            self.rank_of.setdefault(ids[a] << 20 | ids[b], rank)
            self.merged.append(ids[a + b])
        self.single = [ids.get(bytes([b])) for b in range(256)]
        self.spelled = {i: t for t, i in ids.items()} | {i: s.encode() for s, i in special.items()}
        self.lookahead = sufficient_lookahead(merges)
        self.longest = max(map(len, ids), default=1)

    @staticmethod
    @lru_cache(maxsize=4)
    def read(path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        sign = _byte_alphabet()
        raw = lambda s: bytes(sign[c] for c in s)
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ids = {raw(t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        return Vocabulary([(raw(a), raw(b)) for a, b in pairs], ids, special)

    def merge(self, window: bytes) -> list[int]:
        """The merge list applied to one window: lowest rank first, leftmost first."""
        parts = [self.single[b] for b in window]
        if len(parts) > 64:
            return self._merge_long(parts)
        rank_of, none = self.rank_of.get, len(self.merged)
        ranks = [rank_of(a << 20 | b, none) for a, b in zip(parts, parts[1:])]
        while ranks and (best := min(ranks)) < none:
            i = ranks.index(best)
            parts[i] = self.merged[best]
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank_of(parts[i] << 20 | parts[i + 1], none)
            if i:
                ranks[i - 1] = rank_of(parts[i - 1] << 20 | parts[i], none)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        """The same over a linked list with a heap of candidate merges."""
        n, rank_of = len(parts), self.rank_of.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if (r := rank_of(a << 20 | b)) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i] if parts[i] is not None else n
            if j >= n or rank_of(parts[i] << 20 | parts[j]) != rank:
                continue
            parts[i], parts[j] = self.merged[rank], None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n and (r := rank_of(parts[k] << 20 | parts[after[k]])) is not None:
                    heapq.heappush(heap, (r, k))
        return [p for p in parts if p is not None]


def sufficient_lookahead(merges: list[tuple[bytes, bytes]]) -> int:
    """Bytes after a token's end that decide whether it is final, from the merge list alone.

    ``reach`` of a merge is how far left of the first unread byte its decision can lie. A merge
    ``(a, b)`` can be decided otherwise if a boundary at the end of ``b`` or inside it was: that
    boundary belongs to an earlier merge whose left part is on the right spine of what ``b`` has
    to the left of it. The merges come by rank, so one pass with three running values for each
    token is enough:
    ``left``: furthest reach so far of merges with this token on the left;
    ``spine``: the same over the tokens on its right spine, as they stood when each was merged away;
    ``inner``: furthest reach through a boundary inside it, counted from its start.
    """
    left: dict[bytes, int] = {}
    spine: dict[bytes, int] = {}
    inner: dict[bytes, int] = {}
    most = max((len(b) for _, b in merges), default=1)
    furthest = most
    for a, b in merges:
        own = max(spine.get(b, 0), left.get(b, 0))
        reach = max(len(b), inner.get(b, 0), len(b) + own)
        left[a] = max(left.get(a, 0), reach)
        token = a + b
        if token not in spine:
            inner[token] = max(
                inner.get(a, 0), len(a) + max(spine.get(a, 0), left[a]), len(a) + inner.get(b, 0))
            spine[token] = own
        furthest = max(furthest, reach)
    return furthest


class Encoder:
    """Ids of one piece of text that arrives in parts; holds at most two windows of bytes."""

    def __init__(self, vocabulary: Vocabulary, block: int = 1024):
        self.vocabulary, self.buffer = vocabulary, bytearray()
        self.window = vocabulary.lookahead + vocabulary.longest + block

    def feed(self, data: bytes) -> Iterator[int]:
        for start in range(0, len(data), self.window):
            self.buffer += data[start : start + self.window]
            while len(self.buffer) >= self.window:
                held, end = bytes(self.buffer[: self.window]), 0
                for token in self.vocabulary.merge(held):
                    size = len(self.vocabulary.spelled[token])
                    if end + size > len(held) - self.vocabulary.lookahead:
                        break
                    end += size
                    yield token
                del self.buffer[:end]

    def finish(self) -> Iterator[int]:
        yield from self.vocabulary.merge(bytes(self.buffer))
        self.buffer.clear()


class Decoder:
    """Text of ids that arrive in parts; the state is an unfinished character."""

    def __init__(self, vocabulary: Vocabulary):
        self.spelled = vocabulary.spelled
        self.pending = b""

    def feed(self, ids: Iterable[int], last: bool = False) -> str:
        data = self.pending + b"".join([self.spelled.get(i, b"") for i in ids])
        text, used = codecs.utf_8_decode(data, "replace", last)
        self.pending = data[used:]
        return text


class Transducer:
    """Encodes texts: splits off special strings, cuts units at single blanks, remembers the units' ids."""

    #: White space other than one blank between two words, where a cut could change the split.
    UNEVEN = re.compile(r"\s\s|^\s|\s$|[\x1c-\x1f]")

    def __init__(self, path: str):
        self.vocabulary = Vocabulary.read(path)
        self.split = regex.compile(SPLIT)
        self.special = re.compile("(" + "|".join(map(re.escape, self.vocabulary.special)) + ")") if self.vocabulary.special else None
        self.known: dict[str, bytes] = {}

    def piece(self, text: str) -> bytes:
        """Ids, as little-endian 32-bit integers, of one piece of the split."""
        found = self.known.get(text)
        if found is None:
            data = text.encode()
            if len(data) <= self.vocabulary.lookahead:
                out = self.vocabulary.merge(data)
            else:
                encoder = Encoder(self.vocabulary)
                out = [*encoder.feed(data), *encoder.finish()]
            found = struct.pack(f"<{len(out)}I", *out)
            if len(data) < 64:
                self.known[text] = found
        return found

    def unit(self, text: str) -> bytes:
        """The same of a text that no neighbour can change: one word, or what uneven white space ties together."""
        if text.isalpha() or text[:1] == " " and text[1:].isalpha():
            return self.piece(text)
        return b"".join(map(self.piece, self.split.findall(text)))

    def plain(self, text: str) -> bytes:
        if not text:
            return b""
        if self.UNEVEN.search(text):
            return self.unit(text)
        first, *rest = text.split(" ")
        units = [first, *[" " + w for w in rest]]
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for u in units:
            if u not in known:
                known[u] = self.unit(u)
        return b"".join(map(known.__getitem__, units))

    def encode(self, text: str) -> bytes:
        if self.special is None or not any(s in text for s in self.vocabulary.special):
            return self.plain(text)
        marks = self.vocabulary.special
        return b"".join(
            marks[part].to_bytes(4, "little") if part in marks else self.plain(part) for part in self.special.split(text))

    def decode(self, ids: bytes) -> str:
        decoder, codes = Decoder(self.vocabulary), np.frombuffer(ids, "<u4")
        parts = [decoder.feed(codes[s : s + 65536].tolist()) for s in range(0, len(codes), 65536)]
        return "".join([*parts, decoder.feed((), last=True)])


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """Append ``ids`` (binary, little-endian unsigned 32-bit); with ``decoded``, their text as well."""
    fields = [StructField(ids, BinaryType())] + ([StructField(decoded, StringType())] if decoded else [])

    def make():
        transducer = Transducer(path)

        def compute(column):
            out = [transducer.encode(t) for t in texts(column)]
            back = [pa.array([transducer.decode(x) for x in out], pa.string())] if decoded else []
            return [pa.array(out, pa.binary()), *back]

        return compute

    return append_columns(df, [text], fields, make)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Append the text of ``ids`` as ``encode`` writes them; null ids give an empty text."""

    def make():
        transducer = Transducer(path)
        return lambda column: [pa.array([transducer.decode(x or b"") for x in column.to_pylist()], pa.string())]

    return append_columns(df, [ids], [StructField(text, StringType())], make)
