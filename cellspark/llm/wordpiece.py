"""Token counts by a linear longest-match automaton.

The greedy word-piece split takes the longest piece of the vocabulary at each place. Done naively it
rescans; here a trie over the vocabulary has a failure link at each node, to the node where matching
goes on once the pieces that are now certain are taken off, and with it the number of those pieces.
One pass over a word's bytes then gives its number of pieces; no piece is ever built.

A word with a byte sequence that no piece covers counts as one unknown token. Null and empty texts
have no words.
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField

from cellspark.llm import bpe
from cellspark.llm.common import append_columns, texts, words

#: Words that a task remembers the counts of.
REMEMBERED = 1_000_000


class Automaton:
    """Trie with failure links; node 0 is a word's start, node 1 the start of a later piece."""

    def __init__(self, starts: set[bytes], rest: set[bytes]):
        self.step: dict[int, int] = {}
        self.fail: list[int] = [-1, -1]
        self.popped: list[int] = [0, 0]
        parent, byte, accepts = [-1, -1], [0, 0], [False, False]
        for root, pieces in ((0, starts), (1, rest)):
            for piece in pieces:
                node = root
                for b in piece:
                    nxt = self.step.get(node << 8 | b)
                    if nxt is None:
                        nxt = self.step[node << 8 | b] = len(parent)
                        parent.append(node)
                        byte.append(b)
                        accepts.append(False)
                    node = nxt
                accepts[node] = accepts[node] or node > 1
        n = len(parent)
        self.fail += [-1] * (n - 2)
        self.popped += [0] * (n - 2)
        depth = [0] * n
        for v in range(2, n):  # a parent is always made before its children
            depth[v] = depth[parent[v]] + 1
        for v in sorted(range(2, n), key=depth.__getitem__):
            if accepts[v]:
                self.fail[v], self.popped[v] = 1, 1
                continue
            z, pops = self.fail[parent[v]], self.popped[parent[v]]
            while z >= 0 and (z << 8 | byte[v]) not in self.step:
                pops += self.popped[z]
                z = self.fail[z]
            if z >= 0:
                self.fail[v], self.popped[v] = self.step[z << 8 | byte[v]], pops

    def count(self, word: bytes) -> int:
        """Pieces of a word, or -1 if it can't be split."""
        step, fail, popped = self.step, self.fail, self.popped
        node = taken = 0
        for b in word:
            while (nxt := step.get(node << 8 | b)) is None:
                taken += popped[node]
                node = fail[node]
                if node < 0:
                    return -1
            node = nxt
        while node > 1:
            taken += popped[node]
            node = fail[node]
        return taken if node == 1 or not word else -1

    @staticmethod
    @lru_cache(maxsize=2)
    def read(path: str) -> Automaton:
        """Pieces of a byte-level vocabulary: those with a leading blank start a word, others go on; single bytes do both."""
        pieces = bpe.Vocabulary.read(path).ids
        alone = {bytes([b]) for b in range(256)}
        starts = {p[1:] for p in pieces if p[:1] == b" " and len(p) > 1}
        return Automaton(starts | alone, {p for p in pieces if p[:1] != b" "} | alone)


def count_tokens(
    df: DataFrame, path: str, text: str = "text", n_words: str = "n_words", n_tokens: str = "n_tokens",
    n_unknown: str = "n_unknown",
) -> DataFrame:
    """Append the numbers of words, of word pieces (one for an unknown word) and of unknown words."""

    class Counts(dict):
        def __init__(self, automaton: Automaton):
            self.automaton = automaton

        def __missing__(self, word: str) -> int:
            n = self[word] = self.automaton.count(word.encode())
            return n

    def make():
        known = Counts(Automaton.read(path))

        def compute(column):
            out = []
            for t in texts(column):
                if len(known) > REMEMBERED:
                    known.clear()
                counts = [known[w] for w in words(t)]
                unknown = counts.count(-1)
                out.append((len(counts), sum(counts) + 2 * unknown, unknown))
            return [pa.array(c, pa.int64()) for c in zip(*out)] if out else [pa.array([], pa.int64())] * 3

        return compute

    return append_columns(df, [text], [StructField(c, LongType()) for c in (n_words, n_tokens, n_unknown)], make)
