"""Packing of documents into sequences, as a cutting-stock problem solved by column generation.

A document of at least a whole sequence is cut into whole sequences and one rest; shorter documents
are not cut. The rests make a histogram over length classes of ``grain`` tokens, at most
``size / grain`` numbers whatever the corpus. On it a linear program over patterns (how many rests of
each class fill one sequence) is solved: a knapsack dynamic program prices new patterns against the
dual values until none helps, the solution is rounded down, and what is left over is packed by
largest-first filling. Each pattern then claims a range of ranks of each class, and documents, ranked
within their class, find their sequence by their rank.

Only the histogram and the patterns pass through the driver. Ranks come from salted counts: a class
that holds a third of all documents is ranked in ``SALTS`` tasks. Padding is at most ``grain - 1``
tokens a piece besides what the patterns leave open.

A sequence whose content is a power of two needs no padding, so short leftovers lose nothing by being
alone when they are one. Null text counts as empty: a document of its end token only.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField

from cellspark.llm.common import append_columns, keep, texts, whole
from cellspark.session import materialize

SALTS = 256
REMEMBERED = 1_000_000


class Words:
    """Ids of a text word by word: white space always parts tokens, so a word's ids are remembered.

    New words of a batch go through the library together, parted by a special token of its own.
    """

    #: What str.split parts and the tokenizer doesn't.
    ODD = "\x1c\x1d\x1e\x1f"
    #: Texts of other characters than these, or with what may be a special token, are not lowered here.
    OTHER = re.compile("[^\x00-\u012f\u0131-\u024f]")
    #: Marks that the tokenizer always parts from a run of letters before them.
    TAIL = ".,;:!?|#*$%&<>"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.mark, self.mark_id = next(iter(special.items()))
        self.special = list(special)
        self.known: dict[str, bytes] = {}

    @staticmethod
    @lru_cache(maxsize=2)
    def read(path: str) -> Words:
        return Words(path)

    def plain(self, text: str) -> bool:
        return "<|" not in text and (text.isascii() or not self.OTHER.search(text))

    def direct(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def learn(self, new: list[str]) -> None:
        plain = [w for w in new if not any(s in w for s in self.special)]
        self.known.update((w, self.direct(w)) for w in set(new) - set(plain))
        for start in range(0, len(plain), 4096):
            part = plain[start : start + 4096]
            # without the offsets of tokens, which take a third of the time
            joined = self.tokenizer.encode_batch_fast([self.mark.join(part)], add_special_tokens=False)[0]
            ids = np.array(joined.ids, "<u4")
            ends = np.append(np.flatnonzero(ids == self.mark_id), len(ids))
            begin = 0
            for w, end in zip(part, ends, strict=True):
                self.known[w] = ids[begin:end].tobytes()
                begin = end + 1

    def encode(self, block: list[str]) -> list[bytes]:
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        parts = [
            None if any(c in t for c in self.ODD) else (t.lower() if self.plain(t) else t).split() for t in block]
        need, made = set(), []
        for w in set().union(*filter(None, parts)).difference(known):
            core = w.rstrip(self.TAIL)
            if len(core) < len(w) and core.isalpha():
                made.append((w, core, w[len(core) :]))
                need |= {x for x in made[-1][1:] if x not in known}
            else:
                need.add(w)
        self.learn(list(need))
        known.update((w, known[core] + known[tail]) for w, core, tail in made)
        return [self.direct(t) if p is None else b"".join(map(known.__getitem__, p)) for t, p in zip(block, parts)]


def tokenise(df: DataFrame, path: str, size: int, end: int, text: str = "text") -> DataFrame:
    """Append ``n_tokens`` with the end token, and ``sums``: the CRC-32 of each piece of ``size`` ids and the rest."""

    def make():
        encoder, last = Words.read(path), struct.pack("<I", end)
        keep(__name__, encoder.known.clear)

        def compute(column):
            ids = [x + last for x in encoder.encode(texts(column))]
            sums = [[zlib.crc32(x[s : s + 4 * size]) for s in range(0, len(x), 4 * size)] for x in ids]
            return [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(sums, pa.list_(pa.int64()))]

        return compute

    return append_columns(df, [text], [StructField("n_tokens", LongType()), StructField("sums", ArrayType(LongType()))], make)


def best_pattern(values: np.ndarray, lengths: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the most valuable pattern that fits, and its value."""
    best, pick = np.zeros(room + 1), np.full(room + 1, -1)
    for c in range(1, room + 1):
        k = int(np.searchsorted(lengths, c, side="right"))
        best[c] = best[c - 1]
        if k:
            tried = best[c - lengths[:k]] + values[:k]
            j = int(tried.argmax())
            if tried[j] > best[c]:
                best[c], pick[c] = tried[j], j
    pattern, c = np.zeros(len(lengths)), room
    while c > 0:
        if pick[c] >= 0:
            pattern[pick[c]] += 1
            c -= int(lengths[pick[c]])
        else:
            c -= 1
    return float(best[room]), pattern


def fill(rest: np.ndarray, lengths: np.ndarray, room: int) -> np.ndarray:
    """One pattern, largest class first, as many of each as are left and fit."""
    pattern = np.zeros(len(lengths))
    for i in np.flatnonzero(rest)[::-1]:
        if n := min(int(np.ceil(rest[i])), room // int(lengths[i])):
            pattern[i] = n
            room -= n * int(lengths[i])
    return pattern


def first_basis(wanted: np.ndarray, lengths: np.ndarray, room: int) -> np.ndarray:
    """Largest-first patterns, each repeated (in parts, too) until it uses up a class; later ones are without that class.

    So column j can stand for the class it used up, and the columns are a triangular basis.
    """
    rest, basis = wanted.copy(), np.diag((room // lengths).astype(float))
    while rest.any():
        pattern = fill(rest, lengths, room)
        held = np.flatnonzero(pattern)
        ratios = rest[held] / pattern[held]
        used = held[ratios.argmin()]
        basis[:, used] = pattern
        rest[held] -= ratios.min() * pattern[held]
        rest[used] = 0
        rest[rest < 1e-9] = 0
    return basis


def patterns(counts: dict[int, int], room: int, gap: float = 5e-4, rounds: int = 600) -> list[tuple[int, dict[int, int]]]:
    """(times, {class: pieces}) so that every piece of the histogram is in exactly one pattern.

    Column generation stops when a bound (of the material, or of the dual values) shows the linear
    program solved to within ``gap``, or after ``rounds`` columns; any basis reached is feasible, so
    the packing is whole either way.
    """
    lengths = np.array(sorted(counts), dtype=np.int64)
    if not len(lengths):
        return []
    wanted = np.array([counts[int(k)] for k in lengths], dtype=float)
    basis = first_basis(wanted, lengths, room)
    bound = wanted @ lengths / room
    for turn in range(rounds):
        if turn % 100 == 0:  # afresh, against rounding errors
            inverse = np.linalg.inv(basis)
            x = np.maximum(inverse @ wanted, 0)
        prices = np.maximum(inverse.sum(axis=0), 0)
        if x.sum() * (1 - gap) <= bound:
            break
        value, column = best_pattern(prices, lengths, room)
        bound = max(bound, (wanted @ prices) / value)
        if value <= 1 + 1e-9:
            break
        move = inverse @ column
        ratios = np.full(len(x), np.inf)
        np.divide(x, move, out=ratios, where=move > 1e-9)
        out = int(ratios.argmin())
        step = ratios[out]
        x = np.maximum(x - step * move, 0)
        x[out] = step
        basis[:, out] = column
        row = inverse[out] / move[out]
        inverse -= np.outer(move, row)
        inverse[out] = row
    times = np.floor(x + 1e-6).astype(np.int64)
    rest = wanted.astype(np.int64)
    chosen: list[tuple[int, dict[int, int]]] = []
    for j in np.argsort(-times, kind="stable"):
        column = basis[:, j].astype(np.int64)
        held = np.flatnonzero(column)
        n = min(int(times[j]), int((rest[held] // column[held]).min()))
        if n > 0:
            rest[held] -= n * column[held]
            chosen.append((n, {int(lengths[i]): int(column[i]) for i in held}))
    while rest.any():  # what rounding left: fewer sequences than patterns
        pattern = fill(rest, lengths, room).astype(np.int64)
        held = np.flatnonzero(pattern)
        n = int((rest[held] // pattern[held]).min())
        rest[held] -= n * pattern[held]
        chosen.append((n, {int(lengths[i]): int(pattern[i]) for i in held}))
    return chosen


def plan(chosen: list[tuple[int, dict[int, int]]]) -> tuple[int, dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """(number of sequences, for each class the first ranks, first sequences and pieces a sequence of its patterns)."""
    first, rows, ranks = 0, {}, {}
    for times, own in chosen:
        for k, n in own.items():
            rows.setdefault(k, []).append((ranks.get(k, 0), first, n))
            ranks[k] = ranks.get(k, 0) + times * n
        first += times
    return first, {k: tuple(np.array(v).T) for k, v in rows.items()}


def pack(df: DataFrame, path: str, size: int = 2048, end: int = 1, grain: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    docs = materialize(tokenise(whole(df, key, text), path, size, end).drop("text"), "tokens")
    rest = F.col("n_tokens") % size
    docs = docs.select(
        "doc_id", "n_tokens", "sums", rest.alias("rest"), F.floor(F.col("n_tokens") / size).alias("n_full"),
        F.ceil(rest / grain).cast("int").alias("class"), F.pmod(F.xxhash64("doc_id", "sums"), F.lit(SALTS)).alias("salt"))
    room = size // grain
    counts = {r["class"]: r["n"] for r in docs.filter("class > 0").groupBy("class").agg(F.count("*").alias("n")).collect()}  # <= room rows
    n_sequences, places = plan(patterns(counts, room))

    cell = Window.partitionBy("class", "salt").orderBy("doc_id", "n_tokens", "sums")
    ranked = docs.withColumn("rank", F.row_number().over(cell) - 1).withColumn("full", F.sum("n_full").over(cell) - F.col("n_full"))
    cells = docs.groupBy("class", "salt").agg(F.count("*").alias("n"), F.sum("n_full").alias("f"))  # <= room * SALTS rows
    before = Window.partitionBy("class").orderBy("salt")
    inside = cells.select(
        "class", "salt", (F.sum("n").over(before) - F.col("n")).alias("rank0"), (F.sum("f").over(before) - F.col("f")).alias("full0"))
    classes = cells.groupBy("class").agg(F.sum("f").alias("f"))  # <= room + 1 rows
    classes = classes.select("class", (F.sum("f").over(Window.orderBy("class")) - F.col("f") + n_sequences).alias("full1"))
    ranked = ranked.join(inside, ["class", "salt"]).join(classes, "class").select(
        "doc_id", "n_tokens", "sums", "rest", "n_full", "class", (F.col("rank") + F.col("rank0")).alias("rank"),
        (F.col("full") + F.col("full0") + F.col("full1")).alias("full"))

    def make():
        def compute(class_column, rank_column):
            kinds, ranks = class_column.to_numpy(zero_copy_only=False), rank_column.to_numpy(zero_copy_only=False)
            out = np.full(len(kinds), -1, np.int64)
            for k in np.unique(kinds[kinds > 0]):
                first, sequence, n = places[int(k)]
                at = kinds == k
                j = np.searchsorted(first, ranks[at], side="right") - 1
                out[at] = sequence[j] + (ranks[at] - first[j]) // n[j]
            return [pa.array(out, pa.int64())]

        return compute

    placed = append_columns(ranked, ["class", "rank"], [StructField("sequence", LongType())], make, rows=10_000)
    # Documents without a rest have no sequence to share: they are spread over groups of one salt each.
    group = F.when(F.col("class") == 0, -1 - F.pmod(F.xxhash64("doc_id", "sums"), F.lit(1 << 40))).otherwise(F.col("sequence"))
    order = Window.partitionBy("group").orderBy("class", "rank")
    placed = placed.withColumn("group", group).withColumn("offset", F.sum("rest").over(order) - F.col("rest"))
    piece = F.transform(F.sequence(F.lit(0), F.size("sums") - 1), lambda i: F.struct(
        (i.cast("long") * size).alias("start"),
        F.least(F.lit(size).cast("long"), F.col("n_tokens") - i * size).alias("length"),
        F.col("sums")[i].alias("ids_crc32"), F.col("n_tokens").alias("doc_tokens"),
        F.when(i < F.col("n_full"), F.col("full") + i).otherwise(F.col("sequence")).alias("sequence_id"),
        F.when(i < F.col("n_full"), 0).otherwise(F.col("offset")).cast("long").alias("offset")))
    return placed.select("doc_id", F.explode(piece).alias("piece")).select("doc_id", "piece.*")
