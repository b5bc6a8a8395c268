"""SimHash near-duplicates: fingerprints of shingles, linked by the generalised pigeonhole principle.

A fingerprint's bit is 1 if over half of the document's shingle hashes (three words, repeats included,
XXH64 with seed 42) have it set. Two fingerprints link if they differ in at most ``LIMIT`` = 3 bits.

Links are found between distinct fingerprints, so copies cost nothing. The bits are dealt into m partitions, with
correlated bits together, and a fingerprint gets a threshold for each of them: whole numbers from -1 that
add up to 3 - m + 1. If two fingerprints link, then in some partition they differ by at most the threshold of
the one that asks, so it finds the other there by probing the values within the threshold. -1 asks nothing.
The thresholds are each fingerprint's own: dynamic programming takes those with the least estimated cost,
where the candidates of a partition are estimated from histograms of blocks of 8 bits and each probe has
its price. m is the one of ``PARTITIONS`` that makes the cost over all fingerprints least, so partitions widen as the
table grows. Correlations, histograms and costs come from all distinct fingerprints.

Buckets with over ``CROWD`` fingerprints, such as a large group of near copies has, are not expanded into
pairs. Their fingerprints get finer keys: of ``FINER`` = 6 partitions, two that link have three alike, so each three
of them make a key. Fingerprints of keys that are crowded again meet in points of the space instead: two
link if and only if some point lies within one bit of the one and two bits of the other. First all of them meet in the
points within one bit of each, which joins most of a group. Where a crowded key still holds several components, the
points within two bits are made for those that aren't in its largest one. That is linear in the fingerprints and
misses none.

Null texts and texts without a word have the fingerprint zero and link like any other. A null ``doc_id`` counts as
larger than any other. Rows that repeat an id are documents of their own: each has its fingerprint's component.
An empty table gives no rows; extra columns are left out; texts are hashed whole, in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from cellspark.llm.common import append_columns, texts, whole
from cellspark.llm.components import components
from cellspark.llm.ranks import lookup
from cellspark.session import materialize

BITS = 64
LIMIT = 3
SHINGLE = 3
SEED = 42
PARTITIONS = (2, 3, 4)
CROWD = 64
FINER = 6
PROBE_COST = 4.0  # of a probe row, in candidates
BLOCK = 8
LAST = (1 << 63) - 1
HASHED = 1 << 16  # shingles counted at once

_POWERS = np.uint64(1) << np.arange(BITS, dtype=np.uint64)
#: Bits in which two values of a block differ.
_APART = np.array([[(a ^ b).bit_count() for b in range(1 << BLOCK)] for a in range(1 << BLOCK)], np.int8)


def fingerprint(text: str) -> int:
    """Unsigned fingerprint of a text."""
    found = text.encode("utf-8", "replace").lower().split()
    if not found:
        return 0
    span = min(SHINGLE, len(found))
    n = len(found) - span + 1
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(lengths + 1) - 1
    starts, stops = (ends - lengths).tolist(), ends[span - 1 :].tolist()
    joined, digest = b" ".join(found), xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, HASHED):
        part = [digest(joined[a:b], SEED) for a, b in zip(starts[at : min(at + HASHED, n)], stops[at : at + HASHED])]
        counts += bits_of(np.array(part, np.uint64)).sum(axis=0, dtype=np.int64)
    return int(_POWERS[2 * counts > n].sum(dtype=np.uint64))


def bits_of(values: np.ndarray) -> np.ndarray:
    """One row of 64 zeros and ones a value, lowest bit first."""
    return np.unpackbits(np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def fingerprints(df: DataFrame, text: str = "text") -> DataFrame:
    """Append ``fp``, the fingerprint as a signed long."""

    def make():
        def compute(column):
            return [pa.array(np.array([fingerprint(t) for t in texts(column)], np.uint64).view(np.int64))]

        return compute

    return append_columns(df, [text], [StructField("fp", LongType())], make)


def summed(fps: DataFrame, measure, width: int) -> np.ndarray:
    """The sum over all fingerprints of ``measure(bits)``, an array of ``width`` numbers: each task sends one such array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            total += measure(bits_of(batch.column(0).to_numpy().view(np.uint64)))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(total)], names=["at", "x"])

    out = np.zeros(width)
    for at, x in fps.select("fp").mapInArrow(run, "at long, x double").groupBy("at").agg(F.sum("x")).collect():
        out[at] = x
    return out


def correlations(fps: DataFrame) -> np.ndarray:
    """Squared correlation of each two bits."""
    def together(bits):
        wide = bits.astype(np.int64)
        return np.append(np.einsum("ni,nj->ij", wide, wide).ravel(), len(bits)).astype(float)

    found = summed(fps, together, BITS * BITS + 1)
    n, both = max(found[-1], 1), found[:-1].reshape(BITS, BITS)
    ones = np.diag(both) / n
    spread = np.sqrt(np.maximum(ones * (1 - ones), 1e-12))
    return ((both / n - np.outer(ones, ones)) / np.outer(spread, spread)) ** 2


def dealt(related: np.ndarray, m: int) -> list[list[int]]:
    """The bits in m partitions of about equal size: each takes the bit most correlated with those it has."""
    left, out = set(range(BITS)), []
    for k in range(m):
        size = BITS // m + (k < BITS % m)
        own = [max(left, key=lambda b: (sum(related[b, o] for o in left if o != b), -b))]
        left.remove(own[0])
        while len(own) < size:
            own.append(max(left, key=lambda b: (sum(related[b, o] for o in own), -b)))
            left.remove(own[-1])
        out.append(own)
    return out


def packed(bits: np.ndarray, own: list[int]) -> np.ndarray:
    return bits[:, own].astype(np.int64) @ (1 << np.arange(len(own), dtype=np.int64))


def blocks(own: list[int]) -> list[list[int]]:
    return [own[k : k + BLOCK] for k in range(0, len(own), BLOCK)]


class Costs:
    """Estimated cost of each threshold in each partition, and the best thresholds of a fingerprint."""

    def __init__(self, parts: list[list[int]], histograms: np.ndarray, n: float, finer: list[list[int]] = ()):
        self.parts, self.n, self.finer = parts, n, finer
        self.most = LIMIT - len(parts) + 1
        # share of the fingerprints at distance 0 … most from each value of each block
        self.near, at = [], 0
        for own in parts:
            tables = []
            for _ in blocks(own):
                share = histograms[at] / max(n, 1)
                tables.append(np.stack([(_APART == k) @ share for k in range(self.most + 1)], axis=1))
                at += 1
            self.near.append(tables)

    def of(self, bits: np.ndarray) -> np.ndarray:
        """Cost of the thresholds -1 … most: an array (fingerprint, partition, threshold)."""
        out = np.zeros((len(bits), len(self.parts), self.most + 2))
        for p, (own, tables) in enumerate(zip(self.parts, self.near)):
            share = np.zeros((len(bits), self.most + 1))
            share[:, 0] = 1
            for block, table in zip(blocks(own), tables):
                step = table[packed(bits, block)]
                share = np.stack([sum(share[:, j] * step[:, k - j] for j in range(k + 1)) for k in range(self.most + 1)], axis=1)
            probes = np.cumsum([len(list(combinations(own, k))) for k in range(self.most + 1)])
            out[:, p, 1:] = self.n * np.cumsum(share, axis=1) + PROBE_COST * probes
        return out

    def best(self, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least cost of each fingerprint, and its thresholds: they add up to LIMIT - m + 1."""
        cost, m, top = self.of(bits), len(self.parts), self.most + 2
        # with thresholds counted from 0 for -1, they add up to LIMIT + 1
        best = np.full((len(bits), LIMIT + 2), np.inf)
        best[:, 0] = 0
        picks = []
        for p in range(m):
            tried = np.full((len(bits), LIMIT + 2, top), np.inf)
            for t in range(top):
                tried[:, t:, t] = best[:, : LIMIT + 2 - t] + cost[:, p, t : t + 1]
            picks.append(tried.argmin(axis=2))
            best = tried.min(axis=2)
        out, left = np.zeros((len(bits), m), np.int64), np.full(len(bits), LIMIT + 1)
        for p in reversed(range(m)):
            out[:, p] = picks[p][np.arange(len(bits)), left] - 1
            left -= out[:, p] + 1
        return best[:, LIMIT + 1], out


def plan(fps: DataFrame) -> Costs:
    """Partitions, histograms and m for these distinct fingerprints."""
    related = correlations(fps)
    choices = [dealt(related, m) for m in PARTITIONS]
    every = [b for parts in choices for own in parts for b in blocks(own)]

    def histogram(bits):
        return np.concatenate([np.bincount(packed(bits, b), minlength=1 << BLOCK) for b in every]).astype(float)

    found = summed(fps, histogram, len(every) << BLOCK).reshape(len(every), 1 << BLOCK)
    n, costs, at = found[0].sum(), [], 0
    for parts in choices:
        size = sum(len(blocks(own)) for own in parts)
        costs.append(Costs(parts, found[at : at + size], n, dealt(related, FINER)))
        at += size

    def total(bits):
        return np.array([c.best(bits)[0].sum() + PROBE_COST * len(c.parts) * len(bits) for c in costs])

    return costs[int(summed(fps, total, len(costs)).argmin())]


def flips(width: int, most: int) -> np.ndarray:
    """All changes of at most ``most`` of ``width`` bits, as masks."""
    masks = [sum(1 << b for b in picked) for k in range(most + 1) for picked in combinations(range(width), k)]
    return np.array(masks, np.uint64).view(np.int64)


def spread(fps: DataFrame, costs: Costs, probe: bool) -> DataFrame:
    """(bucket, fp): the buckets where a fingerprint lies, or those where it looks. A bucket is a part and its value in one number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                fp = batch.column(0).slice(at, 1024).to_numpy()
                bits = bits_of(fp.view(np.uint64))
                thresholds = costs.best(bits)[1] if probe else np.zeros((len(fp), len(costs.parts)), np.int64)
                for p, own in enumerate(costs.parts):
                    values = packed(bits, own)
                    for t in np.unique(thresholds[thresholds[:, p] >= 0, p]):
                        asks, masks = np.flatnonzero(thresholds[:, p] == t), flips(len(own), int(t))
                        buckets = (values[asks, None] ^ masks).ravel() | (p << BITS // 2)
                        yield pa.RecordBatch.from_arrays([pa.array(buckets), pa.array(np.repeat(fp[asks], len(masks)))], names=["bucket", "fp"])

    return fps.select("fp").mapInArrow(run, "bucket long, fp long")


def finer_keys(fps: DataFrame, costs: Costs) -> DataFrame:
    """(bucket, fp): a key for each three of the finer partitions."""
    chosen = [sum(picked, []) for picked in combinations(costs.finer, FINER - LIMIT)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy()
            bits = bits_of(fp.view(np.uint64))
            for k, own in enumerate(chosen):
                yield pa.RecordBatch.from_arrays([pa.array(packed(bits, own) | (k << 40)), pa.array(fp)], names=["bucket", "fp"])

    return fps.select("fp").mapInArrow(run, "bucket long, fp long")


def points(fps: DataFrame, within: int) -> DataFrame:
    """(fp, point) of the points within so many bits of each ``fp``."""
    masks = flips(BITS, within)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                fp = batch.column(0).slice(at, 256).to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(fp, len(masks))), pa.array((fp[:, None] ^ masks).ravel())], names=["fp", "point"])

    return fps.select("fp").mapInArrow(run, "fp long, point long")


def labels_of(fps: DataFrame, links: DataFrame) -> DataFrame:
    """(fp, label) of every fingerprint; the label is the smallest fingerprint that the links reach."""
    found = components(links).select(F.col("id").alias("fp"), "label")
    return fps.select("fp").join(found, "fp", "left").select("fp", F.coalesce("label", "fp").alias("label"))


def met_in(places: DataFrame, asked: DataFrame, crowd: int) -> tuple[DataFrame, DataFrame]:
    """(a, b) that link and meet in a bucket that isn't crowded, and what lies in the crowded ones or looks there."""
    crowded = materialize(places.groupBy("bucket").count().filter(F.col("count") > crowd).select("bucket"), "crowded")
    found = places.join(crowded, "bucket", "left_anti").withColumnRenamed("fp", "a").join(asked.withColumnRenamed("fp", "b"), "bucket")
    found = found.filter((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= LIMIT))
    links = materialize(found.select("a", "b").distinct(), "links")
    left = places.join(crowded, "bucket", "left_semi").union(asked.join(crowded, "bucket", "left_semi")).distinct()
    return links, materialize(left, "met")


def linked(fps: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(fp, label) of distinct fingerprints ``fps``: those of one component have one label."""
    costs = plan(fps)
    places, asked = materialize(spread(fps, costs, False), "places"), materialize(spread(fps, costs, True), "probes")
    links, met = met_in(places, asked, crowd)
    if met.isEmpty():
        return labels_of(fps, links)
    finer = materialize(finer_keys(met.select("fp").distinct(), costs), "finer")
    more, met = met_in(finer, finer, crowd)
    links = links.union(more)
    if met.isEmpty():
        return labels_of(fps, links)

    # Points compress so well that they look small enough to be broadcast; they are not, hence the hints.
    near = points(met.select("fp").distinct(), 1)
    hubs = near.groupBy("point").agg(F.min("fp").alias("a"), F.max("fp").alias("last")).filter("a <> last").select("point", "a")
    by_point = near.join(hubs.hint("merge"), "point").filter("fp <> a").select("a", F.col("fp").alias("b")).distinct()
    links = materialize(links.union(by_point).distinct(), "links")
    named = materialize(labels_of(fps, links), "named")
    held = materialize(met.join(named, "fp").groupBy("bucket", "label").count(), "held")
    largest = held.groupBy("bucket").agg(F.max(F.struct("count", "label")).alias("most"), F.count("*").alias("kinds")).filter("kinds > 1")
    open_ = materialize(met.join(named, "fp").join(largest.select("bucket", F.col("most.label").alias("main")), "bucket"), "open")
    if open_.isEmpty():
        return named
    few = open_.filter("label <> main").select("fp").distinct()
    near = points(open_.select("fp").distinct(), 1).groupBy("point").agg(F.min("fp").alias("a"))
    far = points(few, 2).join(near.hint("merge"), "point").filter("fp <> a").select("a", F.col("fp").alias("b")).distinct()
    # Only links between two components are new: components of components.
    label = lambda c: named.select(F.col("fp").alias(c), F.col("label").alias(f"of_{c}"))
    apart = far.join(label("a"), "a").join(label("b"), "b").filter("of_a <> of_b").select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))
    joined = components(materialize(apart.distinct(), "apart")).select(F.col("id").alias("label"), F.col("label").alias("root"))
    return named.join(joined, "label", "left").select("fp", F.coalesce("root", "label").alias("label"))


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", crowd: int = CROWD) -> DataFrame:
    """One row per row of ``df``: doc_id, fingerprint (16 hexadecimal digits), component_id (smallest doc_id reachable)."""
    docs = whole(df, key, text).withColumn("doc_id", F.coalesce("doc_id", F.lit(LAST)))
    rows = materialize(fingerprints(docs).drop("text"), "fingerprints")
    classes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("lowest")), "classes")
    named = materialize(linked(classes, crowd).join(classes, "fp"), "labels")
    lowest = named.groupBy("label").agg(F.min("lowest").alias("component_id"))
    found = materialize(lookup(named.select("fp", "label"), lowest, "label").select("fp", "component_id"), "component-ids")
    shown = lambda c: F.when(c < LAST, c)
    return lookup(rows, found, "fp").select(
        shown(F.col("doc_id")).alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        shown(F.col("component_id")).alias("component_id"))
