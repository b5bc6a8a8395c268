"""MinHash near-duplicate detection with tensored banding.

A document's set is its distinct three-word shingles. Two small collections of ``parts`` sub-hashes
each are drawn from it, every sub-hash of ``width`` minhashes; table (i, j) is keyed by the pair of
sub-hash i of the first and j of the second collection. ``parts`` squared tables thus need only
``2 * parts * width`` minhashes, about a square root of what as many independent tables would. Only sub-hashes
that two classes share make table keys: the key of a sub-hash of one class is in a bucket of its own.

At the limit of 0.85 a link is missed with a probability under 1e-4 (``(1 - 0.85**width)**parts`` for
each collection); every reported link is confirmed on the full sets.

How hot groups are kept from growing to all pairs: equal sets are one class with one set of keys.
Each bucket of a table has a reference, the earliest document that shares any bucket with one of its
members. A class is compared with the references of its buckets only, once each. What is still apart
within a reference's group is found by the differences to the reference: two classes that link but
don't both link to it must share a large part of their differences, so short prefixes of these, in
order of rarity, meet in every such pair (`may_link`). No link of a bucket is lost.

Shingles and classes are compared by 64-bit and 128-bit hashes. Null and empty texts have an empty
set and no links. A null ``doc_id`` counts as larger than any other. Rows that repeat an id are
documents of their own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField

from cellspark.llm.common import append_columns, give_back, texts, whole
from cellspark.llm.components import components
from cellspark.session import materialize

SHINGLE = 3
REMEMBERED = 100_000  # words, some 20 MB
LAST = (1 << 63) - 1


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(text: str, known: WordHashes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles; words are split and lowered as ASCII."""
    found = text.encode("utf-8", "replace").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
    span = min(size, len(h))
    n = len(h) - span + 1
    mixed = np.full(n, span, np.uint64)
    for k in range(span):
        mixed = (mixed ^ h[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(31)
    return np.unique(mixed)


class Signer:
    """Sub-hashes of both collections: each mixes ``width`` minhashes."""

    def __init__(self, parts: int, width: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        n = 2 * parts * width
        self.factors = rng.integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.shifts = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        self.parts, self.width = parts, width

    def sign(self, values: np.ndarray) -> np.ndarray:
        low = np.array([(values * f + s).min() for f, s in zip(self.factors, self.shifts)])
        low = low.reshape(2 * self.parts, self.width)
        out = np.zeros(2 * self.parts, np.uint64)
        for k in range(self.width):
            out = (out ^ low[:, k]) * np.uint64(0xC2B2AE3D27D4EB4F)
            out ^= out >> np.uint64(29)
        return out.view(np.int64)


def sign(df: DataFrame, parts: int, width: int, size: int, text: str = "text") -> DataFrame:
    """Append n_shingles, set_key (128 bits) and the sub-hashes; none for an empty set."""

    def make():
        signer, known = Signer(parts, width), WordHashes()

        def compute(column):
            sizes, keys, hashes = [], [], []
            for t in texts(column):
                if len(known) > REMEMBERED:
                    known.clear()
                own = shingles(t, known, size)
                sizes.append(len(own))
                keys.append(xxhash.xxh3_128_digest(own.tobytes()))
                hashes.append(signer.sign(own).tolist() if len(own) else [])
            return [pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(hashes, pa.list_(pa.int64()))]

        return compute

    fields = [StructField("n_shingles", LongType()), StructField("set_key", BinaryType()), StructField("hashes", ArrayType(LongType()))]
    return append_columns(df, [text], fields, make)


def with_sets(df: DataFrame, size: int, text: str = "text") -> DataFrame:
    """Append ``shingles``: the sorted shingle hashes."""

    def make():
        known = WordHashes()

        def compute(column):
            known.clear()
            return [pa.array([shingles(t, known, size).view(np.int64) for t in texts(column)], pa.list_(pa.int64()))]

        return compute

    return append_columns(df, [text], [StructField("shingles", ArrayType(LongType()))], make)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union on the full sets."""
    left = pairs.select("a", "b").join(sets.select(F.col("class").alias("a"), F.col("shingles").alias("own")), "a")
    both = left.join(sets.select(F.col("class").alias("b"), F.col("shingles").alias("other")), "b").select("a", "b", "own", "other")

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                p, q = x.values.to_numpy(), y.values.to_numpy()
                if 100 * min(len(p), len(q)) < percent * max(len(p), len(q)):
                    keep.append(False)
                    continue
                common = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * common >= percent * (len(p) + len(q) - common))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
        give_back()

    return both.mapInArrow(run, "a long, b long")


def compared(members: DataFrame, sets: DataFrame, elements: bool) -> DataFrame:
    """Compare each (class, ref): n and n_ref shingles and d, those in only one of the two.

    With ``elements`` also the shingles themselves: ``lost`` are only in the reference, ``added`` only in the class.
    """
    own = members.join(sets.select("class", F.col("shingles").alias("own")), "class")
    both = own.join(sets.select(F.col("class").alias("ref"), F.col("shingles").alias("base")), "ref").select("class", "ref", "own", "base")

    def run(batches):
        for batch in batches:
            sizes, lost, added = [], [], []
            for x, y in zip(batch.column(2), batch.column(3)):
                p, q = x.values.to_numpy(), y.values.to_numpy()
                common = np.intersect1d(p, q, assume_unique=True)
                sizes.append((len(p), len(q), len(p) + len(q) - 2 * len(common)))
                if elements:
                    lost.append(np.setdiff1d(q, common, assume_unique=True))
                    added.append(np.setdiff1d(p, common, assume_unique=True))
            columns = [pa.array([s[k] for s in sizes], pa.int64()) for k in range(3)]
            columns += [pa.array(e, pa.list_(pa.int64())) for e in (lost, added) if elements]
            yield pa.RecordBatch.from_arrays(batch.columns[:2] + columns, names=names)
        give_back()

    names = ["class", "ref", "n", "n_ref", "d"] + ["lost", "added"] * elements
    return both.mapInArrow(run, "class long, ref long, n long, n_ref long, d long" + ", lost array<long>, added array<long>" * elements)


def may_link(members: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) with different labels and one reference that can link: every pair that does is among them.

    Takes ``compared`` with elements and labels. Of two classes that differ from their reference by
    ``d_a`` and ``d_b`` shingles, ``o`` of these the same, exactly ``d_a + d_b - 2 * o`` shingles are in only
    one; they link if ``whole * that <= (100 - percent) * (n_a + n_b)`` with ``whole = 100 + percent``. So with
    ``f = whole * d - (100 - percent) * n`` they link if ``2 * whole * o >= f_a + f_b``. At least one of the two
    is far, not linked to the reference, which makes the right side positive. Bounds of ``o`` from below
    give the prefixes that must meet; its bounds from above are the shared elements at and after the
    place where they meet, and those of either side. Elements of one class only can't be shared.
    """
    whole_ = 100 + percent
    f = whole_ * F.col("d") - (100 - percent) * F.col("n")
    open_ = members.select("ref", "class", "label", f.alias("f"), (f > (100 - percent) * F.col("n_ref")).alias("far"), "lost", "added")
    side = lambda name: F.transform(name, lambda s: F.struct(s.alias("s"), F.lit(name).alias("side")))
    unpacked = open_.select("ref", "class", "label", "f", "far", F.explode(F.concat(side("lost"), side("added"))).alias("e")).select("*", "e.*").drop("e")
    often = unpacked.groupBy("ref", "s").agg(F.count("*").alias("often")).filter("often > 1")
    shared = unpacked.join(often, ["ref", "s"]).groupBy("ref", "class", "label", "f", "far").agg(
        F.array_sort(F.collect_list(F.struct("often", "s")))["s"].alias("by"),
        F.count("*").alias("m"), F.count(F.when(F.col("side") == "lost", 1)).alias("m_lost"))
    shared = materialize(shared, "differences")
    low_far = shared.filter("far").groupBy("ref").agg(F.min("f").alias("low_far"))
    useful = shared.join(low_far, "ref").filter(F.col("far") | (2 * whole_ * F.col("m") >= F.col("f") + F.col("low_far")))
    # Written, so that the next aggregate doesn't keep the join from splitting a hot reference.
    useful = materialize(useful, "useful")
    low_near = useful.filter("not far").groupBy("ref").agg(F.min("f").alias("low_near"))
    useful = useful.join(low_near, "ref", "left")

    def prefix(rows: DataFrame, low: str, name: str) -> DataFrame:
        least = F.greatest(F.lit(1), F.ceil((F.col("f") + F.col(low)) / (2 * whole_)))
        length = (F.col("m") - least + 1).cast("int")
        rows = rows.filter(length > 0).select("ref", "class", "label", "f", "m", "m_lost", F.posexplode(F.slice("by", F.lit(1), length)).alias("at", "s"))
        return rows.select("ref", "s", *[F.col(c).alias(f"{c}_{name}") for c in ("class", "label", "f", "m", "m_lost", "at")])

    most = F.least(
        F.least("m_lost_a", "m_lost_b") + F.least(F.col("m_a") - F.col("m_lost_a"), F.col("m_b") - F.col("m_lost_b")),
        F.col("m_a") - F.col("at_a"), F.col("m_b") - F.col("at_b"))
    fits = (F.col("label_a") != F.col("label_b")) & (2 * whole_ * most >= F.col("f_a") + F.col("f_b"))
    far = useful.filter("far")
    pairs = prefix(far, "low_far", "a").join(prefix(far, "low_far", "b"), ["ref", "s"]).filter(fits & (F.col("class_a") < F.col("class_b")))
    mixed = prefix(useful.filter("not far"), "low_far", "a").join(prefix(far.filter("low_near is not null"), "low_near", "b"), ["ref", "s"]).filter(fits)
    ends = [F.least("class_a", "class_b").alias("a"), F.greatest("class_a", "class_b").alias("b")]
    return pairs.select(ends).union(mixed.select(ends)).distinct()


class Merged:
    """Components found so far, as (id, label); a class without a row is its own."""

    def __init__(self, spark):
        self.labels = spark.createDataFrame([], "id long, label long")
        self.empty = True

    def label(self, df: DataFrame, column: str, name: str) -> DataFrame:
        if self.empty:
            return df.withColumn(name, F.col(column))
        own = self.labels.select(F.col("id").alias(column), F.col("label").alias("__label"))
        return df.join(own, column, "left").withColumn(name, F.coalesce("__label", F.col(column))).drop("__label")

    def apart(self, pairs: DataFrame) -> DataFrame:
        """Pairs of classes of different components."""
        return self.label(self.label(pairs, "a", "ca"), "b", "cb").filter("ca <> cb")

    def add(self, links: DataFrame) -> None:
        """Joins the components of each linked pair."""
        edges = materialize(self.apart(links).select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct(), "links")
        if edges.isEmpty():
            return
        new = components(edges)
        if self.empty:
            self.labels, self.empty = new, False
            return
        step = new.select(F.col("id").alias("label"), F.col("label").alias("root"))
        moved = self.labels.join(step, "label", "left").select("id", F.coalesce("root", "label").alias("label"))
        fresh = new.join(self.labels, "id", "left_anti")
        self.labels = materialize(moved.union(fresh), "merged")


def groups(
    df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 85, parts: int = 8, width: int = 2, size: int = SHINGLE,
) -> DataFrame:
    """One row per row of ``df``: doc_id, text_key, n_shingles, component_id and the component's own ``label``.

    A null id is ``LAST``. Two components can share a component_id where rows share an id, but no label.
    """
    spark = df.sparkSession
    docs = whole(df, key, text).withColumn("doc_id", F.coalesce("doc_id", F.lit(LAST))).withColumn("text_key", F.xxhash64("text"))
    rows = materialize(sign(docs, parts, width, size).drop("text"), "signatures")
    first = rows.groupBy("set_key").agg(F.min(F.struct("doc_id", "text_key", "n_shingles", "hashes")).alias("one"))
    # Sorted, so that the numbers follow the documents' ids.
    classes = materialize(first.select("set_key", "one.*").orderBy("doc_id").withColumn("class", F.monotonically_increasing_id()), "classes")

    # A table's bucket can only hold two classes if both of its sub-hashes do, so the others make no keys.
    parted = classes.filter("n_shingles > 0").select("class", F.posexplode("hashes").alias("at", "h"))
    shared = parted.groupBy("at", "h").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).filter("lo <> hi").select("at", "h")
    held = parted.join(shared, ["at", "h"], "left_semi").groupBy("class").agg(F.collect_list(F.struct("at", "h")).alias("subs"))
    half = lambda first: F.filter("subs", lambda s: (s["at"] < parts) == F.lit(first))
    table = lambda x, y: F.xxhash64(x["h"], y["h"], x["at"] * parts + y["at"] - parts)
    keys = F.flatten(F.transform(half(True), lambda x: F.transform(half(False), lambda y: table(x, y))))
    members = materialize(held.select("class", F.explode(keys).alias("key")), "keys")
    buckets = members.groupBy("key").agg(F.min("class").alias("hub"), F.max("class").alias("last")).filter("hub <> last")
    crowded = materialize(members.join(buckets.select("key", "hub"), "key"), "buckets")
    earliest = crowded.groupBy("class").agg(F.min("hub").alias("earliest"))
    references = crowded.join(earliest, "class").groupBy("key").agg(F.min("earliest").alias("ref"))
    grouped = materialize(crowded.select("key", "class").join(references, "key").select("class", "ref").distinct().filter("class <> ref"), "groups")
    merged = Merged(spark)
    if not grouped.isEmpty():
        needed = grouped.select("class").union(grouped.select("ref")).distinct().join(classes.select("class", "doc_id", "text_key"), "class")
        chosen = docs.join(needed, ["doc_id", "text_key"]).dropDuplicates(["class"])
        sets = materialize(with_sets(chosen, size).select("class", "shingles"), "sets")
        linked = (100 + percent) * F.col("d") <= (100 - percent) * (F.col("n") + F.col("n_ref"))
        merged.add(compared(grouped, sets, False).filter(linked).select(F.col("class").alias("a"), F.col("ref").alias("b")))
        # Groups that still hold several components: the rest, exactly.
        placed = materialize(merged.label(grouped, "class", "label"), "placed")
        mixed = placed.groupBy("ref").agg(F.min("label").alias("l"), F.max("label").alias("h")).filter("l <> h").select("ref")
        open_classes = materialize(placed.join(mixed, "ref"), "open")
        if not open_classes.isEmpty():
            differing = compared(open_classes.select("class", "ref"), sets, True).join(open_classes, ["class", "ref"])
            merged.add(confirmed(materialize(may_link(differing, percent), "rest"), sets, percent))
    labelled = merged.label(classes.select("set_key", "class", "doc_id", "n_shingles"), "class", "label")
    lowest = labelled.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return rows.join(labelled.join(lowest, "label").select("set_key", "component_id", "label"), "set_key").drop("hashes", "set_key")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per row of ``df``: doc_id, n_shingles, component_id (smallest doc_id reachable), kept."""
    # Empty sets are linked with nothing, not even with each other.
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    shown = lambda c: F.when(c < LAST, c)
    return groups(df, key, text, **options).select(
        shown(F.col("doc_id")).alias("doc_id"), "n_shingles", shown(component).alias("component_id"), (F.col("doc_id") == component).alias("kept"))
