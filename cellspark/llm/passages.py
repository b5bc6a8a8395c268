"""Removal of passages that stand in a document with a smaller id: every byte that is covered by a
50-byte string which also starts there.

1. Documents are dealt into chunks by hash. Every 50-byte window has a marker, the smallest hash of
   its 16-byte substrings; equal windows have equal markers. Chunks send their distinct markers to
   buckets, which tell each chunk those that several documents hold.
2. Windows in a row with one such marker are a unit. Chunks send their distinct units with the
   smallest id to a bucket of the marker. There the units' windows are put in suffix order by
   deep-shallow sorting, equal ones get the smallest id of all, and chunks are told.
3. Chunks mark the windows with a smaller id elsewhere and cut out what they cover.

Only distinct markers and units of a chunk travel, packed by (chunk, bucket): a passage in a third of
all documents costs one entry per chunk and no task gathers its copies. A marker held by over ``hot``
documents may have as many units; its windows are units of their own, dealt by their content, so the
bound of a bucket holds for them as well. Chunks and buckets are as many as the corpus has
``CHUNK`` bytes. The documents' shuffle into chunks is one exchange that all three steps reuse.

Null text counts as empty, a null ``doc_id`` as larger than any other. Rows that share an id don't
remove from each other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellspark.llm.common import give_back, release_others
from cellspark.llm.suffix import sort_windows

LENGTH, GRAM = 50, 16
CHUNK, HOT = 6 << 20, 2000
BLOCK = 1 << 17  # windows whose markers are worked out at a time
LAST = (1 << 63) - 1

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def mixed(x: np.ndarray) -> np.ndarray:
    x = x * _MIX[0]
    x ^= x >> np.uint64(32)
    x *= _MIX[1]
    x ^= x >> np.uint64(29)
    return x


def window_markers(raw: np.ndarray) -> np.ndarray:
    """The marker of every window of these bytes."""
    n = len(raw) - LENGTH + 1
    view = np.lib.stride_tricks.as_strided(raw[:8].view("<u8"), (len(raw) - 7,), (1,))
    low = mixed(view[: len(raw) - GRAM + 1] ^ _MIX[1])
    low ^= view[8:]
    low = mixed(low)
    for step in (1, 2, 4, 8, 16):
        low = np.minimum(low[:-step], low[step:])
    return np.minimum(low[:n], low[LENGTH - GRAM + 1 - 32 :][:n])


class Runs:
    """Runs of windows with one marker in the texts of a chunk: ``first`` and ``last`` window, ``marker``, ``doc``.

    Markers are made block by block, with the window before and the one after, and only those of runs are kept.
    """

    def __init__(self, block: list[bytes], ids: np.ndarray):
        self.data = b"".join(block)
        sizes = np.array([len(t) for t in block], np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        n = len(self.data) - LENGTH + 1
        if n <= 0:
            self.first = self.last = self.doc = np.zeros(0, np.int64)
            self.marker = np.zeros(0, np.uint64)
            return
        raw = np.frombuffer(self.data, np.uint8)
        valid = np.ones(n, np.bool_)
        for e in self.ends[:-1].tolist():
            valid[max(0, e - LENGTH + 1) : e] = False
        first, last, marker = [], [], []
        for at in range(0, n, BLOCK):
            end = min(at + BLOCK, n)
            lo, hi = max(at - 1, 0), min(end + 1, n)
            low, ok = window_markers(raw[lo : hi + LENGTH - 1]), valid[lo:hi]
            change = low[1:] != low[:-1]
            begins, stops = ok.copy(), ok.copy()
            begins[1:] &= change | ~ok[:-1]
            stops[:-1] &= change | ~ok[1:]
            first.append(np.flatnonzero(begins[at - lo : end - lo]) + at)
            last.append(np.flatnonzero(stops[at - lo : end - lo]) + at)
            marker.append(low[first[-1] - lo])
        self.first, self.last, self.marker = np.concatenate(first), np.concatenate(last), np.concatenate(marker)
        self.doc = np.searchsorted(self.ends, self.first, side="right")
        self.ids = ids[self.doc]

    def units(self, shared: np.ndarray, hot: np.ndarray):
        """(first, windows, hash, marker, id) of the units whose marker is shared; all windows of a hot marker are units."""
        at = np.minimum(np.searchsorted(shared, self.marker), max(0, len(shared) - 1))
        found = np.flatnonzero(shared[at] == self.marker) if len(shared) else np.zeros(0, np.int64)
        is_hot = hot[at[found]] if len(found) else np.zeros(0, np.bool_)
        plain, split = found[~is_hot], found[is_hot]
        count = self.last[split] - self.first[split] + 1
        every = np.repeat(self.first[split] - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum()) if len(split) else np.zeros(0, np.int64)
        first = np.r_[self.first[plain], every]
        windows = np.r_[self.last[plain] - self.first[plain] + 1, np.ones(len(every), np.int64)]
        ids = np.r_[self.ids[plain], np.repeat(self.ids[split], count)] if len(found) else np.zeros(0, np.int64)
        data, h = self.data, xxhash.xxh3_64_intdigest
        hashes = np.fromiter((h(data[a:b]) for a, b in zip(first.tolist(), (first + windows + LENGTH - 1).tolist())), np.uint64, len(first))
        marker = np.r_[self.marker[plain], hashes[len(plain) :]]
        return first, windows, hashes, marker, ids


def runs_of(table: pa.Table) -> Runs:
    return Runs(table.column("text").to_pylist(), table.column("id").to_numpy())


def split_by(bucket: np.ndarray):
    """(bucket, its members) in order."""
    order = np.argsort(bucket, kind="stable")
    values, begin = np.unique(bucket[order], return_index=True)
    return zip(values.tolist(), np.split(order, begin[1:]))


def batch(schema: str, rows: list[tuple]) -> pa.Table:
    kinds = {"int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.table({name: pa.array([r[i] for r in rows], kinds[kind]) for i, (name, kind) in enumerate(fields)})


SENT = "chunk int, bucket int, a binary, b binary, c binary, d binary"
TOLD = "chunk int, kind int, a binary, b binary, c binary, d binary"


def markers(n: int):
    """Step 1, chunk: distinct markers with the number of documents that hold each."""

    def run(table: pa.Table) -> pa.Table:
        runs, chunk = runs_of(table), table.column("chunk")[0].as_py()
        if not len(runs.first):
            return batch(SENT, [])
        order = np.lexsort((runs.ids, runs.marker))
        m, i = runs.marker[order], runs.ids[order]
        new = np.r_[True, m[1:] != m[:-1]]
        another = new | np.r_[True, i[1:] != i[:-1]]
        values, counts = m[new], np.add.reduceat(another.astype(np.uint32), np.flatnonzero(new))
        return batch(SENT, [
            (chunk, b, values[at].tobytes(), counts[at].astype("<u4").tobytes(), b"", b"") for b, at in split_by(mixed(values) % np.uint64(n))])

    return run


def joined(table: pa.Table, column: str, kind) -> tuple[np.ndarray, np.ndarray]:
    """(all numbers of a packed column, the row that each came from)."""
    parts = [np.frombuffer(x, kind) for x in table.column(column).to_pylist()]
    return np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts])


def shared_markers(hot: int):
    """Step 1, bucket: to each chunk its markers that several documents hold, and which of them are hot."""

    def run(table: pa.Table) -> pa.Table:
        values, row = joined(table, "a", np.uint64)
        counts, _ = joined(table, "b", "<u4")
        unique, place = np.unique(values, return_inverse=True)
        total = np.bincount(place, weights=counts, minlength=len(unique))[place]
        chunks = table.column("chunk").to_pylist()
        keep = np.flatnonzero(total > 1)
        return batch(TOLD, [
            (chunks[r], 0, values[keep[at]].tobytes(), (total[keep[at]] > hot).tobytes(), b"", b"") for r, at in split_by(row[keep])])

    return run


def known_markers(told: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    rows = [(a, b) for k, a, b in zip(*(told.column(c).to_pylist() for c in ("kind", "a", "b"))) if k == 0]
    if not rows:
        return np.zeros(0, np.uint64), np.zeros(0, np.bool_)
    shared = np.concatenate([np.frombuffer(a, np.uint64) for a, _ in rows])
    hot = np.concatenate([np.frombuffer(b, np.bool_) for _, b in rows])
    order = np.argsort(shared)
    return shared[order], hot[order]


def packed(data: bytes) -> bytes:
    return pa.compress(data, "zstd", asbytes=True)


def unpacked(data: bytes, size: int) -> bytes:
    return pa.decompress(data, size, "zstd", asbytes=True)


def send_units(n: int):
    """Step 2, chunk: distinct units with their smallest and largest id, to the bucket of their marker."""

    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        if not told.num_rows or not table.num_rows:
            return batch(SENT, [])
        runs, chunk = runs_of(table), table.column("chunk")[0].as_py()
        first, windows, hashes, marker, ids = runs.units(*known_markers(told))
        if not len(first):
            return batch(SENT, [])
        order = np.lexsort((ids, hashes))
        new = np.r_[True, hashes[order[1:]] != hashes[order[:-1]]]
        begin = np.flatnonzero(new)
        one, lowest, highest = order[begin], ids[order[begin]], ids[order[np.r_[begin[1:], len(order)] - 1]]
        rows = []
        for b, at in split_by(mixed(marker[one]) % np.uint64(n)):
            own = one[at]
            content = b"".join([runs.data[a : a + w + LENGTH - 1] for a, w in zip(first[own].tolist(), windows[own].tolist())])
            rows.append((chunk, b, hashes[own].tobytes(), windows[own].astype("<u4").tobytes(),
                         packed(np.r_[lowest[at], highest[at] - lowest[at]].astype("<i8").tobytes()), packed(content)))
        return batch(SENT, rows)

    return run


def order_units(table: pa.Table) -> pa.Table:
    """Step 2, bucket: the smallest id of every window, to the chunks with a larger one.

    Told per chunk: unit hash, first and end window, smallest id, of each run of windows with one id.
    """
    hashes, row = joined(table, "a", np.uint64)
    windows = joined(table, "b", "<u4")[0].astype(np.int64)
    number = np.bincount(row)
    bounds = [np.frombuffer(unpacked(x, 16 * n), "<i8").reshape(2, -1) for x, n in zip(table.column("c").to_pylist(), number.tolist())]
    lowest = np.concatenate([b[0] for b in bounds])
    highest = lowest + np.concatenate([b[1] for b in bounds])
    sizes = windows + LENGTH - 1
    total = np.bincount(row, weights=sizes).astype(np.int64)
    data = b"".join(unpacked(x, int(n)) for x, n in zip(table.column("d").to_pylist(), total))
    begin = np.cumsum(sizes) - sizes
    unique, one, place = np.unique(hashes, return_index=True, return_inverse=True)
    least = np.full(len(unique), LAST, np.int64)
    np.minimum.at(least, place, lowest)
    count = windows[one]
    ahead = np.cumsum(count) - count
    starts = np.repeat(begin[one] - ahead, count) + np.arange(count.sum())
    order, head = sort_windows(data, starts, LENGTH)
    own = np.repeat(least, count)[order]
    heads = np.flatnonzero(head == np.arange(len(head)))
    low = np.empty(len(order), np.int64)
    low[order] = np.repeat(np.minimum.reduceat(own, heads), np.diff(np.r_[heads, len(order)]))
    # Runs of windows of a unit with one smallest id.
    change = np.r_[True, low[1:] != low[:-1]]
    change[ahead] = True
    at = np.flatnonzero(change)
    unit = np.searchsorted(ahead, at, side="right") - 1
    stop = np.r_[at[1:], len(low)]
    first_run = np.searchsorted(unit, np.arange(len(unique)))
    n_runs = np.bincount(unit, minlength=len(unique))
    # Every chunk's unit with every run of it.
    times = n_runs[place]
    sent = np.repeat(np.arange(len(hashes)), times)
    run = np.repeat(first_run[place] - (np.cumsum(times) - times), times) + np.arange(times.sum())
    keep = low[at[run]] < highest[sent]
    sent, run = sent[keep], run[keep]
    chunks = table.column("chunk").to_pylist()
    base = ahead[unit[run]]
    return batch(TOLD, [
        (chunks[r], 1, hashes[sent[k]].tobytes(), (at[run[k]] - base[k]).astype("<u4").tobytes(),
         (stop[run[k]] - base[k]).astype("<u4").tobytes(), low[at[run[k]]].astype("<i8").tobytes())
        for r, k in split_by(row[sent])])


def cut_out(names: list[str]):
    """Step 3, chunk: the documents without the bytes that windows with a smaller id cover."""

    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        block = table.column("text").to_pylist()
        runs = runs_of(table)
        edge = np.zeros(len(runs.data) + 1, np.int32)
        news = [r for r in told.select(["kind", "a", "b", "c", "d"]).to_pylist() if r["kind"] == 1]
        if news:
            first, _, hashes, _, ids = runs.units(*known_markers(told))
            unit, begin, stop, low = (np.concatenate([np.frombuffer(r[c], k) for r in news]) for c, k in zip("abcd", (np.uint64, "<u4", "<u4", "<i8")))
            order = np.argsort(unit, kind="stable")
            unit, begin, stop, low = unit[order], begin[order].astype(np.int64), stop[order].astype(np.int64), low[order]
            left = np.searchsorted(unit, hashes, side="left")
            times = np.searchsorted(unit, hashes, side="right") - left
            own = np.repeat(np.arange(len(hashes)), times)
            entry = np.repeat(left - (np.cumsum(times) - times), times) + np.arange(times.sum())
            keep = low[entry] < ids[own]
            own, entry = own[keep], entry[keep]
            np.add.at(edge, first[own] + begin[entry], 1)
            np.add.at(edge, first[own] + stop[entry] + LENGTH - 1, -1)
        gone = np.cumsum(edge, out=edge)[:-1] > 0
        raw = np.frombuffer(runs.data, np.uint8)
        out = {c: [] for c in ("n_bytes", "n_removed", "n_spans", "kept")}
        for text, a, b in zip(block, runs.starts.tolist(), runs.ends.tolist()):
            mask = gone[a:b]
            n = int(np.count_nonzero(mask))
            out["n_bytes"].append(b - a)
            out["n_removed"].append(n)
            out["n_spans"].append(int(mask[0]) + int(np.count_nonzero(mask[1:] & ~mask[:-1])) if n else 0)
            out["kept"].append(raw[a:b][~mask].tobytes() if n else text)
        kinds = [pa.int64()] * 3 + [pa.binary()]
        new = [pa.array(v, k) for v, k in zip(out.values(), kinds)]
        return pa.table([table.column(c) for c in names] + new, names=names + list(out))

    return run


def _tidied(run, *tables: pa.Table) -> pa.Table:
    """A group's result; what its arrays took goes back to the system before the next one."""
    release_others(__name__)
    out = run(*tables)
    give_back()
    return out


def of_one(run):
    return lambda table: _tidied(run, table)


def of_two(run):
    return lambda table, told: _tidied(run, table, told)


def remove_repeats(
    df: DataFrame, key: str = "doc_id", text: str = "text", carry: tuple[str, ...] = (), chunk_bytes: int = CHUNK,
    hot: int = HOT,
) -> DataFrame:
    """One row per row of ``df``: ``carry`` (under its names), n_bytes, n_removed, n_spans and ``kept`` (binary).

    Names in ``carry`` that clash with the result's are not allowed; the key is carried as itself.
    """
    total = df.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    n = max(1, -(-total // chunk_bytes))
    names = [f"c{i}" for i in range(len(carry) + 1)]
    docs = df.select(
        *[F.col(c).alias(name) for c, name in zip((key, *carry), names)],
        F.coalesce(F.col(key).cast("long"), F.lit(LAST)).alias("id"),
        F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("text"),
        F.pmod(F.xxhash64(F.col(key), F.col(text)), F.lit(n)).cast("int").alias("chunk"))
    chunks = docs.groupBy("chunk")
    told = chunks.applyInArrow(of_one(markers(n)), SENT).groupBy("bucket").applyInArrow(of_one(shared_markers(hot)), TOLD)
    units = chunks.cogroup(told.groupBy("chunk")).applyInArrow(of_two(send_units(n)), SENT)
    low = units.groupBy("bucket").applyInArrow(of_one(order_units), TOLD)
    fields = ", ".join(f"{name} {docs.schema[name].dataType.simpleString()}" for name in names)
    out = chunks.cogroup(told.unionByName(low).groupBy("chunk")).applyInArrow(
        of_two(cut_out(names)), fields + ", n_bytes long, n_removed long, n_spans long, kept binary")
    return out.withColumnsRenamed(dict(zip(names, (key, *carry))))
