"""Language identification by a convolutional network over bytes.

The network embeds the bytes of a window of fixed length, runs filters of several widths over it,
keeps each filter's maximum and ends in a softmax over the languages. It is trained in numpy on
windows of labelled documents. A text is predicted from all its windows, in batches: the document's
probabilities are the mean over its windows.

Training reads a bounded sample (``documents`` texts a language, ``windows`` windows of each): the
sample's share is computed from the counts, so it is spread over the whole table. Only the sample
and the weights, a few thousand numbers, pass through the driver. A text that is null or has no
letter is ``und`` with score 0. An unlabelled table gives ``und`` for every row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField

from cellspark.llm.common import append_columns

NO_LANGUAGE = "und"


@dataclass(frozen=True)
class Shape:
    """Sizes of the network."""

    window: int = 256
    embedding: int = 8
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 16


def to_windows(texts: list[str], size: int, widest: int) -> tuple[np.ndarray, np.ndarray]:
    """(windows of all texts, zero padded; the text of each). Neighbours share ``widest - 1`` bytes, so no filter misses a place."""
    parts, owners = [], []
    step = size - widest + 1
    for i, text in enumerate(texts):
        data = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)
        n = max(1, -(-(len(data) - widest + 1) // step))
        padded = np.zeros((n - 1) * step + size, np.uint8)
        padded[: len(data)] = data
        parts.append(np.lib.stride_tricks.sliding_window_view(padded, size)[::step])
        owners.append(np.full(n, i))
    return np.concatenate(parts), np.concatenate(owners)


class Network:
    """Weights and both passes. Filters of all widths sit in one matrix, padded with zeros to the widest."""

    def __init__(self, shape: Shape, languages: list[str], seed: int = 1):
        rng = np.random.default_rng(seed)
        self.shape, self.languages = shape, languages
        widest, d = max(shape.widths), shape.embedding
        n = shape.filters * len(shape.widths)
        self.mask = np.zeros((widest * d, n), np.float32)
        for k, w in enumerate(shape.widths):
            self.mask[: w * d, k * shape.filters : (k + 1) * shape.filters] = 1
        self.weights = [
            rng.normal(0, 0.5, (256, d)).astype(np.float32),
            (rng.normal(0, 1, self.mask.shape) / np.sqrt(widest * d)).astype(np.float32) * self.mask,
            np.zeros(n, np.float32),
            (rng.normal(0, 1, (n, len(languages))) / np.sqrt(n)).astype(np.float32),
            np.zeros(len(languages), np.float32)]
        self.weights[0][0] = 0  # the padding byte

    def forward(self, data: np.ndarray):
        embed, filters, bias, out, out_bias = self.weights
        widest, d = max(self.shape.widths), self.shape.embedding
        places = data.shape[1] - widest + 1
        x = embed[data].reshape(len(data), -1)
        cols = np.lib.stride_tricks.sliding_window_view(x, widest * d, axis=1)[:, ::d]
        values = (cols.reshape(-1, widest * d) @ filters).reshape(len(data), places, -1)
        at = values.argmax(axis=1) if self.training else None
        top = (np.take_along_axis(values, at[:, None], 1)[:, 0] if self.training else values.max(axis=1)) + bias
        hidden = np.maximum(top, 0)
        logits = hidden @ out + out_bias
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        return p / p.sum(axis=1, keepdims=True), hidden, at

    training = False

    def gradients(self, data: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
        embed, filters, _, out, _ = self.weights
        widest, d = max(self.shape.widths), self.shape.embedding
        self.training = True
        p, hidden, at = self.forward(data)
        self.training = False
        loss = -np.log(p[np.arange(len(p)), labels] + 1e-9).mean()
        delta = p.copy()
        delta[np.arange(len(p)), labels] -= 1
        delta /= len(p)
        back = (delta @ out.T) * (hidden > 0)  # (windows, filters)
        chosen = data[np.arange(len(data))[:, None, None], at[:, :, None] + np.arange(widest)]  # (windows, filters, widest)
        seen = embed[chosen].reshape(len(data), at.shape[1], -1)
        g_filters = np.einsum("bf,bfk->kf", back, seen) * self.mask
        g_seen = (back[:, :, None] * filters.T[None]).reshape(-1, d)
        g_embed = np.zeros_like(embed)
        np.add.at(g_embed, chosen.reshape(-1), g_seen)
        g_embed[0] = 0
        return loss, [g_embed, g_filters, back.sum(0), hidden.T @ delta, delta.sum(0)]

    def fit(self, data: np.ndarray, labels: np.ndarray, rounds: int = 6, batch: int = 64, rate: float = 0.01, seed: int = 2) -> Network:
        """Adam with a falling rate."""
        rng = np.random.default_rng(seed)
        first = [np.zeros_like(w) for w in self.weights]
        second = [np.zeros_like(w) for w in self.weights]
        step, steps = 0, rounds * -(-len(data) // batch)
        for _ in range(rounds):
            order = rng.permutation(len(data))
            for start in range(0, len(data), batch):
                part = order[start : start + batch]
                _, grads = self.gradients(data[part], labels[part])
                step += 1
                now = rate * (1 - 0.9 * step / steps)
                for w, g, m, v in zip(self.weights, grads, first, second):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-7)
        return self

    def predict(self, texts: list[str], block: int = 128) -> tuple[np.ndarray, np.ndarray]:
        """(language number, probability) of each text, from all its windows."""
        data, owners = to_windows(texts, self.shape.window, max(self.shape.widths))
        total = np.zeros((len(texts), len(self.languages)))
        for start in range(0, len(data), block):
            p, *_ = self.forward(data[start : start + block])
            np.add.at(total, owners[start : start + block], p)
        total /= total.sum(axis=1, keepdims=True)
        best = total.argmax(axis=1)
        return best, np.clip(total[np.arange(len(best)), best], 0, 1)


def sample(df: DataFrame, text: str, label: str, documents: int, seed: str = "sample") -> list[tuple[str, str]]:
    """About ``documents`` (text, label) of each label, and never over twice as many in all, spread by the texts' hashes."""
    rows = df.select(F.col(text).alias("text"), F.col(label).alias("label")).filter("label IS NOT NULL AND text IS NOT NULL")
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}  # one row a language
    if not counts:
        return []
    share = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, documents / n)))])[F.col("label")]
    order = F.xxhash64("text", F.lit(seed))
    unit = F.pmod(order, F.lit(1 << 20)) / float(1 << 20)
    chosen = rows.filter(unit < share).orderBy(order, "label").limit(2 * documents * len(counts))
    return [(r["text"], r["label"]) for r in chosen.collect()]


def train(
    df: DataFrame, text: str = "text", label: str = "lang", documents: int = 1200, windows: int = 3, shape: Shape = Shape(), seed: int = 7,
) -> Network | None:
    """The network of a bounded sample; None if nothing is labelled. Windows are cut at random places, some of them short."""
    rows = sample(df, text, label, documents)
    languages = sorted({k for _, k in rows})
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    pieces, labels = [], []
    for t, k in rows:
        if not any(map(str.isalpha, t)):
            continue
        for j in range(windows):
            size = shape.window if j == 0 else int(rng.integers(12, shape.window))
            start = int(rng.integers(0, max(1, len(t) - size + 1)))
            pieces.append(t[start : start + size])
            labels.append(languages.index(k))
    if not pieces:
        return None
    data = np.zeros((len(pieces), shape.window), np.uint8)
    for row, piece in zip(data, pieces):
        raw = np.frombuffer(piece.lower().encode("utf-8", "replace")[: shape.window], np.uint8)
        row[: len(raw)] = raw
    return Network(shape, languages).fit(data, np.array(labels))


def predict(df: DataFrame, network: Network | None, text: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """Append the predicted language and its probability."""

    def make():
        def compute(column):
            rows = column.to_pylist()
            known = [i for i, t in enumerate(rows) if network and t and any(map(str.isalpha, t))]
            names, scores = [NO_LANGUAGE] * len(rows), [0.0] * len(rows)
            if known:
                best, p = network.predict([rows[i] for i in known])
                for i, b, q in zip(known, best, p):
                    names[i], scores[i] = network.languages[b], float(q)
            return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

        return compute

    return append_columns(df, [text], [StructField(lang, StringType()), StructField(score, DoubleType())], make)


def held_out(key: Column) -> Column:
    """Documents that are never learned from; a null key is not held out, and not learned from either."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))
