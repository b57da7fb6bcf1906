"""Operator 1: quality by a byte-level convolutional network in numpy.

Bytes get learned vectors; learned filters of ``WIDTH`` bytes slide over the
whole document. Chunks of two blocks, each overlapping the next by one block,
average the filters' responses, and beside them the responses of equality
filters, which fire where a byte equals the one ``lag`` bytes before (words or
lines said again). A second layer of learned filters reads each chunk, its
units are max-pooled over all chunks and combined into one probability.

Fitted on a bounded sample of labelled rows (``SAMPLE_ROWS`` documents of up to
``SAMPLE_BYTES`` bytes); every byte of every document is scored.

Defined cases: a null or empty text is one empty chunk and gets the score of
silence; null ids are scored and never learnt from; repeated rows get equal
scores; without labels of both classes every score is the share of label 1, or
0.5 without labels; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zerobill.llm.common import fresh_task, held_out, labelled_sample, table, typed
from zerobill.llm.text import slices, utf8

SAMPLE_ROWS, SAMPLE_BYTES = 2500, 1 << 15
THRESHOLD = 0.7
BLOCK, WIDTH, STRIDE = 128, 8, 4
VECTOR, FILTERS, UNITS = 6, 24, 16
LAGS = tuple(range(2, 26))


class Chunks:
    """Padded bytes of consecutive documents with their blocks and chunks."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        lens = np.diff(offsets)
        blocks = (lens + WIDTH - 1) // BLOCK + 1
        first = np.cumsum(blocks) - blocks
        self.bytes = np.zeros(int(blocks.sum()) * BLOCK + WIDTH, np.uint8)
        for a, b, to in zip(offsets[:-1].tolist(), offsets[1:].tolist(), (first * BLOCK).tolist()):
            self.bytes[to : to + b - a] = data[a:b]
        at = np.arange(int(blocks.sum())) - np.repeat(first, blocks)
        #: bytes of the document in each block
        self.filled = np.clip(np.repeat(lens, blocks) - at * BLOCK, 0, BLOCK)
        per = np.maximum(blocks - 1, 1)
        self.first = np.cumsum(per) - per  # first chunk of each document
        step = np.arange(int(per.sum())) - np.repeat(self.first, per)
        self.left = np.repeat(first, per) + step
        # a chunk that begins in a document's last block is that block alone
        self.right = np.minimum(self.left + 1, np.repeat(first + blocks - 1, per))
        self.alone = (self.left == self.right).astype(np.float32)[:, None]

    def chunk_mean(self, block_sums: np.ndarray, block_counts: np.ndarray) -> np.ndarray:
        other = 1 - self.alone
        total = block_sums[self.left] + other * block_sums[self.right]
        return total / np.maximum(block_counts[self.left, None] + other * block_counts[self.right, None], 1)

    def repeats(self) -> np.ndarray:
        """Chunk means of the equality filters."""
        x = self.bytes[: len(self.filled) * BLOCK]
        out = np.zeros((len(self.filled), len(LAGS)), np.float32)
        real = x != 0
        for k, lag in enumerate(LAGS):
            same = np.zeros(len(x), bool)
            np.equal(x[lag:], x[:-lag], out=same[lag:])
            same &= real
            out[:, k] = same.reshape(-1, BLOCK).sum(axis=1)
        return self.chunk_mean(out, self.filled)


class Network:
    NAMES = ("vectors", "w", "b", "units", "unit_bias", "out")

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        wide = WIDTH * VECTOR
        self.vectors = rng.normal(0, 0.5, (256, VECTOR)).astype(np.float32)
        self.vectors[0] = 0
        self.w = rng.normal(0, wide**-0.5, (wide, FILTERS)).astype(np.float32)
        self.b = np.zeros(FILTERS, np.float32)
        self.units = rng.normal(0, 0.3, (FILTERS + len(LAGS), UNITS)).astype(np.float32)
        self.unit_bias = np.zeros(UNITS, np.float32)
        self.out = np.concatenate((rng.normal(0, 0.3, UNITS), [0])).astype(np.float32)
        self.scale = np.ones(FILTERS + len(LAGS), np.float32)
        self.shift = np.zeros(FILTERS + len(LAGS), np.float32)
        self.constant: float | None = None

    def _conv(self, groups: np.ndarray) -> np.ndarray:
        """Filter responses at every stride; ``groups`` are STRIDE bytes each."""
        half = STRIDE * VECTOR
        x = self.vectors[groups].reshape(*groups.shape[:-1], half)
        return x[..., :-1, :] @ self.w[:half] + x[..., 1:, :] @ self.w[half:] + self.b

    def features(self, c: Chunks) -> np.ndarray:
        n = len(c.filled)
        response = np.maximum(self._conv(c.bytes[: n * BLOCK + STRIDE].reshape(-1, STRIDE)), 0)
        per = BLOCK // STRIDE
        windows = -(-c.filled // STRIDE)
        response.reshape(n, per, FILTERS)[np.arange(per) >= windows[:, None]] = 0
        mean = c.chunk_mean(response.reshape(n, per, FILTERS).sum(axis=1), windows)
        return np.concatenate((mean, c.repeats()), axis=1)

    def pooled(self, c: Chunks, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        units = np.tanh((z * self.scale + self.shift) @ self.units + self.unit_bias)
        return units, np.maximum.reduceat(units, c.first, axis=0)

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(offsets) - 1, self.constant)
        c = Chunks(data, offsets)
        top = self.pooled(c, self.features(c))[1]
        return 1 / (1 + np.exp(-(top @ self.out[:-1] + self.out[-1]).astype(np.float64)))


def train(texts: pa.ChunkedArray, y: np.ndarray, epochs: int = 8, batch: int = 50, rate: float = 0.01, seed: int = 7) -> Network:
    """Adam on the log loss. The gradient of a max-pooled unit reaches one
    chunk of a document, so only chunks that won are gone back through."""
    net = Network(seed)
    if not len(y) or y.min() == y.max():
        net.constant = float(y.mean()) if len(y) else 0.5
        return net
    data, offsets = utf8(texts)
    rng = np.random.default_rng(seed)
    some = np.sort(rng.permutation(len(y))[:400])
    c = Chunks(*_pick(data, offsets, some))
    z = net.features(c)
    net.scale = (1 / (z.std(axis=0) + 1e-3)).astype(np.float32)
    net.shift = (-z.mean(axis=0) * net.scale).astype(np.float32)
    net.out[-1] = np.log(y.mean() / (1 - y.mean()))
    moments = {n: [np.zeros_like(getattr(net, n)), np.zeros_like(getattr(net, n))] for n in net.NAMES}
    t, steps = 0, epochs * -(-len(y) // batch)
    half = STRIDE * VECTOR
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for k in range(0, len(y), batch):
            rows = np.sort(order[k : k + batch])
            c = Chunks(*_pick(data, offsets, rows))
            z = net.features(c)
            units, top = net.pooled(c, z)
            p = 1 / (1 + np.exp(-(top @ net.out[:-1] + net.out[-1])))
            d = ((p - y[rows]) / len(rows)).astype(np.float32)
            g = {"out": np.concatenate((top.T @ d, [d.sum()]))}
            # the winning chunk of each document and unit
            ends = np.append(c.first[1:], len(units))
            won = np.stack([units[a:b].argmax(axis=0) + a for a, b in zip(c.first, ends)])
            back = np.zeros_like(units)
            back[won, np.arange(UNITS)] = d[:, None] * net.out[:-1] * (1 - top**2)
            used = np.unique(won)
            back, zu = back[used], z[used] * net.scale + net.shift
            g["units"], g["unit_bias"] = zu.T @ back, back.sum(axis=0)
            dz = (back @ net.units.T * net.scale)[:, :FILTERS]
            # through the filters, on the bytes of these chunks
            per = 2 * BLOCK // STRIDE
            groups = np.lib.stride_tricks.sliding_window_view(np.append(c.bytes, np.zeros(2 * BLOCK, np.uint8)), 2 * BLOCK + STRIDE)[c.left[used] * BLOCK].reshape(len(used), per + 1, STRIDE)
            windows = -(-c.filled // STRIDE)
            live = np.concatenate([np.arange(per // 2) < windows[b][:, None] for b in (c.left[used], c.right[used])], axis=1)
            live[:, per // 2 :] &= c.alone[used] == 0
            h = net._conv(groups)
            dh = (dz / np.maximum(live.sum(axis=1, keepdims=True), 1))[:, None, :] * live[..., None] * (h > 0)
            dh = dh.astype(np.float32)
            x = net.vectors[groups].reshape(len(used), per + 1, half)
            flat = dh.reshape(-1, FILTERS)
            g["w"] = np.concatenate((x[:, :-1].reshape(-1, half).T @ flat, x[:, 1:].reshape(-1, half).T @ flat))
            g["b"] = flat.sum(axis=0)
            dx = np.zeros_like(x)
            dx[:, :-1] += dh @ net.w[:half].T
            dx[:, 1:] += dh @ net.w[half:].T
            dx = dx.reshape(-1, VECTOR)
            g["vectors"] = np.stack([np.bincount(groups.ravel(), dx[:, j], minlength=256) for j in range(VECTOR)], axis=1)
            g["vectors"][0] = 0
            t += 1
            now = rate * min(1.0, 2 * (1 - (t - 1) / steps))
            for n in net.NAMES:
                m, v = moments[n]
                grad = g[n].astype(np.float32)
                m += 0.1 * (grad - m)
                v += 0.01 * (grad**2 - v)
                setattr(net, n, (getattr(net, n) - now * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-6)).astype(np.float32))
    return net


def _pick(data: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    parts = [data[offsets[i] : offsets[i + 1]] for i in rows]
    return np.concatenate(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts])))


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, max_bytes: int = SAMPLE_BYTES) -> Network:
    sample = labelled_sample(docs, labels, "quality", rows, max_bytes).toArrow()
    return train(sample.column("text"), np.array(sample.column("y").to_pylist(), np.float64))


def _scores(net: Network, batch: pa.RecordBatch) -> np.ndarray:
    data, offsets = utf8(batch.column("text"))
    parts = [net.score(data, offsets[i : j + 1]) for i, j in slices(offsets, 1 << 19)]
    return np.concatenate(parts) if parts else np.zeros(0)


def score_documents(docs: DataFrame, net: Network) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh_task()
        for batch in batches:
            score = _scores(net, batch)
            cols = [batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "held_out", "score", "predicted"])

    rows = typed(docs, "doc_id", "text").withColumn("held_out", held_out(F.col("doc_id")))
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, net: Network, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``, columns unchanged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh_task()
        for batch in batches:
            yield batch.filter(pa.array(_scores(net, batch) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, fit(docs, table(spark, sf_dir, "labels")))
