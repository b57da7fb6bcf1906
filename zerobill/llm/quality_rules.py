"""Operator 7: quality rules as gradient-boosted trees over document statistics.

Counts are taken of every whole text. Trees are fitted to ``labels.quality``
on a bounded sample, with monotonic constraints on the statistics that can
only speak against a document, flattened into node arrays and scored for all
documents at once.

Defined cases: a null or empty text has all counts 0 and fails the base rule;
null ids are scored like any other and never learnt from; repeated rows get
equal rows; without labels of both classes the trees are empty and the verdict
is the base rule's; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from zerobill.llm.common import labelled_sample, table, typed
from zerobill.llm.text import hash_words, mix, slices, split_words, utf8

#: Bound of the training sample: labelled documents, and bytes of each.
SAMPLE_ROWS, SAMPLE_BYTES = 4000, 1 << 16
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
SYMBOLS = b"#*$%&|<>"
KEEP = 0.5

FEATURES = ("log_words", "word_length", "symbols", "marks", "upper", "digits", "dup_lines", "repeated", "same_as_last", "distinct")
#: -1: a higher value never raises the score; 0: free.
MONOTONE = (0, 0, -1, -1, -1, 0, -1, -1, -1, 0)


def counts(data: np.ndarray, offsets: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Base counts and the feature matrix of consecutive documents."""
    w = split_words(data, offsets, lower=False)
    h = hash_words(w)
    n_docs, n = len(offsets) - 1, np.diff(w.docs)
    doc = np.repeat(np.arange(n_docs), n)
    classes = _byte_classes()[w.buf]
    edges = w.bounds

    def per_doc(bit: int) -> np.ndarray:
        run = np.concatenate(([0], np.cumsum((classes & bit) != 0)))
        return run[edges[1:]] - run[edges[:-1]]

    chars, symbols, marks, upper, digits = (per_doc(1 << i) for i in range(5))
    repeat = _repeated_words(h, w.docs)
    dup = _duplicate_lines(w, h, doc)
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    total = lambda x: np.bincount(doc[x], minlength=n_docs)
    repeats = total(repeat)
    distinct = np.bincount(doc[np.unique(mix(doc.astype(np.uint64), 41) ^ h, return_index=True)[1]], minlength=n_docs)
    base = {"n_words": n, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup, "n_repeat_words": repeats}
    per, lines = np.maximum(n, 1), np.maximum(_lines(w), 1)
    x = np.stack(
        [np.log1p(n), chars / per, symbols / per, marks / per, upper / np.maximum(chars, 1), digits / np.maximum(chars, 1), dup / lines, repeats / per, total(same) / per, distinct / per],
        axis=1,
    ).astype(np.float32)
    return base, x


_CLASSES: list[np.ndarray] = []


def _byte_classes() -> np.ndarray:
    """Bits of a byte: starts a character of a word, symbol, other mark, upper case, digit."""
    if not _CLASSES:
        c = np.zeros(256, np.uint8)
        start = [b for b in range(256) if (b & 0xC0) != 0x80 and b != 0x20 and not 0x09 <= b <= 0x0D]
        c[start] |= 1
        c[list(SYMBOLS)] |= 2
        c[list(b'!?"\'()[]{}=+/\\^~`@_;:-')] |= 4
        c[65:91] |= 8
        c[48:58] |= 16
        _CLASSES.append(c)
    return _CLASSES[0]


def _repeated_words(h: np.ndarray, docs: np.ndarray, k: int = 3) -> np.ndarray:
    """Marks words in a window of ``k`` words that occurs twice or more in its document."""
    out = np.zeros(len(h), bool)
    if len(h) < k:
        return out
    s = h[: len(h) - k + 1].copy()
    for i in range(1, k):
        s = mix(s, 50 + i) + h[i : len(h) - k + 1 + i]
    for a, b in zip(docs[:-1].tolist(), docs[1:].tolist()):
        if b - a <= k:
            continue
        own = s[a : b - k + 1]
        order = np.argsort(own)
        v = own[order]
        eq = v[1:] == v[:-1]
        if eq.any():
            again = np.zeros(len(v), bool)
            again[1:] |= eq
            again[:-1] |= eq
            at = order[again] + a
            for i in range(k):
                out[at + i] = True
    return out


def _lines(w) -> np.ndarray:
    nl = np.concatenate(([0], np.cumsum(w.buf == 10)))
    return nl[w.bounds[1:]] - nl[w.bounds[:-1]] + 1


def _duplicate_lines(w, h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of their document, white space included."""
    n_docs = len(w.bounds) - 1
    cuts = np.flatnonzero(w.buf == 10)
    inner = np.unique(np.concatenate((w.bounds[:-1], cuts + 1)))
    inner = inner[inner < len(w.buf)]
    if not len(inner) or not len(h):
        return np.zeros(n_docs, np.int64)
    ends = np.concatenate((inner[1:], [len(w.buf)]))
    line_doc = np.searchsorted(w.bounds, inner, "right") - 1
    has_nl = w.buf[ends - 1] == 10
    words_in = np.searchsorted(w.starts, ends) - np.searchsorted(w.starts, inner)
    keep = words_in > 0
    first, last, line_doc = inner[keep], (ends - has_nl)[keep], line_doc[keep]
    raw = w.buf.tobytes()
    out = np.zeros(n_docs, np.int64)
    seen: set[bytes] = set()
    now = -1
    for a, b, d in zip(first.tolist(), last.tolist(), line_doc.tolist()):
        if d != now:
            seen, now = set(), d
        line = raw[a:b]
        if line in seen:
            out[d] += 1
        else:
            seen.add(line)
    return out


class Trees:
    """Boosted trees as node arrays: feature, threshold, left, right, value."""

    def __init__(self, base: float, nodes: list[tuple], roots: list[int], depth: int):
        self.base, self.roots, self.depth = base, np.array(roots, np.int32), depth
        cols = list(zip(*nodes)) if nodes else [[]] * 5
        self.feature, self.left, self.right = (np.array(cols[i], np.int32) for i in (0, 2, 3))
        self.threshold, self.value = (np.array(cols[i], np.float64) for i in (1, 4))

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of quality 1; every tree level is one gather for all rows."""
        z = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root, np.int32)
            for _ in range(self.depth):
                go_left = x[rows, self.feature[at]] <= self.threshold[at]
                at = np.where(go_left, self.left[at], self.right[at])
            z += self.value[at]
        return 1.0 / (1.0 + np.exp(-z))


def fit_trees(
    x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 48, leaf: int = 5, ridge: float = 1.0, monotone: tuple[int, ...] = MONOTONE
) -> Trees:
    """Second-order boosting of the log loss on binned features.

    Leaf values of a constrained split are kept on their side of the parent's
    middle, so the constraint holds for the whole tree, not only locally.
    """
    if not len(y) or y.min() == y.max():
        return Trees(3.0, [], [], 0)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1)
    prior = y.mean()
    base = float(np.log(prior / (1 - prior)))
    z, nodes, roots = np.full(len(y), base), [], []

    def grow(rows: np.ndarray, level: int, lo: float, hi: float) -> int:
        g, hs = grad[rows].sum(), hess[rows].sum()
        value = float(np.clip(-g / (hs + ridge), lo, hi))
        at = len(nodes)
        nodes.append((0, np.inf, at, at, rate * value))
        best = (1e-6, None)
        if level < depth and len(rows) >= 2 * leaf:
            for j, e in enumerate(edges):
                if not len(e):
                    continue
                b = binned[rows, j]
                gs, ws, ns = (np.cumsum(np.bincount(b, v, minlength=len(e) + 1))[:-1] for v in (grad[rows], hess[rows], np.ones(len(rows))))
                gr, wr = g - gs, hs - ws
                left, right = np.clip(-gs / (ws + ridge), lo, hi), np.clip(-gr / (wr + ridge), lo, hi)
                gain = gs**2 / (ws + ridge) + gr**2 / (wr + ridge) - g**2 / (hs + ridge)
                gain[(ns < leaf) | (len(rows) - ns < leaf)] = 0
                if monotone[j]:
                    gain[(right - left) * monotone[j] < 0] = 0
                i = int(np.argmax(gain))
                if gain[i] > best[0]:
                    best = (gain[i], (j, i, left[i], right[i]))
        if best[1]:
            j, i, left, right = best[1]
            go = binned[rows, j] <= i
            mid = (left + right) / 2
            bounds = {0: ((lo, hi), (lo, hi)), 1: ((lo, mid), (mid, hi)), -1: ((mid, hi), (lo, mid))}[monotone[j]]
            a = grow(rows[go], level + 1, *bounds[0])
            b = grow(rows[~go], level + 1, *bounds[1])
            nodes[at] = (j, float(edges[j][i]), a, b, rate * value)
        return at

    for _ in range(trees):
        p = 1 / (1 + np.exp(-z))
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-9)
        roots.append(grow(np.arange(len(y)), 0, -np.inf, np.inf))
        one = Trees(0.0, nodes, roots[-1:], depth)
        at = np.full(len(y), roots[-1], np.int32)
        for _ in range(depth):
            at = np.where(x[np.arange(len(y)), one.feature[at]] <= one.threshold[at], one.left[at], one.right[at])
        z = z + one.value[at]
    return Trees(base, nodes, roots, depth)


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, max_bytes: int = SAMPLE_BYTES) -> Trees:
    sample = labelled_sample(docs, labels, "quality", rows, max_bytes).toArrow()
    data, offsets = utf8(sample.column("text"))
    xs = [counts(data, offsets[i : j + 1])[1] for i, j in slices(offsets)]
    x = np.concatenate(xs) if xs else np.zeros((0, len(FEATURES)), np.float32)
    return fit_trees(x.astype(np.float64), np.array(sample.column("y").to_pylist(), np.float64))


def score_documents(docs: DataFrame, trees: Trees) -> DataFrame:
    """doc_id, the base counts, base_failed, score and kept of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for i, j in slices(offsets):
                base, x = counts(data, offsets[i : j + 1])
                n, repeats = base["n_words"], base["n_repeat_words"]
                failed = (n < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * n)
                score = trees.score(x.astype(np.float64))
                cols = [batch.column("doc_id").slice(i, j - i)]
                cols += [pa.array(v.astype(np.int64)) for v in base.values()]
                cols += [pa.array(failed), pa.array(~failed & (score >= KEEP)), pa.array(score)]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", *base, "base_failed", "kept", "score"])

    schema = "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean, score double"
    return typed(docs, "doc_id", "text").mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, train(docs, table(spark, sf_dir, "labels")))
