"""Operator 4: toxicity by the nearest labelled examples under TF-IDF cosine.

A bounded sample of labelled rows gives the examples. The vector space has
every word; document frequencies are of all documents. A word's weight is
damped, never to zero, by how far its presence goes with the label in the
sample (log-likelihood ratio), so that the many words without bearing on the
label do not drown those with. A word that no example holds is part of a
document's norm with the weight of a word that no document holds and that goes
with neither label, so a text that shares one word with the examples and
nothing else is far from all of them. Examples are kept in posting
lists with the largest weight of each word in each block of examples; words
that many examples hold have a list with a place for every example, multiplied
as a matrix. The K-th best sum of these words alone is the least that the K-th
best similarity can be; a document opens every block whose bound reaches it, so
the K nearest are exact. Votes are weighted by similarity and calibrated by
isotonic regression on the examples' own leave-one-out votes, which tasks
cast; the driver holds the postings and one number an example.

Words are lower-cased (A-Z) and have ASCII marks at either end taken off.

Defined cases: null or empty texts, and texts without a word of the examples,
have no neighbour and get the share of label 1 among such examples (smoothed);
null ids are scored and never learnt from; repeated rows get equal scores;
equal similarities at the K-th place go to the example met first in block
order; without labels of both classes every score is the share of label 1, or
0 without labels; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zerobill.llm.common import Shared, held_out, labelled_sample, table, typed
from zerobill.llm.text import bare_hashes, slices, split_words, utf8

SAMPLE_ROWS, SAMPLE_BYTES = 8000, 1 << 16
THRESHOLD = 0.3
NEIGHBOURS = 15
#: Log-likelihood ratio at which a word has about half of its full weight (chi-square of one degree, p about 1e-6).
HALF_RATIO = 24.0
BLOCK = 64
#: Words held by one in so many examples have a list with a place for every example.
COMMON = 48
#: Queries multiplied with the full lists together: each product reads these lists whole.
QUERIES = 1024
#: Of these, queries whose other postings are added together.
TOGETHER = 64


class Places:
    """Positions of hashes among ``terms``, ascending hashes, which their leading bits nearly tell."""

    def __init__(self, terms: np.ndarray):
        bits = max(1, len(terms).bit_length())
        self.terms, self.shift = terms, np.uint64(64 - bits)
        sizes = np.bincount((terms >> self.shift).astype(np.int64), minlength=1 << bits)
        self.starts = np.concatenate(([0], np.cumsum(sizes)))

    def find(self, h: np.ndarray) -> np.ndarray:
        """-1 for a hash that is not among the terms."""
        found = np.full(len(h), -1, np.int64)
        lead = (h >> self.shift).astype(np.int64)
        at, end = self.starts[lead], self.starts[lead + 1]
        go = np.flatnonzero(at < end)
        at, end, h = at[go], end[go], h[go]
        while len(go):
            hit = self.terms[at] == h
            found[go[hit]] = at[hit]
            at += 1
            more = ~hit & (at < end)
            go, at, end, h = go[more], at[more], end[more], h[more]
        return found


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of every word."""
    w = split_words(data, offsets, lower=True)
    return np.repeat(np.arange(len(offsets) - 1), np.diff(w.docs)), bare_hashes(w)


def _counted(doc: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, position, count) of words at positions below ``size``."""
    key, count = np.unique(doc * max(1, size) + at, return_counts=True)
    return key // max(1, size), key % max(1, size), count


def _doc_terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, hash of a word, count)."""
    doc, h = _words(data, offsets)
    words, at = np.unique(h, return_inverse=True)
    doc, at, count = _counted(doc, at, len(words))
    return doc, words[at], count


class Vectors(NamedTuple):
    """Rows of length one (or empty), by their words' positions."""

    ends: np.ndarray  # of the rows, one more than rows
    term: np.ndarray
    weight: np.ndarray
    width: int

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ends) - 1), np.diff(self.ends))

    def take(self, rows: np.ndarray) -> Vectors:
        size = np.diff(self.ends)[rows]
        at = _ranges(self.ends[rows], size)
        return Vectors(np.concatenate(([0], np.cumsum(size))), self.term[at], self.weight[at], self.width)

    def dense(self) -> np.ndarray:
        out = np.zeros((len(self.ends) - 1, self.width), np.float32)
        out[self.row, self.term] = self.weight
        return out

    @classmethod
    def of(cls, x: np.ndarray) -> Vectors:
        row, term = np.nonzero(x)
        return cls(np.searchsorted(row, np.arange(len(x) + 1)), term, x[row, term].astype(np.float32), x.shape[1])


def _unknown(doc: np.ndarray, h: np.ndarray, n_docs: int) -> np.ndarray:
    """For each document the sum of (1 + ln count) ** 2 over its distinct words; ``h`` has the hash of each."""
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    first = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])))) if len(h) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(h)))
    return np.bincount(doc[first], (1 + np.log(np.maximum(count, 1))) ** 2, minlength=n_docs)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, one range behind the other."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes - starts, sizes)


def _vectors(doc: np.ndarray, term: np.ndarray, count: np.ndarray, n_docs: int, weights: np.ndarray, others: np.ndarray | float = 0.0) -> Vectors:
    """``doc`` ascends; ``others`` is the part of each squared norm that other words have."""
    w = (1 + np.log(count)) * weights[term]
    norm = np.sqrt(np.bincount(doc, w**2, minlength=n_docs) + others)
    return Vectors(np.searchsorted(doc, np.arange(n_docs + 1)), term, (w / norm[doc]).astype(np.float32), len(weights))


def label_weights(doc: np.ndarray, at: np.ndarray, y: np.ndarray, n_words: int) -> np.ndarray:
    """A factor above 0 and below 1 for every word, by how far its presence depends on the label."""
    n1, n = y.sum(), len(y)
    with1 = np.bincount(at, y[doc], minlength=n_words)
    has = np.bincount(at, minlength=n_words).astype(np.float64)

    def part(x: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(x > 0, x * np.log(np.maximum(x, 1e-12) / np.maximum(expected, 1e-12)), 0.0)

    ratio = 2 * (
        part(with1, has * n1 / n) + part(has - with1, has * (n - n1) / n) + part(n1 - with1, (n - has) * n1 / n) + part(n - n1 - has + with1, (n - has) * (n - n1) / n)
    )
    ratio = np.maximum(ratio, 0) + 1
    return ratio / (ratio + HALF_RATIO)


class Lists(NamedTuple):
    """Posting lists as a search reads them."""

    place: np.ndarray  # of a word among those with a place for every example, or -1
    full: np.ndarray  # these words by examples
    example: np.ndarray  # the other postings, word by word
    weight: np.ndarray
    starts: np.ndarray  # of the entries of a word and block, one more than entries
    block_of: np.ndarray
    maxima: np.ndarray
    first: np.ndarray  # entry of each word, one more than words


class BlockMaxIndex:
    """Posting lists over examples in blocks of like ones, and each word's largest weight in a block."""

    def __init__(self, vectors: Vectors | np.ndarray, y: np.ndarray, ids: np.ndarray):
        v = Vectors.of(vectors) if isinstance(vectors, np.ndarray) else vectors
        some = np.flatnonzero(np.diff(v.ends) > 0)
        # like examples together: by label, then by their heaviest words
        order = np.lexsort((-v.weight, v.row))
        first, second = (v.term[order[np.minimum(v.ends[some] + k, v.ends[some + 1] - 1)]] for k in (0, 1))
        some = some[np.lexsort((second, first, y[some]))]
        examples, self.y, self.ids, self.rows = v.take(some), y[some], ids[some], some
        order = np.argsort(examples.term, kind="stable")  # by word, then by example
        self.size = np.bincount(examples.term, minlength=v.width).astype(np.int32)
        self.example_of = examples.row[order].astype(np.min_scalar_type(max(1, len(some))))
        self.weight_of = examples.weight[order]

    @property
    def blocks(self) -> int:
        return -(-len(self.y) // BLOCK)

    @cached_property
    def examples(self) -> Vectors:
        """The examples' vectors again, from the postings."""
        order = np.argsort(self.example_of, kind="stable")
        ends = np.searchsorted(self.example_of[order], np.arange(len(self.y) + 1))
        return Vectors(ends, np.repeat(np.arange(len(self.size)), self.size)[order], self.weight_of[order], len(self.size))

    @cached_property
    def lists(self) -> Lists:
        """Block entries and full lists, made where a search first needs them: in the tasks."""
        n, size, example, weight = len(self.y), self.size, self.example_of.astype(np.int64), self.weight_of
        term = np.repeat(np.arange(len(size)), size)
        common = np.flatnonzero(size * COMMON >= max(1, n))
        place = np.full(len(size), -1, np.int32)
        place[common] = np.arange(len(common))
        in_full = place[term] >= 0
        full = np.zeros((len(common), n), np.float32)
        full[place[term[in_full]], example[in_full]] = weight[in_full]
        term, example, weight = term[~in_full], example[~in_full].astype(np.int32), weight[~in_full]
        # one entry for each word and block: where its postings start, and the largest of them
        block = example // BLOCK
        starts = np.flatnonzero(np.concatenate(([True], (term[1:] != term[:-1]) | (block[1:] != block[:-1])))) if len(term) else np.zeros(0, np.int64)
        maxima = np.maximum.reduceat(weight, starts) if len(term) else weight
        first = np.searchsorted(term[starts], np.arange(len(size) + 1)).astype(np.int32)
        return Lists(place, full, example, weight, np.append(starts, len(term)).astype(np.int32), block[starts], maxima, first)

    def __getstate__(self) -> dict:
        """What is shared with the tasks: the postings alone, from which they build the rest."""
        return {k: v for k, v in self.__dict__.items() if k not in ("lists", "examples")}

    @property
    def vectors(self) -> np.ndarray:
        return self.examples.dense()

    def nearest(self, queries: Vectors | np.ndarray, k: int, skip: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(similarities, positions) of the ``k`` nearest examples, best first; -1 where there are fewer.

        ``skip`` names for each query an example position to leave out.
        """
        q = Vectors.of(queries) if isinstance(queries, np.ndarray) else queries
        n = len(q.ends) - 1
        best, which = np.full((n, k), -1.0, np.float32), np.full((n, k), -1, np.int64)
        if self.blocks:
            for i in range(0, n, QUERIES):
                sim = self._common(q.take(np.arange(i, min(n, i + QUERIES))))
                for j in range(i, i + len(sim), TOGETHER):
                    rows = np.arange(j, min(i + len(sim), j + TOGETHER))
                    best[rows], which[rows] = self._nearest(q.take(rows), sim[rows - i], k, None if skip is None else skip[rows])
        return best, which

    def _common(self, q: Vectors) -> np.ndarray:
        """Queries by examples: the similarities of the common words."""
        own, row = self.lists, q.row
        common = own.place[q.term]
        full = common >= 0
        dense = np.zeros((len(q.ends) - 1, len(own.full)), np.float32)
        dense[row[full], common[full]] = q.weight[full]
        return dense @ own.full

    def _nearest(self, q: Vectors, sim: np.ndarray, k: int, skip: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """``sim`` has the common words; the others are added where a block is opened."""
        m, n, row = len(q.ends) - 1, len(self.y), q.row
        own = self.lists
        other = own.place[q.term] < 0
        term, row, weight = q.term[other], row[other], q.weight[other].astype(np.float64)
        size = own.first[term + 1] - own.first[term]
        entry = _ranges(own.first[term], size)
        row, weight = np.repeat(row, size), np.repeat(weight, size)
        cell = row * self.blocks + own.block_of[entry]
        if skip is not None:
            out = np.flatnonzero(skip >= 0)
            sim[out, skip[out]] = -1
        at = max(0, n - k)
        least = np.partition(sim, at, axis=1)[:, at] if n >= k else np.zeros(m, np.float32)
        rest = np.bincount(cell, weight * own.maxima[entry], minlength=m * self.blocks).reshape(m, -1)
        opened = np.maximum.reduceat(sim, np.arange(0, n, BLOCK), axis=1) + rest > np.maximum(least, 0)[:, None] - 1e-6
        on = np.flatnonzero(opened.ravel()[cell])
        first = own.starts[entry[on]]
        size = own.starts[entry[on] + 1] - first
        post = _ranges(first, size)
        sim += np.bincount(np.repeat(row[on] * n, size) + own.example[post], np.repeat(weight[on], size) * own.weight[post], minlength=m * n).reshape(m, n)
        if skip is not None:
            sim[out, skip[out]] = -1
        least = np.partition(sim, at, axis=1)[:, at]
        row, example = np.nonzero((sim >= least[:, None]) & (sim > 0))
        order = np.lexsort((example, -sim[row, example], row))
        row, example = row[order], example[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        row, example, place = (x[place < k] for x in (row, example, place))
        best, which = np.full((m, k), -1.0, np.float32), np.full((m, k), -1, np.int64)
        best[row, place], which[row, place] = sim[row, example], example
        return best, which


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pooled-adjacent-violators fit as knots for interpolation."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []
    for a, b in zip(x[order].tolist(), y[order].tolist()):
        blocks.append([b, 1.0, a])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            s, n, at = blocks.pop()
            t, m, at0 = blocks[-1]
            blocks[-1] = [s + t, n + m, (at * n + at0 * m) / (n + m)]
    return np.array([b[2] for b in blocks]), np.array([(b[0] + 0.1) / (b[1] + 0.5) if b[0] < b[1] else b[0] / b[1] for b in blocks])


class NearestExamples:
    """Everything a task needs: terms, their weights, the weight of any other word, index."""

    def __init__(self, terms: np.ndarray, weights: np.ndarray, other: float, vectors: Vectors, y: np.ndarray, ids: np.ndarray):
        self.terms, self.weights, self.other = terms, weights, other
        self.prior = float(y.mean()) if len(y) else 0.0
        self.index = BlockMaxIndex(vectors, y, ids)
        empty = np.ones(len(y), bool)
        empty[self.index.rows] = False
        self.silent = (y[empty].sum() + self.prior) / (empty.sum() + 1)

    @cached_property
    def places(self) -> Places:
        return Places(self.terms)

    def votes(self, queries: Vectors, skip: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sim, at = self.index.nearest(queries, NEIGHBOURS, skip)
        weight = np.where(at >= 0, np.maximum(sim, 0) ** 2, 0)
        y = self.index.y[np.maximum(at, 0)] if len(self.index.y) else np.zeros(at.shape)
        return ((weight * y).sum(axis=1) + 0.05 * self.prior) / (weight.sum(axis=1) + 0.05), sim, at

    def left_out(self, own: np.ndarray) -> np.ndarray:
        """The votes of examples that may not vote for themselves."""
        return self.votes(self.index.examples.take(own), own)[0]

    def score(self, data: np.ndarray, offsets: np.ndarray, knots: tuple[np.ndarray, np.ndarray] | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(score, similarity of the nearest example or null, its id or null)."""
        n = len(offsets) - 1
        doc, h = _words(data, offsets)
        at = self.places.find(h)
        new = at < 0
        others = self.other**2 * _unknown(doc[new], h[new], n)
        doc, term, count = _counted(doc[~new], at[~new], len(self.terms))
        score, sim, near = np.full(n, self.silent), np.full(n, np.nan), np.full(n, -1, np.int64)
        rows = np.unique(doc)
        if len(rows) and knots is not None:
            q = _vectors(np.searchsorted(rows, doc), term, count, len(rows), self.weights, others[rows])
            raw, s, at = self.votes(q)
            score[rows] = np.interp(raw, *knots)
            sim[rows] = np.where(at[:, 0] >= 0, s[:, 0], np.nan)
            near[rows] = at[:, 0]
        return score, sim, near


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, max_bytes: int = SAMPLE_BYTES) -> Calibrated:
    sample = labelled_sample(docs, labels, "toxic", rows, max_bytes).toArrow()
    y = np.array(sample.column("y").to_pylist(), np.float64)
    ids = np.array(sample.column("doc_id").to_pylist(), np.int64)
    data, offsets = utf8(sample.column("text"))
    parts = []
    for i, j in slices(offsets):
        doc, word, count = _doc_terms(data, offsets[i : j + 1])
        parts.append((doc + i, word, count))
    doc, word, count = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))
    if not (len(y) and y.min() < y.max()):
        doc, word, count = doc[:0], word[:0], count[:0]
    del sample, data, parts
    terms, at = np.unique(word, return_inverse=True)
    total, df = document_frequencies(docs, terms)
    weights = np.log((1 + total) / (1 + df)) + 1
    if len(terms):
        weights *= label_weights(doc, at, y, len(terms))
    # as a word that no document holds, whose presence says nothing
    other = (float(np.log(1 + total)) + 1) / (1 + HALF_RATIO)
    model = NearestExamples(terms, weights, other, _vectors(doc, at, count, len(y), weights), y, ids)
    return Calibrated(spark, model)


class Calibrated:
    """A model shared with the tasks and its calibration.

    The leave-one-out votes are cast in tasks, a slice of the examples each;
    one number an example comes back.
    """

    def __init__(self, spark: SparkSession, model: NearestExamples, slice_rows: int = 512):
        self.shared = shared = Shared(spark, model)  # the words of at most SAMPLE_ROWS examples of SAMPLE_BYTES
        self.terms, y = model.terms, model.index.y
        self.knots: tuple[np.ndarray, np.ndarray] | None = None

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own = batch.column("id").to_numpy()
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(shared.value.left_out(own), pa.float64())], ["id", "vote"])

        if len(y):
            votes = spark.range(0, len(y), 1, -(-len(y) // slice_rows)).mapInArrow(run, "id bigint, vote double").toArrow()
            raw = np.empty(len(y))
            raw[votes.column("id").to_numpy()] = votes.column("vote").to_numpy()
            self.knots = isotonic(raw, y)


def document_frequencies(docs: DataFrame, terms: np.ndarray) -> tuple[int, np.ndarray]:
    """Number of documents, and of those that hold each term; a row for each task and term moves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, found, total = Places(terms), np.zeros(len(terms) + 1, np.int64), 0
        for batch in batches:
            total += batch.num_rows
            data, offsets = utf8(batch.column("text"))
            for i, j in slices(offsets):
                doc, h = _words(data, offsets[i : j + 1])
                at = places.find(h)
                found += np.bincount(_counted(doc[at >= 0], at[at >= 0], len(terms))[1], minlength=len(terms) + 1)
        found[-1] = total
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(found[some])], ["term", "n"])

    counted = typed(docs, "text").mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(len(terms) + 1, np.int64)
    out[counted.column("term").to_numpy()] = counted.column("n").to_numpy()
    return int(out[-1]), out[:-1]


def score_documents(spark: SparkSession, docs: DataFrame, model: Calibrated) -> DataFrame:
    """doc_id, held_out, score, predicted, and the nearest example as evidence."""
    shared, knots = model.shared, model.knots

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for i, j in slices(offsets):
                score, sim, near = m.score(data, offsets[i : j + 1], knots)
                ids = m.index.ids[np.maximum(near, 0)] if len(m.index.ids) else near
                cols = [batch.column(c).slice(i, j - i) for c in ("doc_id", "held_out")]
                cols += [pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32)), pa.array(sim, mask=np.isnan(sim)), pa.array(ids, mask=near < 0)]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "held_out", "score", "predicted", "nearest_similarity", "nearest_id"])

    rows = typed(docs, "doc_id", "text").withColumn("held_out", held_out(F.col("doc_id")))
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int, nearest_similarity double, nearest_id bigint")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_documents(spark, docs, fit(spark, docs, table(spark, sf_dir, "labels")))
