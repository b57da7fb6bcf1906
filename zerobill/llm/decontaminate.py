"""Operator 2: benchmark decontamination by BM25 retrieval and verification.

The test items are indexed by words with BM25 weights, in blocks of items with
the largest weight of each word in a block. Every document is cut into
overlapping passages, and every passage is a query (block-max WAND). For each
item the rarest words are set apart until the others cannot reach
``ESSENTIAL`` of its threshold; the block maxima of these words bound, for all
passages of a slice at once, what a passage can reach in a block, and only
blocks whose bound allows an item's threshold are opened. In an open block the
items are walked from pivot to pivot and all that reach ``THRESHOLD`` of their
own score are retrieved. A retrieved
item contaminates the document if the passage holds enough of the question's
and of the answer's word n-grams.

A test item's question is its text up to its last sentence, the answer is that
sentence; where there is only one, its last third of words is the answer.

Words are runs of anything but ASCII white space, lower-cased (A-Z) and with
ASCII marks at either end taken off.

Only the index is shared with the tasks, four indexes at a time, each of at
most about ``SLICE_ITEMS`` items of like length; each group is one pass over
the documents, staged before the next; document frequencies are of all items.

Defined cases: null or empty texts and items without words match nothing; a
null id, of a document or an item, is carried as null; items with equal texts are all reported; repeated
rows are reported for each row; empty tables give no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zerobill.llm.common import Shared, fresh_task, release, staged, table, typed
from zerobill.llm.text import bare_hashes, mix, slices, split_words, utf8

K1, B = 1.2, 0.75
#: Share of an item's own score that a passage must reach.
THRESHOLD = 0.5
#: Shares of the question's and answer's n-grams that must stand in the passage.
QUESTION_OVERLAP, ANSWER_OVERLAP, GRAM = 0.5, 0.5, 3
#: Share of all the item's n-grams that tells a passage whatever its answer's.
WHOLE_OVERLAP = 0.8
#: Least share of an item's words that its last sentences must have to be the answer.
ANSWER_WORDS = 0.25
#: Share of an item's threshold that its common words may reach together.
ESSENTIAL = 0.5
BLOCK_ITEMS, SLICE_ITEMS = 4, 4096


def _text_hashes(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    return bare_hashes(split_words(raw, np.array([0, len(raw)], np.int64), lower=True))


def grams(h: np.ndarray, k: int) -> np.ndarray:
    s = h[: max(0, len(h) - k + 1)].copy()
    for i in range(1, k):
        s = mix(s, 80 + i) + h[i : len(h) - k + 1 + i]
    return np.unique(s)


def question_and_answer(text: str) -> tuple[str, str]:
    """The last sentences with at least ``ANSWER_WORDS`` of the words are the
    answer; where that takes all of them, the last third of the words is."""
    text = text.strip()
    words = text.split()
    for cut in reversed([m.end() for m in re.finditer(r"(?<=[.?!])\s+", text)]):
        if len(text[cut:].split()) >= ANSWER_WORDS * len(words):
            return text[:cut], text[cut:]
    cut = len(words) - max(1, len(words) // 3)
    return " ".join(words[:cut]), " ".join(words[cut:])


class Index:
    """Postings of a slice of items, with block maxima."""

    def __init__(self, items: list[tuple[int, str]], df: dict[int, int], n_items: int, mean_len: float):
        self.ids = [i for i, _ in items]
        words = [_text_hashes(t) for _, t in items]
        self.lens = np.array([len(w) for w in words], np.int64)
        self.terms = np.unique(np.concatenate(words)) if words else np.zeros(0, np.uint64)
        self.blocks = -(-len(items) // BLOCK_ITEMS)
        self.lists: dict[tuple[int, int], list[tuple[int, float]]] = {}  # postings of a word in a block, by item
        own, least = [], np.full(self.blocks, np.inf)
        self.block_need = np.full(self.blocks, np.inf)
        maxima: dict[tuple[int, int], float] = {}
        for i, w in enumerate(words):
            block, found = i // BLOCK_ITEMS, []
            for h, tf in Counter(w.tolist()).items():
                t = int(np.searchsorted(self.terms, np.uint64(h)))
                idf = float(np.log(1 + (n_items - df[h] + 0.5) / (df[h] + 0.5)))
                weight = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(w) / mean_len))
                self.lists.setdefault((t, block), []).append((i, weight))
                found.append((weight, t))
            total = sum(x for x, _ in found)
            own.append(total)
            need, rest = total * THRESHOLD, total
            for weight, t in sorted(found, reverse=True):
                if rest <= need * ESSENTIAL:
                    break
                rest -= weight
                maxima[t, block] = max(maxima.get((t, block), 0.0), weight)
            self.block_need[block] = min(self.block_need[block], need)
            least[block] = min(least[block], need - rest)
        self.need, self.block_least = np.array(own) * THRESHOLD, least
        keys = sorted(maxima)
        self.first = np.searchsorted(np.array([t for t, _ in keys], np.int64), np.arange(len(self.terms) + 2))
        self.block_of = np.array([b for _, b in keys], np.int64)
        self.block_max = np.array([maxima[k] for k in keys])
        self.grams = []
        for _, text in items:
            q, a = question_and_answer(text)
            halves = [_text_hashes(t) for t in (q, a)]
            self.grams.append([(k, grams(h, k)) for h in halves for k in [max(1, min(GRAM, len(h)))]])
        #: A passage is twice the longest item, and every item lies whole in one of two overlapping passages.
        self.half = max(16, int(self.lens.max(initial=0)))

    def lookup(self, h: np.ndarray) -> np.ndarray:
        if not len(self.terms):
            return np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.terms, h), len(self.terms) - 1)
        return np.where(self.terms[at] == h, at, len(self.terms))

    def open_blocks(self, terms: np.ndarray, docs: np.ndarray, passages: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(passage, block) where the maxima of the passage's essential words can
        reach an item's threshold; ``passages`` has each document's first passage."""
        at = np.flatnonzero(np.diff(self.first)[terms] > 0)
        doc = np.searchsorted(docs, at, "right") - 1
        step = (at - docs[doc]) // self.half
        here = np.concatenate((passages[doc] + step, passages[doc] + step - 1))
        ok = np.concatenate((passages[doc] + step < passages[doc + 1], step > 0))
        n = len(self.terms) + 1
        each = np.unique((here * n + np.concatenate((terms[at], terms[at])))[ok])
        passage, term = each // n, each % n
        count = self.first[term + 1] - self.first[term]
        posting = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - self.first[term], count)
        key, which = np.unique(np.repeat(passage, count) * self.blocks + self.block_of[posting], return_inverse=True)
        bound = np.bincount(which, self.block_max[posting], minlength=len(key))
        key = key[bound >= self.block_least[key % self.blocks] - 1e-6]
        return key // self.blocks, key % self.blocks

    def wand(self, terms: list[int], block: int) -> list[tuple[int, float]]:
        """Items of an open block that reach their threshold, with their scores.

        ``terms`` are the passage's distinct words. Posting lists are walked
        by item; the pivot is the first item at which the maxima of the lists
        up to there can reach the block's least threshold.
        """
        lists = [[own, 0, max(w for _, w in own)] for t in terms if (own := self.lists.get((t, block)))]
        found = []
        while lists:
            lists.sort(key=lambda x: x[0][x[1]][0])
            upper, pivot = 0.0, None
            for x in lists:
                upper += x[2]
                if upper >= self.block_need[block] - 1e-9:
                    pivot = x[0][x[1]][0]
                    break
            if pivot is None:
                break
            score = 0.0
            for x in lists:
                while x[1] < len(x[0]) and x[0][x[1]][0] < pivot:
                    x[1] += 1
                if x[1] < len(x[0]) and x[0][x[1]][0] == pivot:
                    score += x[0][x[1]][1]
                    x[1] += 1
            if score >= self.need[pivot] - 1e-9:
                found.append((pivot, score))
            lists = [x for x in lists if x[1] < len(x[0])]
        return found

    def search(self, h: np.ndarray, docs: np.ndarray) -> Iterator[tuple[int, int, float, float, float]]:
        """(document, item, score / own score, question overlap, answer overlap) of every verified item,
        the best passage of each document and item."""
        n = np.diff(docs)
        per = np.maximum(-(-n // self.half) - 1, 1) * (n > 0)
        doc = np.repeat(np.arange(len(n)), per)
        step = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
        starts = docs[:-1][doc] + step * self.half
        ends = np.minimum(starts + 2 * self.half, docs[1:][doc])
        terms = self.lookup(h)
        best: dict[tuple[int, int], tuple[float, float, float]] = {}
        for p, block in zip(*(x.tolist() for x in self.open_blocks(terms, docs, np.concatenate(([0], np.cumsum(per)))))):
            own = np.unique(terms[starts[p] : ends[p]])
            for item, score in self.wand(own.tolist(), block):
                # an item cut by a passage's end is judged on the words around, too
                a, b = max(starts[p] - self.half, docs[doc[p]]), min(ends[p] + self.half, docs[doc[p] + 1])
                q, ans = (float(np.isin(g, grams(h[a:b], k)).mean()) if len(g) else 1.0 for k, g in self.grams[item])
                sizes = [len(g) for _, g in self.grams[item]]
                whole = (q * sizes[0] + ans * sizes[1]) / max(1, sum(sizes))
                if (q >= QUESTION_OVERLAP and ans >= ANSWER_OVERLAP) or whole >= WHOLE_OVERLAP:
                    key, value = (int(doc[p]), item), (score / (self.need[item] / THRESHOLD), q, ans)
                    best[key] = max(best.get(key, value), value)
        for (d, item), (score, q, ans) in sorted(best.items()):
            yield d, self.ids[item], score, q, ans


def _indexes(benchmark: DataFrame) -> Iterator[Index]:
    """One index a slice of items in id order; statistics are of all items.

    Each slice is read apart, so that the driver holds ``SLICE_ITEMS`` items
    and their words' frequencies at a time.
    """
    items = typed(benchmark, "item_id", "text", types={"item_id": "bigint", "text": "string"})

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, t in zip(batch.column("slot").to_pylist(), batch.column("text").to_pylist()):
                h = _text_hashes(t or "")
                yield pa.RecordBatch.from_arrays([pa.array([i] * (len(u := np.unique(h)) + 1), pa.int64()), pa.array([*u.view(np.int64), 0], pa.int64()), pa.array([0] * len(u) + [len(h)], pa.int64())], ["slot", "word", "length"])

    rows = items.select(F.monotonically_increasing_id().alias("at"), "item_id", "text")
    count = rows.count()
    parts = max(1, -(-count // SLICE_ITEMS))
    slot = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)).alias("slot")
    listed = rows.select(slot, "text").mapInArrow(words, "slot bigint, word bigint, length bigint")
    size = listed.agg(F.sum("length")).first()[0] or 0
    if not size:
        return
    df = listed.where("length = 0").groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    for s in range(parts):
        own = rows.where(slot == s).select("item_id", "text").orderBy("item_id", "text").collect()
        mine = listed.where((F.col("slot") == s) & (F.col("length") == 0)).select("word").distinct()
        known = {r["word"] & 0xFFFFFFFFFFFFFFFF: r["df"] for r in df.join(mine, "word").collect()}
        own = [(r["item_id"], r["text"]) for r in own if r["text"] and r["text"].split()]
        for short in _by_length(own):
            yield Index(short, known, count, size / count)


def _by_length(items: list[tuple[int, str]]) -> list[list[tuple[int, str]]]:
    """Items of like length together: a passage is as long as its items ask for."""
    groups: dict[int, list[tuple[int, str]]] = {}
    for item in items:
        groups.setdefault(max(4, len(item[1].split()).bit_length()), []).append(item)
    return [groups[k] for k in sorted(groups)]


def _groups(benchmark: DataFrame) -> Iterator[list[Index]]:
    """A few indexes at a time, made when asked for; one empty group without items."""
    indexes = _indexes(benchmark)
    some = list(islice(indexes, 4))
    yield some
    while some := list(islice(indexes, 4)):
        yield some


_FOUND = "doc_id bigint, item_id bigint, score double, question_overlap double, answer_overlap double"


def contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, keep: bool = False) -> DataFrame:
    """One row for each document and item found in it; with ``keep`` instead the
    rows of ``docs`` in which nothing was found."""
    def find(batch: pa.RecordBatch, some: list[Index]) -> list[tuple]:
        data, offsets = utf8(batch.column("text"))
        out = []
        for i, j in slices(offsets):
            w = split_words(data, offsets[i : j + 1], lower=True)
            h = bare_hashes(w)
            for index in some:
                out += [(i + d, *rest) for d, *rest in index.search(h, w.docs)]
        return out

    if keep:
        kept, last = docs, None
        for turn, some in enumerate(_groups(benchmark)):
            if turn:  # a pass ends before the next one's indexes are shared
                kept = staged(spark, kept, "decontaminated")
                if last is not None:
                    release(spark, last)
                last = kept
            shared = Shared(spark, some)

            def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
                fresh_task()
                for batch in batches:
                    bad = np.zeros(batch.num_rows, bool)
                    bad[[x[0] for x in find(batch, shared.value)]] = True
                    yield batch.filter(pa.array(~bad))

            kept = kept.mapInArrow(clean, docs.schema)
        return kept

    def pairs(some: list[Index]) -> DataFrame:
        shared = Shared(spark, some)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                got = find(batch, shared.value)
                cols = list(zip(*got)) or [[]] * 5
                ids = batch.column("doc_id").take(pa.array(cols[0], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(cols[1], pa.int64()), *[pa.array(c, pa.float64()) for c in cols[2:5]]],
                    ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"],
                )

        return typed(docs, "doc_id", "text").mapInArrow(run, _FOUND)

    found: list[DataFrame] = []
    for some in _groups(benchmark):
        if found:
            found[-1] = staged(spark, found[-1], "leaks")
        found.append(pairs(some))
    return reduce(DataFrame.unionAll, found)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
