"""Operator 12: ranked lexical search by the Best Position Algorithm.

Scores are those of the contract: an item's terms, once each, weigh
``w * ((1e9 * tf) div (1000 * tf + 8 * m))`` in a document. Only terms that
items hold need postings, so one scan of the corpus counts its documents and
terms, and stages, for blocks of documents, which query terms each holds and
how often; document frequencies are summed by Spark.

Every task then searches its own blocks. A block's postings become one impact
list a term, sorted by falling impact. An item reads its lists side by side;
each document met is looked up in all of them (direct access) and scored at
once, and the places where it stands are marked as seen. The best position of
a list is the end of its run of seen places from the top: no document unseen
so far can score more than the sum of the impacts at the best positions, which
lie at or below the last places read. The item is done with the block when
that sum is strictly below its k-th score (so ties are never lost), which is
carried from block to block. A task returns at most k documents an item, and
a window over those picks the k best.

Items come in blocks of bounded size (``QUERY_ROWS``, ``QUERY_BYTES``), one scan each, so
neither the driver nor a task ever holds more than one block of them.

Defined cases: null and empty texts, and texts without a term, hold nothing
and do not count into N; an item without terms, or whose terms no document
holds, has no rows; a null item or document id is carried as null, a null
document id ranks last among equal scores; each row of ``benchmark`` is an
item of its own even if its id repeats, and so is each row of ``documents``;
a text of any length is read in runs; empty tables give no rows; other columns
are never read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zerobill.llm.common import staged, table, typed

TOP = 10
#: Items of one scan.
QUERY_ROWS, QUERY_BYTES = 4096, 8 << 20
#: Postings after which a task closes a block.
BLOCK_POSTINGS = 1 << 20
#: Bytes of a text that are split at a time.
RUN_BYTES = 1 << 20
#: Places of each list that one round reads: the first round, and the most later ones grow to.
FIRST_READ, MOST_READ = 8, 512


def _table() -> bytes:
    """Bytes of terms, A-Z lowered; any other byte becomes a space."""
    kept = {*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)}
    return bytes((b + 32 if 0x41 <= b <= 0x5A else b) if b in kept else 0x20 for b in range(256))


TERM_BYTES = _table()


def term_runs(raw: bytes, most: int = RUN_BYTES) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of about ``most`` bytes; no term is cut."""
    clean, at = raw.translate(TERM_BYTES), 0
    while len(clean) - at > most:
        cut = clean.rfind(b" ", at, at + most)
        if cut <= at:
            cut = clean.find(b" ", at + most)
        if cut < 0:
            break
        yield clean[at:cut].split()
        at = cut
    yield (clean[at:] if at else clean).split()


_BLOCK = ["doc_ids", "known", "sizes", "ends", "terms", "counts", "df", "seen"]


def staged_postings(spark: SparkSession, docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """Blocks of documents with their query terms, and one row a task with its
    document frequencies and (documents, terms) of all its texts."""
    words = spark.sparkContext.broadcast(vocabulary)  # the terms of one block of items

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {w: i for i, w in enumerate(words.value)}
        get, df, seen = number.get, np.zeros(len(number), "<i8"), np.zeros(2, "<i8")
        names: list[int | None] = []
        sizes: list[int] = []
        ends: list[int] = []
        terms: list[int] = []
        counts: list[int] = []

        def row(values: dict) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([values.get(c)], pa.binary()) for c in _BLOCK], _BLOCK)

        def block() -> pa.RecordBatch:
            t = np.array(terms, "<u4")
            np.add.at(df, t, 1)
            return row({
                "doc_ids": np.array([i or 0 for i in names], "<i8").tobytes(),
                "known": np.array([i is not None for i in names], np.uint8).tobytes(),
                "sizes": np.array(sizes, "<i8").tobytes(),
                "ends": np.array(ends, "<i8").tobytes(),
                "terms": t.tobytes(),
                "counts": np.array(counts, "<u4").tobytes(),
            })

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                n, held = 0, Counter()
                for run_terms in term_runs(text.as_py() or b""):
                    n += len(run_terms)
                    held.update(map(get, run_terms))
                if not n:
                    continue
                seen += (1, n)
                del held[None]
                if not held:
                    continue
                names.append(doc_id)
                sizes.append(n)
                terms += held.keys()
                counts += held.values()
                ends.append(len(terms))
                if len(terms) >= BLOCK_POSTINGS:
                    yield block()
                    names, sizes, ends, terms, counts = [], [], [], [], []
        if names:
            yield block()
        yield row({"df": df.tobytes(), "seen": seen.tobytes()})

    texts = typed(docs, "doc_id", "text").select("doc_id", F.col("text").cast("binary").alias("text"))
    return staged(spark, texts.mapInArrow(run, ", ".join(f"{c} binary" for c in _BLOCK)), "search-postings", "zstd")


def corpus_counts(postings: DataFrame, terms: int) -> tuple[int, int, np.ndarray]:
    """(documents with a term, all their terms, document frequency of each query term)."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for df, seen in zip(batch.column("df"), batch.column("seen")):
                n = np.concatenate((np.frombuffer(seen.as_py(), "<i8"), np.frombuffer(df.as_py(), "<i8")))
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(at - 2, pa.int64()), pa.array(n[at], pa.int64())], ["term", "n"])

    rows = postings.where(F.col("df").isNotNull()).select("df", "seen").mapInArrow(listed, "term bigint, n bigint")
    found = dict(rows.groupBy("term").agg(F.sum("n").alias("n")).toPandas().itertuples(index=False, name=None))
    df = np.zeros(terms, np.int64)
    for term, n in found.items():
        if term >= 0:
            df[term] = n
    return found.get(-2, 0), found.get(-1, 0), df


def weights(documents: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)


class ImpactBlock:
    """Impact lists of one block of documents, and each document's places in them."""

    def __init__(self, block: dict[str, bytes], weight: np.ndarray, documents: int, total: int):
        ids = np.frombuffer(block["doc_ids"], "<i8")
        self.known = np.frombuffer(block["known"], np.uint8) > 0
        self.doc_ids = ids
        ends = np.frombuffer(block["ends"], "<i8")
        self.begin = np.concatenate(([0], ends[:-1]))
        self.length = ends - self.begin
        self.term = np.frombuffer(block["terms"], "<u4").astype(np.int64)
        tf = np.frombuffer(block["counts"], "<u4").astype(np.int64)
        m = 10 + (90 * np.frombuffer(block["sizes"], "<i8") * documents) // total
        self.doc = np.repeat(np.arange(len(ids)), self.length)
        self.impact = weight[self.term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[self.doc]))
        # the lists: by term, falling impact, document
        self.order = np.lexsort((self.doc, -self.impact, self.term))
        terms = np.arange(len(weight) + 1)
        self.list_begin = np.searchsorted(self.term[self.order], terms)
        self.place = np.empty(len(self.order), np.int64)
        self.place[self.order] = np.arange(len(self.order)) - self.list_begin[self.term[self.order]]

    def direct(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Posting numbers of the documents, and where each document's begin among them."""
        length = self.length[docs]
        first = np.cumsum(length) - length
        return np.repeat(self.begin[docs] - first, length) + np.arange(int(length.sum())), first


class Best:
    """The k best documents of an item so far."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.doc_id, self.known = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def kth(self) -> int:
        return int(self.score[-1]) if len(self.score) == self.k else 0

    def offer(self, score: np.ndarray, doc_id: np.ndarray, known: np.ndarray) -> None:
        keep = score >= max(self.kth(), 1)
        if not keep.any():
            return
        score, doc_id, known = (np.concatenate((a, b[keep])) for a, b in ((self.score, score), (self.doc_id, doc_id), (self.known, known)))
        order = np.lexsort((doc_id, ~known, -score))[: self.k]
        self.score, self.doc_id, self.known = score[order], doc_id[order], known[order]


def best_positions(block: ImpactBlock, terms: np.ndarray, best: Best) -> int:
    """Offers ``best`` every document of the block that can be among its k;
    returns how many documents were scored."""
    begin, end = block.list_begin[terms], block.list_begin[terms + 1]
    lists = [(b, e) for b, e in zip(begin.tolist(), end.tolist()) if e > b]
    terms = terms[end > begin]
    slot = np.full(len(block.list_begin), -1)
    slot[terms] = np.arange(len(terms))
    seen = [np.zeros(e - b, bool) for b, e in lists]
    flat_begin = np.concatenate(([0], np.cumsum([len(s) for s in seen])))[:-1] if lists else np.zeros(0, np.int64)
    marks = np.zeros(sum(map(len, seen)), bool)
    met = np.zeros(len(block.doc_ids), bool)
    position = [0] * len(lists)  # places seen from the top of each list without a gap
    read, step, scored = 0, FIRST_READ, 0
    while True:
        bound = 0
        for i, (b, e) in enumerate(lists):
            own = marks[flat_begin[i] : flat_begin[i] + e - b]
            at = position[i]
            if at < len(own):
                gap = int(np.argmin(own[at:]))
                at = len(own) if own[at + gap] else at + gap
                position[i] = at
            if at < len(own):
                # nothing seen yet bounds a list by its first impact
                bound += int(block.impact[block.order[b + max(at - 1, 0)]])
        if bound < max(best.kth(), 1) or all(read >= e - b for b, e in lists):
            return scored
        reached = np.concatenate([block.order[b + read : min(e, b + read + step)] for b, e in lists if read < e - b])
        docs = np.unique(block.doc[reached])
        docs = docs[~met[docs]]
        read, step = read + step, min(2 * step, MOST_READ)
        if not len(docs):
            continue
        met[docs] = True
        postings, first = block.direct(docs)
        of = slot[block.term[postings]]
        own = of >= 0
        scores = np.add.reduceat(np.where(own, block.impact[postings], 0), first)
        marks[flat_begin[of[own]] + block.place[postings[own]]] = True
        scored += len(docs)
        best.offer(scores, block.doc_ids[docs], block.known[docs])


def _query_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, bytes]]]:
    """Items with their texts, block by block through the driver."""
    held, size = [], 0
    items = typed(benchmark, "item_id", "text", types={"item_id": "bigint", "text": "string"})
    for r in items.where(F.length("text") > 0).toLocalIterator():
        raw = r["text"].encode()
        if held and (len(held) >= QUERY_ROWS or size + len(raw) > QUERY_BYTES):
            yield held
            held, size = [], 0
        held.append((r["item_id"], raw))
        size += len(raw)
    if held:
        yield held


_FOUND = "item bigint, doc_id bigint, score bigint"


def _search_block(spark: SparkSession, docs: DataFrame, items: list[tuple[int | None, bytes]], top: int) -> DataFrame:
    sets = [sorted({t for run in term_runs(raw) for t in run}) for _, raw in items]
    vocabulary = sorted({t for s in sets for t in s})
    number = {t: i for i, t in enumerate(vocabulary)}
    postings = staged_postings(spark, docs, vocabulary)
    documents, total, df = corpus_counts(postings, len(vocabulary))
    weight = weights(documents, df)
    terms_of = [np.array([number[t] for t in s if weight[number[t]] > 0 and df[number[t]]], np.int64) for s in sets]
    shared = spark.sparkContext.broadcast((weight, terms_of))  # one block of items

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, terms_of = shared.value
        best = [Best(top) for _ in terms_of]
        for batch in batches:
            for row in range(batch.num_rows):
                block = ImpactBlock({c: batch.column(c)[row].as_py() for c in _BLOCK[:6]}, weight, documents, total)
                for terms, b in zip(terms_of, best):
                    if len(terms):
                        best_positions(block, terms, b)
        item = np.repeat(np.arange(len(best)), [len(b.score) for b in best])
        if len(item):
            doc_id, known, score = (np.concatenate([getattr(b, n) for b in best]) for n in ("doc_id", "known", "score"))
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(doc_id, pa.int64(), mask=~known), pa.array(score, pa.int64())], ["item", "doc_id", "score"])

    found = postings.where(F.col("doc_ids").isNotNull()).select(*_BLOCK[:6]).mapInArrow(run, _FOUND)
    ranked = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)
    names = spark.createDataFrame([(i, name) for i, (name, _) in enumerate(items)], "item bigint, item_id bigint")
    return staged(spark, best.join(names, "item").select("item_id", "rank", "doc_id", "score"), "search-found")


def search(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of every item."""
    found = [_search_block(spark, docs, items, top) for items in _query_blocks(benchmark)]
    empty = spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    return reduce(DataFrame.unionAll, found, empty)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE_SQL = r"""
WITH words AS (
    SELECT row_number() OVER () AS d, doc_id,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), sized AS (
    SELECT d, doc_id, terms, len(terms)::BIGINT AS n FROM words WHERE len(terms) > 0
), corpus AS (
    SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM sized
), items AS (
    SELECT row_number() OVER () AS item, item_id,
           list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS terms
    FROM benchmark
), wanted AS (
    SELECT item, item_id, unnest(terms) AS term FROM items
), held AS (
    SELECT d, doc_id, n, term, count(*)::BIGINT AS tf
    FROM (SELECT d, doc_id, n, unnest(terms) AS term FROM sized)
    WHERE term IN (SELECT term FROM wanted)
    GROUP BY d, doc_id, n, term
), weighed AS (
    SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM held, corpus GROUP BY term, docs
), scored AS (
    SELECT item, item_id, d, doc_id,
           sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total))))::BIGINT AS score
    FROM wanted JOIN held USING (term) JOIN weighed USING (term), corpus
    GROUP BY item, item_id, d, doc_id
)
SELECT item_id, rank, doc_id, score FROM (
    SELECT item_id, doc_id, score,
           row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id ASC NULLS LAST)::INTEGER AS rank
    FROM scored WHERE score > 0
) WHERE rank <= 10
"""
