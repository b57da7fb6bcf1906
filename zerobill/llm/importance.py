"""Operator 13: importance resampling towards a target distribution.

Features of a text are its words and pairs of neighbours, hashed into buckets.
One scan counts the buckets of the corpus (each task sends at most one row a
bucket), another sums, from one array of bucket gains, the weight of every
document. A seeded Gumbel number of the id is added, and the highest scores
are drawn: sampling without replacement in proportion to exp(weight).

The cutoff is found by weighted median-of-medians selection. Keys (score
falling, id, row number) are unique. In each round every partition of the
staged scores gives the medians of its keys on either side of the last pivot
and their numbers; the median of those medians, weighted by the remaining
numbers, is the next pivot, so a round is sure to discard a quarter of what
remains. Once an eighth is left the remaining keys are written again, so all
rounds together read little more than the first. Only the winners are sorted,
over many partitions.

The driver holds one row a bucket (a parameter) and, each round, one row a
partition. Every scan is repeatable; staged tables survive lost executors.

Defined cases: null, empty and wordless texts have no features, weight 0 and
are never drawn; a text with one word has one feature; a null id seeds its
Gumbel number with an empty id and comes last among equal scores; repeated
rows are separate documents, each with a place of its own; an empty benchmark
counts no target features; an empty table gives no rows; a text of any length
is read in runs; other columns are never read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zerobill.llm.common import staged, table, typed
from zerobill.llm.lexical_search import term_runs

BUCKETS = 10_000
LEAST_WORDS = 20
SEED = 7
PERCENT = 25
#: Features a task holds before it counts them.
HELD_FEATURES = 1 << 20
#: The remaining keys are written again when no more than this share of the table read is left.
REWRITE = 1 / 8

Key = tuple[int, int, int]


def feature_runs(raw: bytes, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(number of words, buckets of the words and pairs) of each run of a text."""
    last: int | None = None
    for words in term_runs(raw):
        if not words:
            continue
        single = list(map(crc32, words))
        # crc32 carried on from the first word's over a space and the second
        before = single[:-1] if last is None else [last, *single[:-1]]
        after = words[1:] if last is None else words
        pairs = map(crc32, [b" " + w for w in after], before)
        found = np.fromiter(pairs, np.uint32, len(after))
        last = single[-1]
        yield len(words), np.concatenate((np.array(single, np.uint32), found)) % np.uint32(buckets)


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts each bucket holds; at most one row a bucket and task is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, size = np.zeros(buckets, np.int64), [], 0
        for batch in batches:
            for text in batch.column("text"):
                for _, found in feature_runs(text.as_py() or b"", buckets):
                    held.append(found)
                    size += len(found)
                    if size >= HELD_FEATURES:
                        total += np.bincount(np.concatenate(held), minlength=buckets)
                        held, size = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["bucket", "n"])

    counted = _bytes(texts).select("text").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for bucket, n in counted.toPandas().itertuples(index=False, name=None):
        out[bucket] = n
    return out


def _bytes(texts: DataFrame) -> DataFrame:
    return typed(texts, "doc_id", "text").select("doc_id", F.col("text").cast("binary").alias("text"))


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the ratio of a bucket's smoothed shares, target to corpus."""
    n, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    ratio = lambda s, t: ((t + 1.0) * (s_all + n)) / ((s + 1.0) * (t_all + n))
    return np.array([math.floor(1000 * math.log(ratio(s, t))) for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def weighed(spark: SparkSession, docs: DataFrame, gains: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every document."""
    shared = spark.sparkContext.broadcast(gains)  # one number a bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = shared.value
        for batch in batches:
            rows = np.zeros((3, batch.num_rows), np.int64)
            for i, text in enumerate(batch.column("text")):
                for words, found in feature_runs(text.as_py() or b"", len(gains)):
                    rows[:, i] += (words, len(found), gains[found].sum())
            n_words, n, total = rows
            weight = total // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, (n_words, n, weight))], ["doc_id", "n_words", "n_features", "weight"])

    return _bytes(docs).mapInArrow(run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def gumbel(doc_id: Column, seed: int) -> Column:
    """floor(-1000 ln(-ln u)) with u from the first 8 hex digits of sha256("seed:id")."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("bigint")


def _weighted_median(found: list[tuple[Key, int]]) -> Key:
    half, at = sum(n for _, n in found) / 2, 0
    for key, n in sorted(found):
        at += n
        if at >= half:
            return key
    raise ValueError("no keys remain")


def _beyond(bound: Key, above: bool) -> Column:
    a, b, c = (F.col(n) for n in ("a", "b", "c"))
    x, y, z = map(F.lit, bound)
    if above:
        return (a > x) | ((a == x) & ((b > y) | ((b == y) & (c > z))))
    return (a < x) | ((a == x) & ((b < y) | ((b == y) & (c < z))))


def kth_key(spark: SparkSession, keys: DataFrame, k: int) -> Key:
    """The k-th smallest of the distinct keys (a, b, c), k from 1.

    ``keys`` is read once a round, so it should be a staged table.
    """

    def medians(pivot: Key | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = [[], [], []]
            for batch in batches:
                for own, column in zip(held, batch.columns):
                    own.append(column.to_numpy())
            if not held[0]:
                return
            a, b, c = map(np.concatenate, held)
            if pivot is None:
                below, above = np.zeros(len(a), bool), np.ones(len(a), bool)
            else:
                x, y, z = pivot
                below = (a < x) | ((a == x) & ((b < y) | ((b == y) & (c < z))))
                above = ~below & ~((a == x) & (b == y) & (c == z))
            for side, chosen in ((0, below), (1, above)):
                at = np.flatnonzero(chosen)
                if len(at):
                    mid = at[np.lexsort((c[at], b[at], a[at]))[(len(at) - 1) // 2]]
                    values = [side, len(at), a[mid], b[mid], c[mid]]
                    yield pa.RecordBatch.from_arrays([pa.array([int(v)], pa.int64()) for v in values], ["side", "n", "a", "b", "c"])

        return run

    low: Key | None = None
    high: Key | None = None
    pivot: Key | None = None
    size, passed = None, 0
    while True:
        alive = keys
        if low is not None:
            alive = alive.where(_beyond(low, True))
        if high is not None:
            alive = alive.where(_beyond(high, False))
        # one row a partition and side
        rows = alive.mapInArrow(medians(pivot), "side bigint, n bigint, a bigint, b bigint, c bigint").collect()
        sides = {s: [((r["a"], r["b"], r["c"]), r["n"]) for r in rows if r["side"] == s] for s in (0, 1)}
        count = {s: sum(n for _, n in v) for s, v in sides.items()}
        if pivot is None:
            size, remaining = count[1], sides[1]
            if not 1 <= k <= size:
                raise ValueError(f"there are {size} keys, no {k}-th")
        elif passed + count[0] >= k:
            high, remaining = pivot, sides[0]
        elif passed + count[0] + 1 == k:
            return pivot
        else:
            low, passed, remaining = pivot, passed + count[0] + 1, sides[1]
        left = sum(n for _, n in remaining)
        if left <= size * REWRITE and low is not None and high is not None:
            keys = staged(spark, keys.where(_beyond(low, True) & _beyond(high, False)), "resample-keys")
            size = left
        pivot = _weighted_median(remaining)


def _ranked(spark: SparkSession, winners: DataFrame) -> DataFrame:
    """Winners with their places: sorted over many partitions, each shifted by the rows before it."""
    local = staged(spark, winners.repartitionByRange("a", "b", "c").sortWithinPartitions("a", "b", "c").withColumn("at", F.monotonically_increasing_id()), "resample-sorted")
    part = F.shiftright("at", 33)
    # one row a sorted partition
    parts = local.groupBy(part.alias("part")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    shifts, before = [], 0
    for r in parts:
        shifts.append((r["part"], before - r["first"] + 1))
        before += r["n"]
    shift = F.broadcast(spark.createDataFrame(shifts, "part bigint, shift bigint"))
    return local.withColumn("part", part).join(shift, "part").withColumn("rank", F.col("at") + F.col("shift"))


def resample(
    spark: SparkSession,
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; the rank is null where it is not drawn."""
    gains = bucket_gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    scored = weighed(spark, docs, gains).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    # a, b, c: the order of drawing
    scored = scored.select(
        "*", (-F.col("score")).alias("a"), F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("b"), F.monotonically_increasing_id().alias("c")
    )
    scored = staged(spark, scored, "resample-scored")
    eligible = F.col("n_words") >= least_words
    k = percent * scored.where(eligible).count() // 100
    out = ["doc_id", "n_features", "weight", "score"]
    undrawn = F.lit(None).cast("bigint").alias("rank")
    if k == 0:
        return scored.select(*out, undrawn)
    cutoff = kth_key(spark, scored.where(eligible).select("a", "b", "c"), k)
    drawn = eligible & ~_beyond(cutoff, True)
    return _ranked(spark, scored.where(drawn)).select(*out, "rank").unionAll(scored.where(~drawn).select(*out, undrawn))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE_SQL = r"""
WITH RECURSIVE bits AS (
    SELECT i AS byte, i::BIGINT AS c, 0 AS step FROM range(256) t(i)
    UNION ALL
    SELECT byte, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1 FROM bits WHERE step < 8
), steps AS (
    SELECT list(c ORDER BY byte) AS t FROM bits WHERE step = 8
), texts AS (
    SELECT 0 AS kind, row_number() OVER () AS d, doc_id, text FROM documents
    UNION ALL SELECT 1, row_number() OVER (), NULL, text FROM benchmark
), words AS (
    SELECT kind, d, doc_id,
           coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
    FROM texts
), features AS (
    SELECT kind, d, f, count(*)::BIGINT AS n FROM (
        SELECT kind, d, unnest(w) AS f FROM words
        UNION ALL
        SELECT kind, d, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words
    ) GROUP BY kind, d, f
), bytes AS (
    SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM features)
), hashed AS (
    SELECT f, xor(list_reduce(
                 list_prepend(4294967295::BIGINT, list_transform(range(1, len(h) + 1, 2), lambda i: ('0x' || substr(h, i, 2))::BIGINT)),
                 lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
    FROM bytes, steps
), found AS (
    SELECT kind, d, bucket, sum(n)::BIGINT AS n FROM features JOIN hashed USING (f) GROUP BY kind, d, bucket
), counted AS (
    SELECT bucket, coalesce(sum(n) FILTER (kind = 0), 0)::BIGINT AS s, coalesce(sum(n) FILTER (kind = 1), 0)::BIGINT AS t
    FROM found GROUP BY bucket
), totals AS (
    SELECT coalesce(sum(s), 0)::BIGINT AS s_all, coalesce(sum(t), 0)::BIGINT AS t_all FROM counted
), gains AS (
    SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (s_all + 10000)::DOUBLE) / ((s + 1)::DOUBLE * (t_all + 10000)::DOUBLE)))::BIGINT AS gain
    FROM counted, totals
), summed AS (
    SELECT d, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS total FROM found JOIN gains USING (bucket) WHERE kind = 0 GROUP BY d
), scored AS (
    SELECT d, doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features,
           coalesce(floor(total::DOUBLE / n_features)::BIGINT, 0) AS weight,
           ('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
    FROM words LEFT JOIN summed USING (d) WHERE kind = 0
), keyed AS (
    SELECT d, doc_id, n_words, n_features, weight,
           weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
    FROM scored
), placed AS (
    SELECT *, n_words >= 20 AS fit, count(*) FILTER (n_words >= 20) OVER () AS n_fit,
           row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id ASC NULLS LAST, d)::BIGINT AS place
    FROM keyed
)
SELECT doc_id, n_features, weight, score, CASE WHEN fit AND place <= (25 * n_fit) // 100 THEN place END AS rank FROM placed
"""
