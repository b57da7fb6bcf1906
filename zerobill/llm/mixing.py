"""Operator 9: mix sources to target weights, DataFrame functions only.

Weights 5, 2, 1 repeat over the sources in code point order, null last. The
targets share the corpus total by weight; no target exceeds ``max_repeat``
times its source's size and the excess is shared again by weight. A document
is taken floor(rate) times, rate being target / source size, plus one copy if
a uniform number hashed from the seed, its id and its text falls below the
fraction.

Defined cases: a null text has size 0; sources whose texts hold no words get
target 0 and rate 0; null ids and texts hash as empty strings; repeated rows
share their number; an empty table gives no rows. Extra columns are kept by
:func:`mix_documents` where the caller's frame has them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zerobill.llm.common import staged, table, typed

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def uniform(*parts: Column, seed: str = SEED) -> Column:
    """[0, 1) from 52 bits of an MD5, the same in any SQL engine."""
    key = F.concat_ws("|", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(source, source_size, target) from one row per source.

    Capped sources are those with the smallest size / weight: taken in that
    order, a source is capped while its share by weight of what is left
    exceeds its cap. Only the per-source table, one row each, is ordered.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy(F.col("__ratio"), F.col("__rank"))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.col("__rank") % len(weights) + 1).cast("int"))
    ranked = (
        sizes.withColumn("__rank", F.row_number().over(order) - 1)
        .withColumn("__w", w.cast("bigint"))
        .withColumn("__ratio", F.col("source_size") / F.col("__w"))
        .withColumn("__total", F.sum("source_size").over(whole))
        .withColumn("__left", F.col("__total") - max_repeat * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
        .withColumn("__weights", F.sum("__w").over(rest))
        .withColumn("__open", F.col("__left") * F.col("__w") <= max_repeat * F.col("source_size") * F.col("__weights"))
    )
    first = F.min(F.when(F.col("__open"), F.struct("__ratio", "__rank", "__left", "__weights"))).over(whole)
    is_open = F.col("__ratio").isNotNull() & (
        F.struct("__ratio", "__rank") >= F.struct(F.col("__first.__ratio"), F.col("__first.__rank"))
    )
    share = (F.col("__w") * F.col("__first.__left")).cast("double") / F.col("__first.__weights").cast("double")
    return (
        ranked.withColumn("__first", first)
        .withColumn("target", F.when(is_open, share).otherwise((max_repeat * F.col("source_size")).cast("double")))
        .select("source", "source_size", "target")
    )


def mix_documents(
    spark: SparkSession, docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT, seed: str = SEED
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies), one row per document.

    Sizes are counted once and staged without the texts. The per-source table
    is joined without a hint: its size decides, and the join is on the small
    side's key with skewed partitions split at run time.
    """
    sized = staged(
        spark,
        typed(docs, "doc_id", "source", "text").select(
            "doc_id", "source", n_words(F.col("text")).alias("size"), uniform(F.col("doc_id"), F.col("text"), seed=seed).alias("u")
        ),
        "mix-sizes",
    )
    sources = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_repeat)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor("rate")
    joined = sized.alias("d").join(sources.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
    return (
        joined.select("d.doc_id", "d.source", "d.size", "d.u", "s.source_size", "s.target")
        .withColumn("rate", F.least(rate, F.lit(float(max_repeat))))
        .withColumn("copies", (whole + F.when(F.col("u") < F.col("rate") - whole, 1).otherwise(0)).cast("int"))
        .select("doc_id", "source", "size", "source_size", "target", "copies")
    )


def mixed_rows(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT, seed: str = SEED) -> DataFrame:
    """Every row of ``docs`` as often as the mix takes it, columns unchanged."""
    sizes = docs.groupBy(F.col("source").cast("string").alias("source")).agg(F.sum(n_words(F.col("text"))).alias("source_size"))
    targets = source_targets(sizes, weights, max_repeat)
    rate = F.least(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)), F.lit(float(max_repeat)))
    rates = targets.select("source", rate.alias("rate")).alias("s")
    # the row travels whole, so that no column of its own can clash
    rows = docs.select(F.struct("*").alias("row"), F.col("source").cast("string").alias("source"), uniform(F.col("doc_id"), F.col("text"), seed=seed).alias("u")).alias("d")
    whole = F.floor("rate")
    copies = whole + F.when(F.col("u") < F.col("rate") - whole, 1).otherwise(0)
    joined = rows.join(rates, F.col("d.source").eqNullSafe(F.col("s.source"))).select("row", copies.cast("int").alias("copies"))
    return joined.select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies")))).select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_documents(spark, table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies")


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST(CAST('0x' || substr(md5('mix-1|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')), 1, 13) AS BIGINT) AS DOUBLE)
           / 4503599627370496.0 AS u
  FROM documents
), s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rk FROM s),
w AS (SELECT *, CASE rk % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM r),
x AS (
  SELECT *, (SELECT sum(source_size) FROM s) - 3 * coalesce(sum(source_size) OVER (ORDER BY source_size / w, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(w) OVER (ORDER BY source_size / w, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws,
         row_number() OVER (ORDER BY source_size / w, rk) AS pos
  FROM w
), f AS (SELECT rest, ws, pos FROM x WHERE rest * w <= 3 * source_size * ws ORDER BY pos LIMIT 1),
t AS (
  SELECT x.source, x.source_size,
         CASE WHEN x.pos >= f.pos THEN CAST(x.w * f.rest AS DOUBLE) / CAST(f.ws AS DOUBLE) ELSE CAST(3 * x.source_size AS DOUBLE) END AS target
  FROM x, f
), m AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target, d.u,
         least(CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END, 3.0) AS rate
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), c AS (SELECT *, CAST(floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END AS INTEGER) AS copies FROM m)
SELECT doc_id, size, source_size, target, size * copies AS taken, source, copies FROM c
"""
