"""Operator 8: k-d tree shards of near-equal bytes.

The tree splits all documents at distributed weighted medians along the
dimension in which a node is widest, until every leaf holds one shard's share.
Dimensions are metadata of a text: its source, language and size; ties within
a value are ordered by the text's hash. Copies of a text carry the metadata of one of them (the smallest source
and language), so they have the same point and stay together; only a group
that would leave a cut off by more than ``TOLERANCE`` of a shard is divided,
by a hash of the document id.

Law: ``bytes``. A document's size is its UTF-8 bytes plus 8.

Defined cases: a null text counts as empty (size 8, crc 0); null source or
language is a value of its own; null ids are placed like any other and come
first in slot order; repeated rows are separate rows; an empty table gives no
rows; a shard may be empty when there are fewer points than shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zerobill.llm.common import staged, table, typed

SHARDS = 24
ROW_BYTES = 8
#: Share of one shard's bytes by which a cut may miss its target before a group of copies is divided.
TOLERANCE = 0.01
#: Histogram bins a node gets in each refinement of its median.
BINS = 512
DIMS = ("c_source", "c_lang", "c_size")
#: Coordinates are whole numbers below 2**60: 20 bits of the value, then 40 bits of the text's hash.
VALUE_BITS, TAIL_BITS = 20, 40
TOP = 1 << (VALUE_BITS + TAIL_BITS)


def _code(c: Column) -> Column:
    """20 bits of a text value; null has its own."""
    return F.when(c.isNull(), F.lit(0)).otherwise(F.crc32(c.cast("binary")) % F.lit((1 << VALUE_BITS) - 1) + 1).cast("bigint")


def points(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, size, text_crc32, group key and dimension coordinates."""
    text = F.coalesce(F.col("text"), F.lit(""))
    size = F.octet_length(text).cast("bigint")
    d = typed(docs, "doc_id", "text", "lang", "source").select(
        "doc_id",
        (size + ROW_BYTES).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("g"),
        _code(F.col("source")).alias("v_source"),
        _code(F.col("lang")).alias("v_lang"),
        # the logarithm spreads sizes evenly over the dimension
        F.least((F.log2(size + 1) * 20000).cast("bigint"), F.lit((1 << VALUE_BITS) - 1)).alias("v_size"),
    )
    return d


def _place(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Rows with coordinates, equal for all copies of a text, and a uniform
    number ``u`` of the id by which a group is divided where it must be."""
    groups = rows.groupBy("g").agg(F.min("v_source").alias("v_source"), F.min("v_lang").alias("v_lang"), F.min("v_size").alias("v_size"))
    tail = F.shiftrightunsigned(F.xxhash64("g"), 64 - TAIL_BITS)
    u = F.shiftrightunsigned(F.xxhash64(F.coalesce("doc_id", F.lit(-1)), F.lit("u")), 11).cast("double") / float(1 << 53)
    # staged, so that the join's two sides are plain exchanges and a hot group can be split
    placed = staged(spark, groups, "shard-groups").select("g", *[(F.shiftleft(F.col(f"v_{d[2:]}"), TAIL_BITS) + tail).alias(d) for d in DIMS])
    return rows.select("doc_id", "size", "text_crc32", "g", u.alias("u")).join(placed, "g").drop("g")


def _by_node(values: dict[int, float]) -> Column:
    """The node's own value from a literal map; there are at most as many nodes as shards."""
    kind = "double" if any(isinstance(v, float) for v in values.values()) else "bigint"
    return F.element_at(F.create_map(*[x for n, v in values.items() for x in (F.lit(n), F.lit(v).cast(kind))]), F.col("node"))


def _coordinate(dims: dict[int, str]) -> Column:
    at = F.lit(None).cast("bigint")
    for d in DIMS:
        if own := [n for n, x in dims.items() if x == d]:
            at = F.when(F.col("node").isin(own), F.col(d)).otherwise(at)
    return at


def _level_cuts(at: DataFrame, shards_of: dict[int, int], slack: int) -> dict[int, dict]:
    """The cut of each open node: dimension, coordinate, and the share of the
    rows at that very coordinate that go left.

    Weighted medians by refined histograms: ``BINS`` bins a node and pass, so
    a 60-bit coordinate takes at most seven passes and mostly two or three.
    """
    stats = (
        at.where(F.col("node").isin(list(shards_of)))
        .groupBy("node")
        .agg(F.sum("size").alias("w"), *[f(d).alias(f"{n}_{d}") for d in DIMS for n, f in (("lo", F.min), ("hi", F.max))])
        .collect()
    )
    cuts, work = {}, {}
    for r in stats:
        n = r["node"]
        dim = max(DIMS, key=lambda d: (r[f"hi_{d}"] - r[f"lo_{d}"], -DIMS.index(d)))
        goal = r["w"] * (shards_of[n] // 2) / shards_of[n]
        work[n] = {"dim": dim, "lo": r[f"lo_{dim}"], "hi": r[f"hi_{dim}"] + 1, "below": 0, "goal": goal}
    while work:
        for x in work.values():
            x["width"] = max(1, -(-(x["hi"] - x["lo"]) // BINS))
        start, width = (_by_node({n: x[k] for n, x in work.items()}) for k in ("lo", "width"))
        offset = _coordinate({n: x["dim"] for n, x in work.items()}) - start
        counted = (
            at.where(F.col("node").isin(list(work)))
            .select("node", "size", offset.alias("offset"), width.alias("width"))
            .where((F.col("offset") >= 0) & (F.col("offset") < F.col("width") * BINS))
            .groupBy("node", F.round((F.col("offset") - F.pmod("offset", "width")) / F.col("width")).cast("int").alias("bin"))
            .agg(F.sum("size").alias("w"))
            .collect()
        )
        for n, x in list(work.items()):
            below = x["below"]
            for b, w in sorted((r["bin"], r["w"]) for r in counted if r["node"] == n):
                if below + w >= x["goal"]:
                    break
                below += w
            at_bin, short, over = x["lo"] + b * x["width"], x["goal"] - below, below + w - x["goal"]
            if min(short, over) <= slack:
                cuts[n] = {"dim": x["dim"], "cut": at_bin + (0 if short <= over else x["width"]), "share": 0.0}
            elif x["width"] == 1:
                cuts[n] = {"dim": x["dim"], "cut": at_bin, "share": short / w}
            else:
                x |= {"lo": at_bin, "hi": min(x["hi"], at_bin + x["width"]), "below": below}
                continue
            del work[n]
    return cuts


def shard_documents(spark: SparkSession, docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row; slots run gapless
    from 0 in id order. Each level of the tree is a few aggregations over a
    narrow staged table; a node is named by the first shard below it."""
    rows = staged(spark, points(docs), "shard-rows")
    at = staged(spark, _place(spark, rows).withColumn("node", F.lit(0)), "shard-points")
    slack = int((rows.agg(F.sum("size")).first()[0] or 0) / shards * tolerance / 2)
    nodes = {0: shards}
    while split := {n: k for n, k in nodes.items() if k > 1}:
        cuts = _level_cuts(at, split, slack)
        if cuts:
            c = _coordinate({n: x["dim"] for n, x in cuts.items()})
            cut, share, right = (
                _by_node(v)
                for v in ({n: x["cut"] for n, x in cuts.items()}, {n: x["share"] for n, x in cuts.items()}, {n: n + split[n] // 2 for n in cuts})
            )
            left = (c < cut) | ((c == cut) & (F.col("u") < share))
            moved = F.when(F.col("node").isin(list(cuts)) & ~left, right).otherwise(F.col("node"))
            at = staged(spark, at.withColumn("node", moved.cast("int")), "shard-level")
        nodes = {m: k for n, k0 in nodes.items() for m, k in ([(n, k0 // 2), (n + k0 // 2, k0 - k0 // 2)] if k0 > 1 else [(n, k0)])}
    return numbered(spark, at.select("doc_id", "size", "text_crc32", F.col("node").alias("shard")))


def numbered(spark: SparkSession, placed: DataFrame) -> DataFrame:
    """Adds ``slot``: sorted over many partitions, then shifted by the counts
    of the partitions before; no shard meets in one task."""
    ordered = placed.repartitionByRange("shard", "doc_id", "text_crc32").sortWithinPartitions("shard", "doc_id", "text_crc32")
    local = staged(spark, ordered.withColumn("__at", F.monotonically_increasing_id()), "shard-order")
    local = local.withColumn("__p", F.shiftright("__at", 33))
    parts = local.groupBy("__p", "shard").agg(F.min("__at").alias("__from"), F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("shard").orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("__p", "shard", (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__from")).alias("__shift"))
    # One row for each sorted partition and shard in it: partitions + shards at most.
    return local.join(parts, ["__p", "shard"]).select("doc_id", "size", "text_crc32", "shard", (F.col("__at") + F.col("__shift")).alias("slot"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_documents(spark, table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
