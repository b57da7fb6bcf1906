"""Connected components of an edge list, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zerobill.llm.common import staged


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, label) with label the smallest node reachable; edges (a, b) of longs.

    Each round hangs the neighbours of a node on the smallest of them (large
    star), then does the same for the smaller neighbours (small star); the
    edge list never grows and becomes stars after about log(n) rounds. A round
    is staged on the shared folder. Nodes without an edge are not returned.
    """
    cur = staged(spark, edges.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), "cc-0")
    seen = None
    for turn in range(1, 100):
        # large star: every neighbour above a node hangs on the node's smallest neighbour or itself
        both = cur.select(F.col("u").alias("x"), F.col("v").alias("y")).unionAll(cur.select(F.col("v").alias("x"), F.col("u").alias("y")))
        low = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        large = cur.select(F.col("u").alias("x"), F.col("v").alias("y")).join(low, "x").select(F.col("y").alias("v"), F.col("m").alias("u")).distinct()
        large = staged(spark, large, f"cc-{turn}a")
        # small star: a node and its smaller neighbours hang on the smallest of them
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v").select(F.explode(F.array(F.struct(F.col("v").alias("v"), F.col("m").alias("u")), F.struct(F.col("u").alias("v"), F.col("m").alias("u")))).alias("e"))
        cur = staged(spark, small.select("e.v", "e.u").where("v <> u").distinct(), f"cc-{turn}b")
        sums = cur.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("v", "u")), F.sum(F.shiftright(F.xxhash64("v", "u"), 20))).first()
        if tuple(sums) == seen:
            break
        seen = tuple(sums)
    else:
        raise RuntimeError("the edges have not become stars")
    return cur.select(F.col("v").alias("node"), F.col("u").alias("label")).unionAll(cur.select(F.col("u").alias("node"), F.col("u").alias("label")).distinct())
