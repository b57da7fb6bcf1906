"""Reading tables, staging on the shared folder, label folds, typed column access."""

from __future__ import annotations

import ctypes
import gc
import pickle
import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zerobill.session import drop_path, scratch_path

FOLD_MODULUS = 4
HELD_OUT_REMAINDER = 2

DOCUMENT_TYPES = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def typed(df: DataFrame, *names: str, types: dict[str, str] = DOCUMENT_TYPES) -> DataFrame:
    """Only the named columns, in their logical type; a missing one is all null.

    Extra columns, whatever their names, never reach an operator this way.
    """
    have = set(df.columns)
    return df.select(
        *[(F.col(f"`{n}`") if n in have else F.lit(None)).cast(types[n]).alias(n) for n in names]
    )


def staged(spark: SparkSession, df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write once below the shared checkpoint folder and read back: cuts the
    lineage, survives lost executors, and is computed a single time."""
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:8]}")
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Shared:
    """A broadcast whose classes travel with it, so that executors need no copy
    of this package; rebuilt once in each worker process."""

    def __init__(self, spark: SparkSession, value):
        self.sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        if not hasattr(self.sent, "rebuilt"):
            self.sent.rebuilt = pickle.loads(self.sent.value)
        return self.sent.rebuilt


def release(spark: SparkSession, df: DataFrame | None = None) -> None:
    """Drop a staged table that nothing reads any more, and let Spark's cleaner
    find shuffle files of finished jobs without waiting for memory to fill."""
    if df is not None:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            drop_path(spark, folder)
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def fresh_task() -> None:
    """Called where a task begins in a reused Python worker: drops words that
    an encoder kept there and hands freed memory back to the system."""
    kept = sys.modules.get("zerobill_word_cache")
    if kept is not None:
        kept.__dict__.get("words", {}).clear()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text modulo ``modulus``; null ids give null."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(modulus)


def held_out(doc_id: Column, modulus: int = FOLD_MODULUS, remainder: int = HELD_OUT_REMAINDER) -> Column:
    """Rows a model never learns from. A null id is not held out."""
    return F.coalesce(fold(doc_id, modulus) == remainder, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, max_bytes: int) -> DataFrame:
    """Bounded, deterministic sample of labelled training rows: (doc_id, text, y).

    At most ``rows`` documents in the order of a hash of their id, each of at
    most ``max_bytes`` UTF-8 bytes (longer ones are scored but not learnt
    from), never of the held-out fold. Repeated label rows of one id count
    once; ids whose labels disagree are left out.
    """
    marks = (
        typed(labels, "doc_id", label, types={"doc_id": "bigint", label: "int"})
        .where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
        .withColumn("__h", F.xxhash64(F.col("doc_id")))
        .groupBy("doc_id", "__h")
        .agg(F.min(label).alias("y"), F.max(label).alias("__top"))
        .where(F.col("y") == F.col("__top"))
        .orderBy("__h", "doc_id")
        .limit(rows)
        .select("doc_id", "__h", "y")
    )
    texts = typed(docs, "doc_id", "text").where(F.octet_length(F.coalesce("text", F.lit(""))) <= max_bytes)
    # Ids may repeat in documents: the bound holds for the rows, too.
    return (
        texts.join(F.broadcast(marks), "doc_id")
        .orderBy("__h", "doc_id", F.xxhash64("text"))
        .limit(rows)
        .select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "y")
    )
