"""From raw documents to token files: filter, deduplicate, decontaminate, mix, encode.

Each stage takes the documents its predecessor kept and decides for all of
them; all but the last return the columns of ``documents``. Nulls, empty and
long texts, repeated rows and empty tables are handled by each operator as its
module says.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zerobill.llm import decontaminate, jaccard, mixing, quality_cnn, token_files
from zerobill.llm.common import table
from zerobill.session import drop_path, scratch_path, scratch_scope


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte-level network rejects go."""
    return quality_cnn.keep_good(docs, quality_cnn.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by a similarity of 0.8 over five-word shingles one document stays."""
    return jaccard.keep_one(spark, docs, k=5, num=80, den=100)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.contaminated(spark, docs, table(spark, sf_dir, "benchmark"), keep=True)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are taken as often as their source's target asks for."""
    return mixing.mixed_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files are written; returned is what their reader finds for each document."""
    read = token_files.token_files(spark, docs)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mix),
    ("token-ID / binary output", tokens),
]

#: The classifier's decisions are not expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stage stages for itself, and its input, go once its result is written."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        with scratch_scope(spark):
            kept = stage(spark, docs, sf_dir)
            kept.write.parquet(path)
        if last:
            drop_path(spark, last)
        docs, last = spark.read.schema(kept.schema).parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
