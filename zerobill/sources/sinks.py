"""Writers: full-refresh tables and the append-only alarm table.

All writes go through the DataFrame writer, so they are distributed (one
file per task) and atomic per job through Spark's output committer; a task
lost mid-write is simply retried. A full refresh writes the new table beside
the old one and swaps them only when it is complete, so a run that fails
leaves the last good table where it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zerobill.schemas import ALARM_COLUMNS, ALARM_SCHEMA
from zerobill.session import drop_path, move_path, path_exists

ORC = "orc"
SNAPPY = "snappy"
#: Properties of the kept tables; the writer reads the compression from them, too.
ORC_PROPERTIES = {"orc.compress": "SNAPPY", "transactional": "false"}


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = ORC,
    mode: str = "overwrite",
    compression: str | None = SNAPPY,
    partition_by: list[str] | None = None,
) -> None:
    """Create-as-select to a path. ``mode='overwrite'`` is a full refresh: the
    rows are written to a sibling folder, which then takes the place of the
    previous table. Until that moment the old table can be read."""

    def write(to: str, mode: str) -> None:
        writer = df.write.format(fmt).mode(mode)
        if compression:
            writer = writer.option("compression", compression)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.save(to)

    if mode != "overwrite":
        write(path, mode)
        return
    spark, path, tag = df.sparkSession, path.rstrip("/"), uuid.uuid4().hex[:8]
    fresh, old = f"{path}__new_{tag}", f"{path}__old_{tag}"
    try:
        write(fresh, "error")
        replaced = path_exists(spark, path)
        if replaced:
            move_path(spark, path, old)
        try:
            move_path(spark, fresh, path)
        except Exception:
            if replaced:
                move_path(spark, old, path)
            raise
        if replaced:
            drop_path(spark, old)
    except Exception:
        drop_path(spark, fresh)
        raise


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    """The detailed table information of a catalog table, by label."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    labels = [r["col_name"] for r in rows]
    first = labels.index("# Detailed Table Information")
    return {r["col_name"]: r["data_type"] for r in rows[first + 1 :]}


def table_properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def table_provider(spark: SparkSession, table: str) -> str:
    return _described(spark, table)["Provider"].lower()


def create_table(
    df: DataFrame,
    table: str,
    fmt: str | None = ORC,
    properties: Mapping[str, str] | None = None,
    location: str | None = None,
) -> None:
    """Create-as-select of a new catalog table.

    ``fmt=None`` leaves the format to the session's default source, like a
    create-as-select without a storage clause. ORC tables get the kept tables'
    properties unless others are given. With ``location`` the table is
    external, at that path.
    """
    if properties is None:
        properties = ORC_PROPERTIES if fmt == ORC else {}
    writer = df.writeTo(table)
    if fmt is not None:
        writer = writer.using(fmt)
    for key, value in properties.items():
        writer = writer.tableProperty(key, value)
    if location:
        writer = writer.option("path", location)
    writer.create()


def refresh_table(
    df: DataFrame,
    table: str,
    fmt: str | None = ORC,
    properties: Mapping[str, str] | None = None,
    location: str | None = None,
) -> None:
    """Full refresh of a catalog table: drop-and-create semantics without the gap.

    The new table is created under a name of its own (external ones in a
    folder of their own below ``location``); only when it is complete does it
    take the old table's name. If creating it fails, nothing has changed.
    """
    spark, tag = df.sparkSession, uuid.uuid4().hex[:8]
    fresh, old = f"{table}__new_{tag}", f"{table}__old_{tag}"
    place = f"{location.rstrip('/')}/{tag}" if location else None
    try:
        create_table(df, fresh, fmt, properties, place)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        drop_path(spark, place or _managed_location(spark, fresh))
        raise
    replaced = spark.catalog.tableExists(table)
    left = None
    if replaced:
        about = _described(spark, table)
        left = about.get("Location") if about.get("Type", "").upper() == "EXTERNAL" else None
        spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
    except Exception:
        if replaced:
            spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
        raise
    if replaced:
        spark.sql(f"DROP TABLE {old}")
        if left and location and left.rstrip("/").rsplit("/", 1)[0].removeprefix("file:").rstrip("/") == location.removeprefix("file:").rstrip("/"):
            drop_path(spark, left)  # an earlier refresh of this very table


def _managed_location(spark: SparkSession, table: str) -> str:
    database, _, name = table.rpartition(".")
    base = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    return f"{base.rstrip('/')}/{name.lower()}"


def save_as_table(
    df: DataFrame,
    table: str,
    fmt: str | None = None,
    path: str | None = None,
) -> None:
    """Full refresh into a catalog table, in the session's default format unless one is given."""
    refresh_table(df, table, fmt, location=path)


def save_bucketed(
    df: DataFrame,
    table: str,
    key: str,
    buckets: int,
    path: str | None = None,
    fmt: str = "parquet",
) -> None:
    """Store a source as a catalog table bucketed (and sorted) by ``key``.

    For a table read every month, bucketing ``billing_line`` by
    ``bill_ref_no`` lets the monthly roll-up (grouped by month, invoice,
    account) aggregate without any shuffle: the scan is already hash
    partitioned on a subset of the grouping keys.
    """
    writer = df.write.format(fmt).mode("overwrite").bucketBy(buckets, key).sortBy(key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def _positional(df: DataFrame) -> DataFrame:
    """The 56 alarm columns, in table order and table types."""
    if len(df.columns) != len(ALARM_COLUMNS):
        raise ValueError(f"alarm rows need {len(ALARM_COLUMNS)} columns, got {len(df.columns)}")
    return df.select(
        *[F.col(c).cast(f.dataType).alias(f.name) for c, f in zip(df.columns, ALARM_SCHEMA.fields)]
    )


def append_alarms(df: DataFrame, target: str, fmt: str | None = ORC) -> None:
    """Append alarm rows by position, like ``INSERT INTO t (query)``.

    ``fmt=None`` treats ``target`` as an existing catalog table: columns go by
    position whatever the table calls them, and values are converted by
    Spark's store assignment, which fails on what the table's type cannot
    hold. Otherwise ``target`` is a path and the rows are appended as files of
    that format. Not idempotent: a second run for the same month appends the
    rows again (see ``replace_period``).
    """
    if fmt is None:
        columns = len(df.sparkSession.table(target).columns)
        if len(df.columns) != columns:
            raise ValueError(f"{target} has {columns} columns, the rows have {len(df.columns)}")
        df.write.insertInto(target)
    else:
        _positional(df).write.format(fmt).mode("append").option("compression", SNAPPY).save(target)


def replace_period(df: DataFrame, path: str, fmt: str = ORC, period: str | None = None) -> None:
    """Idempotent alternative: overwrite only the ``(assunto, periodo)`` partitions written.

    Partition columns are stored in the folder names, so ``read_alarms``
    restores the table order. With ``period``, subjects of that period for
    which ``df`` has no rows any more are cleared, too.
    """
    rows = _positional(df)
    (
        rows.write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", SNAPPY)
        .partitionBy("assunto", "periodo")
        .save(path)
    )
    if period is not None:
        spark = df.sparkSession
        stored = spark.read.schema(ALARM_SCHEMA).format(fmt).load(path).where(F.col("periodo").cast("string") == period)
        written = rows.select("assunto").distinct()
        # a handful of subjects: partition folders, not rows
        for r in stored.select("assunto").distinct().join(written, "assunto", "left_anti").collect():
            drop_path(spark, f"{path}/assunto={r['assunto']}/periodo={period}")


def read_alarms(spark: SparkSession, path: str, fmt: str = ORC) -> DataFrame:
    """Read an alarm table written by either sink, columns in table order."""
    df = spark.read.schema(ALARM_SCHEMA).format(fmt).load(path)
    return df.select(*[F.col(f.name).cast(f.dataType) for f in ALARM_SCHEMA.fields])
