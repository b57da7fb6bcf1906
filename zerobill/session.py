"""Session settings and the shared scratch location.

Settings are the ones the job relies on; everything else is left to the
cluster's defaults. Scratch output (lineage cuts, round-trip checks) always
goes below the cluster's shared ``spark.checkpoint.dir``; a private folder
is created only when that setting is unset (local tests).

Scratch does not outlive its use: all of a session's scratch lies in one
folder that the file system deletes when the driver ends, also after an
error; ``scratch_scope`` drops what a block of code stages when it is left,
and ``drop_scratch`` drops everything at once.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.orc.compression.codec": "snappy",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # no Python call-site capture per Column call while building plans
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


MB = 1024 * 1024


def cluster_conf(
    input_bytes: int,
    total_cores: int,
    shuffle_fraction: float = 0.1,
    scan_split_bytes: int = 256 * MB,
    shuffle_partition_bytes: int = 256 * MB,
) -> dict[str, str]:
    """Partition sizing for a large run, from the bytes the job scans.

    Scan tasks read ``scan_split_bytes`` each. The shuffles carry map-side
    pre-aggregated rows of a few columns, estimated as ``shuffle_fraction`` of
    the scanned bytes; the initial shuffle partition count gives each reducer
    about ``shuffle_partition_bytes`` of that, with at least two waves of the
    cluster's cores and at most ``max_partitions`` (so the map x reduce block
    count stays manageable). AQE then coalesces small partitions up to the
    advisory size and splits skewed join partitions, so no reducer task has to
    hold much more than ``shuffle_partition_bytes``.
    """
    if input_bytes <= 0 or total_cores <= 0:
        raise ValueError("input_bytes and total_cores must be positive")
    wanted = -(-int(input_bytes * shuffle_fraction) // shuffle_partition_bytes)
    partitions = max(2 * total_cores, wanted)
    return {
        "spark.sql.files.maxPartitionBytes": str(scan_split_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(shuffle_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(
            4 * shuffle_partition_bytes
        ),
    }


def build_session(
    master: str | None = None,
    app_name: str = "zerobill",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(JOB_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; set a private one only if none is configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    private = None if configured else tempfile.mkdtemp(prefix="zerobill-ckpt-")
    sc.setCheckpointDir(configured or private)
    if private:
        _delete_on_exit(spark, private)
    return sc.getCheckpointDir()


#: Scratch folders of each application: its root, then the open scopes.
_SCRATCH: dict[str, list[str]] = {}


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _delete_on_exit(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.mkdirs(target)
    fs.deleteOnExit(target)


def _scratch_folders(spark: SparkSession) -> list[str]:
    app = spark.sparkContext.applicationId
    if app not in _SCRATCH:
        root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/zerobill/{app}-{uuid.uuid4().hex[:8]}"
        _delete_on_exit(spark, root)
        _SCRATCH[app] = [root]
    return _SCRATCH[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder, in the innermost open scope."""
    return f"{_scratch_folders(spark)[-1]}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[str]:
    """Whatever takes a scratch path inside the block is dropped when it is
    left, also by an error. Frames that read it must be used up by then."""
    folders = _scratch_folders(spark)
    folder = f"{folders[-1]}/scope-{uuid.uuid4().hex[:8]}"
    folders.append(folder)
    try:
        yield folder
    finally:
        folders.remove(folder)
        drop_path(spark, folder)


def drop_scratch(spark: SparkSession) -> None:
    """Drop all scratch of this session now; later scratch gets a new folder."""
    for folder in _SCRATCH.pop(spark.sparkContext.applicationId, [])[:1]:
        drop_path(spark, folder)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system holds it."""
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder within a file system; the target must not exist."""
    fs, old = _file_system(spark, source)
    _, new = _file_system(spark, target)
    if new.getParent() is not None:
        fs.mkdirs(new.getParent())
    if fs.exists(new) or not fs.rename(old, new):
        raise OSError(f"cannot move {source} to {target}")
