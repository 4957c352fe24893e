"""Session construction and the shared working folder.

On a cluster the session already exists and ``spark.checkpoint.dir`` names a
shared folder (HDFS/S3/ABFS).  Locally (tests, bench) we set one only when it
is unset.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings that matter at scale.  AQE re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed join partitions, so
# a hot key holding a third of the rows does not land in one task.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "citytherm", extra: dict | None = None) -> SparkSession:
    """Return the active session or build one with ``DEFAULT_CONF``.

    A master is set only when given, so a submitted job keeps the submitted
    one; driver memory only for a local master, where the driver does the work.
    """
    active = SparkSession.getActiveSession()
    if active is not None and master is None:
        return active
    b = SparkSession.builder.appName(app_name)
    conf = dict(DEFAULT_CONF)
    if master is not None:
        b = b.master(master)
        if master.startswith("local"):
            conf["spark.driver.memory"] = os.environ.get("CITYTHERM_DRIVER_MEMORY", "16g")
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def scale_conf(input_bytes: int, target_partition_bytes: int = 256 << 20,
               cores: int | None = None) -> dict[str, str]:
    """Partition sizing for a given input volume (e.g. 100 TB on a large cluster).

    Shuffle partitions are sized so each holds about ``target_partition_bytes``
    of input (at least 2x the cores); AQE then coalesces small partitions and
    splits skewed ones above 4x the advisory size, so partitions fit in
    executor memory without spilling whole groups.
    """
    parts = max(int(input_bytes // target_partition_bytes) + 1, 2 * (cores or 1))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(target_partition_bytes // 8),
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint folder from the session.  Where it is unset, a local master
    gets a temporary one; on a cluster that would be each machine's own, so it
    is an error there."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="citytherm-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application,
    so that functions run there need no installation and no common folder."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    home = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="citytherm-package-"), "citytherm-package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(home):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(home)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


_SHIPPED: set[str] = set()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root, unique per call."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"
