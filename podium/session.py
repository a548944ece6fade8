"""Session and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "podium", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with AQE on and the UI off.  On a cluster the master and the
    resource settings come from spark-submit; ``master`` is for local runs."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # in local mode the driver JVM is the whole cluster: give it the machine's memory
            builder = builder.config("spark.driver.memory", os.environ.get("PODIUM_DRIVER_MEMORY", "16g"))
    builder = (builder
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the deployment sets it (a shared file system); where it is unset
    that is an error, since executors would write to disks of their own.  A local
    session without it gets one folder per application."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="podium-shared-")
    return _LOCAL[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new sub-path of the application's part of the shared folder, for an intermediate table."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/podium-{spark.sparkContext.applicationId}"


def clean_scratch(spark: SparkSession) -> None:
    """Remove all intermediate tables of this application; call it when the results that read them are written."""
    _WRITTEN.clear()
    path, fs = hadoop_path(spark, _scratch_root(spark))
    fs.delete(path, True)


def hadoop_path(spark: SparkSession, name: str):
    """(path, file system) of a name."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def input_stamp(spark: SparkSession, folder: str) -> tuple:
    """(name, modification time, bytes) of the tables of a folder: changes when an input is replaced."""
    path, fs = hadoop_path(spark, folder)
    out = []
    for status in fs.listStatus(path):
        at = status.getPath()
        files = fs.listStatus(at) if status.isDirectory() else [status]
        out.append((at.getName(), *sorted((f.getModificationTime(), f.getLen()) for f in files)))
    return tuple(sorted(out))


# Tables already written in this application: (app id, key) -> path.
_WRITTEN: dict[tuple, str] = {}


def written_once(spark: SparkSession, key: tuple, build, inputs: str | None = None) -> DataFrame:
    """``build()`` written once per application and ``key`` to the shared folder,
    then read back.  For intermediate tables that several outputs reuse (the
    bound results, the starts, the merged board): later readers skip the upstream
    plan, and a lost executor re-reads files instead of recomputing lineage.
    ``inputs``: the folder it is built from; when a table there changes, it is
    built anew."""
    full = (spark.sparkContext.applicationId, *key, input_stamp(spark, inputs) if inputs else None)
    path = _WRITTEN.get(full)
    if path is None:
        path = scratch_path(spark, "-".join(str(k) for k in key[:1]) or "table")
        build().write.mode("errorifexists").parquet(path)
        _WRITTEN[full] = path
    return spark.read.parquet(path)


def scale_settings(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a run over ``input_bytes`` of parquet on ``total_cores`` cores.

    Shuffle partitions are sized so each holds about ``target_partition_bytes``
    (and at least two waves of tasks), so sorts and aggregations fit executor
    memory and spill only at the margins; AQE then coalesces small ones and
    splits skewed join partitions.  File splits stay at 256 MB."""
    partitions = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package's sources to the executors, once an application: their Python workers import them."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    sc.addPyFile(str(target))
    _SHIPPED.add(sc.applicationId)
