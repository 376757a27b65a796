"""Session helpers: building a session for tests/bench and locating the shared
checkpoint folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "peerguard",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Session for local runs (tests, bench). On a cluster, use the session the
    platform provides; nothing here is required by the library itself."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # local mode: the driver JVM is the only executor
            builder = builder.config("spark.driver.memory", os.environ.get("PEERGUARD_DRIVER_MEMORY", "16g"))
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256KB")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder. The cluster's setting wins; a
    folder of our own is only set when none is configured (tests, local runs)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="peerguard-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def _scratch_root(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/peerguard/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the application's scratch folder, in the shared
    checkpoint folder (written tables, streaming sources and sinks, CSV files
    derived from the driver tables)."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def close_scratch(spark: SparkSession) -> bool:
    """Remove all scratch of this application. Frames that read from it are of no
    use afterwards; tables that were given a path of their own stay."""
    return remove_path(spark, _scratch_root(spark))


def remove_read(df: DataFrame) -> None:
    """Remove the scratch tables of this application that ``df`` reads, when what it
    gives has been written itself and nothing else reads them."""
    spark = df.sparkSession
    mine = f"/peerguard/{spark.sparkContext.applicationId}/"
    for name in {f.split(mine, 1)[1].split("/")[0] for f in df.inputFiles() if mine in f}:
        remove_path(spark, f"{_scratch_root(spark)}/{name}")


def remove_path(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True))


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder, so a lost
    executor never forces a recompute from the raw scan."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence test through the Hadoop FileSystem of the path (works for
    HDFS/S3/GCS/local alike)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


__all__ = ["build_session", "ensure_checkpoint_dir", "scratch_path", "close_scratch", "remove_read", "materialize",
           "path_exists", "os"]


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``peerguard`` importable in Python workers (pandas UDFs pickle
    module functions by reference): zip the package once per application and
    hand it to ``addPyFile``, which distributes it with the job."""
    import zipfile
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    fd, zpath = tempfile.mkstemp(prefix="peerguard-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(zpath)
    _SHIPPED.add(app)
