"""Session construction and shared scratch locations.

Scratch data (landing zones, versioned tables, lineage cuts) always lives
under the folder named by ``spark.checkpoint.dir`` so that it is visible to
every executor of a cluster.  Only when the session has no such setting (local
tests) do we create one.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Conf applied to sessions we build.  AQE re-plans joins with runtime sizes
# (small sides become broadcasts once their real size is known) and splits
# skewed shuffle partitions; partition counts coalesce after each shuffle.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


#: Scratch folders that are marked for deletion.
_SCRATCH: set[str] = set()


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "pitchforge", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        # local mode: driver and executors are one machine
        configured = tempfile.mkdtemp(prefix="pitchforge-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder.

    All paths of an application lie in one folder, which its file system
    deletes when the application ends.
    """
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pitchforge-{spark.sparkContext.applicationId}"
    if base not in _SCRATCH:
        path = spark._jvm.org.apache.hadoop.fs.Path(base)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _SCRATCH.add(base)
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, name: str = "cut") -> DataFrame:
    """Materialise ``df`` as Parquet in the shared folder and read it back.

    Used between stages whose input is also their output (versioned tables)
    and to bound lineage; survives executor loss because the data sits in
    the shared file system, unlike a local checkpoint.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Plan-time existence check through the Hadoop file system of ``path``."""
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


__all__ = ["get_session", "ensure_checkpoint_dir", "scratch_path", "cut_lineage",
           "path_exists", "DEFAULT_CONF"]
