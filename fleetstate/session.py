"""Session settings and the shared work folder."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the engine relies on for speed; none of them changes a result. On a cluster, also set
# spark.sql.adaptive.coalescePartitions.initialPartitionNum to a few times the core count.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Capture files written by pandas may hold nanosecond timestamps, which Spark can only read as integers.
    "spark.sql.legacy.parquet.nanosAsLong": "true",
}


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) handles for existence checks and deletes on whatever storage `path` is on."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = hadoop_path(spark, path)
    return fs.exists(jpath)


def list_files(spark: SparkSession, glob: str) -> list[str]:
    """Paths that match `glob`, in order."""
    fs, jpath = hadoop_path(spark, glob)
    return sorted(str(status.getPath().toString()) for status in fs.globStatus(jpath) or [])


def delete_path(spark: SparkSession, path: str) -> None:
    fs, jpath = hadoop_path(spark, path)
    fs.delete(jpath, True)


def shared_base(master: str, folder: str | None, checkpoint_dir: str | None, warehouse: str) -> str:
    """Where work folders lie: `folder` if given, else the session's checkpoint dir; on a local master also the warehouse.

    On a cluster a folder of the local file system is refused unless the caller names it (a mount that all share): other
    executors could not read what one writes there.
    """
    if folder:
        return folder
    if master.startswith("local[") or master == "local":
        return checkpoint_dir or warehouse
    if not checkpoint_dir or checkpoint_dir.startswith(("/", "file:")):
        raise ValueError(
            f"spark.checkpoint.dir is {checkpoint_dir!r}: not known to be shared by all executors; set it to a shared "
            "file system or pass a folder"
        )
    return checkpoint_dir


@contextmanager
def work_folder(spark: SparkSession, folder: str | None = None):
    """A folder of this run's own that every executor can reach, gone when the block ends; see `shared_base`."""
    conf = spark.conf
    base = shared_base(
        spark.sparkContext.master, folder, conf.get("spark.checkpoint.dir", None), conf.get("spark.sql.warehouse.dir")
    )
    path = f"{base.rstrip('/')}/fleetstate-{uuid.uuid4().hex}"
    try:
        yield path
    finally:
        delete_path(spark, path)


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write an intermediate result once and read it back.

    Unlike a cache it survives lost executors, and being parquet it can be read by column.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
