"""Cutting lineage through storage that every executor shares."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: With this setting a query's shuffle files are deleted when it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Tables this process has written below the shared folder, and what is needed to delete them.
_written: list[tuple[object, object, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where the session names none and runs in one process (a ``local`` master, as
    in tests), a temporary folder is made once, recorded in the session, and
    removed when the process ends. On a cluster a folder of one machine would lose
    rows, so there a missing setting raises ``RuntimeError``.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
        where = tempfile.mkdtemp(prefix="jobloom-")
        atexit.register(shutil.rmtree, where, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses; it is deleted by ``release`` or when the process ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if not _written:
        atexit.register(release)
    _written.append((spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), path))
    return path


def release() -> None:
    """Delete all tables this process wrote below the shared folder; results that read them must have been used."""
    while _written:
        jvm, configuration, path = _written.pop()
        try:
            where = jvm.org.apache.hadoop.fs.Path(path)  # type: ignore[attr-defined]
            where.getFileSystem(configuration).delete(where, True)
        except Exception:  # noqa: BLE001  # the JVM has gone; the cluster's own cleaning is left
            return


def write_cut(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: its lineage ends at the files.

    An executor lost later costs only the tasks that ran on it. What was shuffled
    for the table goes with the write; else it stays on the disks until the driver
    happens to collect its garbage.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        writer.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)
    return spark.read.schema(df.schema).parquet(path)
