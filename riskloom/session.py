"""Session settings and the shared staging area."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "riskloom", master: str | None = None,
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    On a cluster, leave ``master`` and ``shuffle_partitions`` unset: the
    submitter's values then hold. Adaptive execution sizes the reduce side,
    turns joins with a small measured side into broadcast joins and splits
    skewed join partitions.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def staging_root(spark: SparkSession) -> str:
    """The shared folder for tables written between two steps of one job.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session
    that names none gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="riskloom-"))
    return context.getCheckpointDir()


def application_folder(spark: SparkSession) -> str:
    """The part of the staging folder that belongs to this application alone."""
    return os.path.join(staging_root(spark), "riskloom", spark.sparkContext.applicationId)


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the application's staging folder."""
    return os.path.join(application_folder(spark), f"{name}-{uuid.uuid4().hex}")


def clear_staged(spark: SparkSession) -> None:
    """Delete what this application has staged, once a job has written its results.

    Frames that still read a staged table cannot be used afterwards.
    """
    delete_staged(spark, application_folder(spark))


def delete_staged(spark: SparkSession, path: str) -> None:
    """Delete a folder below the staging folder."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def stage(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once and read it back.

    The copy cuts the lineage and survives lost executors. It also pins values
    that a recomputation could change, such as partition numbers, and it gives
    the optimizer real file sizes.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """The copy of ``stage`` for as long as the block lasts; then it is deleted."""
    path = staging_path(df.sparkSession, name)
    try:
        df.write.mode("errorifexists").parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        delete_staged(df.sparkSession, path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within the block, the shuffle files of a query go when it ends, not when the driver next collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Spread a scan over all cores before heavy work per row, if it has fewer splits.

    A small file can be a single row group, which one task reads alone. Inputs
    with at least as many splits as the cluster has cores pass unchanged, so
    large tables are never shuffled for this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)
