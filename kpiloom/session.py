"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "kpiloom", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with adaptive execution on; cluster settings are left to the cluster."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.driver.memory", "8g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


_SHIPPED: set[str] = set()
#: Scratch paths by application.
_SCRATCH: dict[str, list[str]] = {}


def ship_package(spark: SparkSession) -> None:
    """Give this package to the executors' Python, once per application; jobs whose tasks run Python call it first."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parent
        archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='kpiloom-')}/{package.name}", "zip", package.parent, package.name)
        context.addPyFile(archive)
        _SHIPPED.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """Root for tables written between jobs: the folder the cluster names in spark.checkpoint.dir.

    Only a local-mode session may fall back to a temporary folder of its own; on a cluster such a
    folder would be invisible to the other machines.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="kpiloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    path = f"{shared_folder(spark)}/kpiloom/{name}-{uuid.uuid4().hex}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system Spark opens it in; one that is not there is none to delete."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def clear_scratch(spark: SparkSession) -> int:
    """Delete what this application has written under the shared folder, at the end of a run; returns the number of folders.

    DataFrames that read those folders can't be used any more.
    """
    paths = _SCRATCH.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        remove_folder(spark, path)
    return len(paths)


def materialized(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder and read back.

    For a result several branches of a plan start from: they then read this table instead of
    computing it again, also after an executor is lost.
    """
    ship_package(df.sparkSession)
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
