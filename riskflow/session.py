"""Session helpers: UTC everywhere, and a shared folder for written state."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "riskflow", conf: dict[str, str] | None = None) -> SparkSession:
    """Get or create a UTC session. The master comes from the launcher."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    for name, value in (conf or {}).items():
        builder = builder.config(name, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Runtime settings this library relies on.

    Windows, dates and hours are defined in UTC. The method limit is the size up to which
    the JVM compiles a method to machine code: a wider fused stage, such as the one that
    checks all contract fields, would run interpreted, so Spark should split it instead.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


@cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="riskflow-")


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table that nothing reads any more, in whatever store it lies."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def make_folder(spark: SparkSession, path: str) -> None:
    """Create a folder, if it is not there, in whatever store it lies."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(where)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the cluster's shared ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster the
    executors would not see it, and its files would go with the machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = _local_base()
    return f"{base.rstrip('/')}/riskflow/{purpose}-{uuid.uuid4().hex}"


def stored_table(frame: DataFrame, purpose: str) -> DataFrame:
    """Write a frame once below the shared folder and read it back: read often, without lineage."""
    path = shared_folder(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, unless they inherit a path that has it."""
    context, root = spark.sparkContext, Path(__file__).resolve().parents[1]
    inherited = [Path.cwd(), *map(Path, filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep)))]
    if context.master.startswith("local") and root in [p.resolve() for p in inherited]:
        return
    if context.applicationId not in _shipped:
        archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="run-"), "riskflow"), "zip", root, "riskflow")
        context.addPyFile(archive)
        _shipped.add(context.applicationId)


_shipped: set[str] = set()
