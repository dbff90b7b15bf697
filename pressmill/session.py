"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_root: str | None = None


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "pressmill", **conf: str) -> SparkSession:
    """A session with adaptive execution on; on a cluster pass only what you must."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    atexit.register(_clear_if_running, spark)
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only with a local master it may be a folder of this machine, and a temporary one
    if none is named. A session that doesn't tell its master counts as a cluster.
    """
    global _local_root
    configured = spark.conf.get("spark.checkpoint.dir", None)
    local = (spark.conf.get("spark.master", None) or "").startswith("local")
    if configured:
        if configured.startswith("file:") and not local:
            raise RuntimeError(f"executors do not share {configured}; name a folder they do")
        return configured
    if not local:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="pressmill-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return _local_root


def _stage_folder(spark: SparkSession) -> str:
    return os.path.join(shared_root(spark), f"pressmill-{spark.conf.get('spark.app.id', 'app')}")


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared root, grouped by application for clean-up."""
    return os.path.join(_stage_folder(spark), f"{name}-{uuid.uuid4().hex}")


def clear_stages(spark: SparkSession) -> None:
    """Remove all intermediate tables of this application.

    Call it when no DataFrame of the library will be read any more. Sessions from
    ``build_session`` that are still running when Python ends do it by themselves.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(_stage_folder(spark))
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def _clear_if_running(spark: SparkSession) -> None:
    if SparkSession.getActiveSession() is not None and spark.sparkContext._jsc is not None:
        clear_stages(spark)


@contextmanager
def with_settings(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Session settings for what is planned and run inside the block."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def materialize(df: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as a shared Parquet table and return a scan of it.

    Cuts the lineage in a way that survives lost executors, lets later reads
    prune columns, and gives the planner the true size of the table, so that it
    broadcasts the table only when it is below ``autoBroadcastJoinThreshold``.
    ``by`` names columns whose values have folders of their own.
    """
    path = stage_path(df.sparkSession, name)
    df.write.mode("errorifexists").partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
