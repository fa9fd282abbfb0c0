"""Session helpers: builder, shared folder, staged tables."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app_name: str = "ebbline", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution on; a cluster's own settings are left alone."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    Only a local session without the setting gets a folder of its own, since there the driver and
    the executors are one process.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if not named and context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by the whole cluster")
        named = tempfile.mkdtemp(prefix="ebbline-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named or context.getCheckpointDir()


# Folders of the tables staged inside the open ``staging`` blocks, innermost last.
_open_blocks: list[list[str]] = []


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Delete the tables staged inside this block when it ends.

    For flows that end in a written table or in rows at the driver; frames that still read a staged
    table must not leave the block. Without a block staged tables stay.
    """
    _open_blocks.append([])
    try:
        yield
    finally:
        for path in _open_blocks.pop():
            delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder that this package has written."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several jobs need the same rows: the written table survives lost executors, each
    later pass reads only the columns it needs, and the lineage behind it ends here.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if _open_blocks:
        _open_blocks[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Give this package to the executors' Python workers, for sessions that were not started with it."""
    context = spark.sparkContext
    if "ebbline.zip" in context._python_includes:
        return
    root = Path(__file__).resolve().parent
    archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='ebbline-')}/ebbline", "zip", root.parent, root.name)
    context.addPyFile(archive)
