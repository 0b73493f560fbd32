"""Storage that every executor can reach."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tablegate.config import ConfigError


def shared_folder(spark: SparkSession) -> str:
    """A new folder under the one named in spark.checkpoint.dir, deleted when this process ends.

    Only a local session may go without that setting; it gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ConfigError("spark.checkpoint.dir names no shared folder")
        root = tempfile.mkdtemp(prefix="tablegate-")
        atexit.register(shutil.rmtree, root, True)
    path = f"{root.rstrip('/')}/tablegate/{uuid.uuid4()}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of this process when it ends, if its JVM can still be reached."""
    try:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jvm.org.apache.hadoop.conf.Configuration()).delete(target, True)
    except Exception:
        pass


def has_shared_folder(spark: SparkSession) -> bool:
    """Whether rows can be stored where every executor reads them."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return bool(named) or spark.sparkContext.master.startswith("local")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` stored in the checkpoint folder, so that several readers do not compute it again."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def find_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where it lies, whatever folder the driver was started in."""
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join([root, known] if known else [root])
