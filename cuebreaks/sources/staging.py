"""Shared intermediate relations, written once and read by several consumers."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, tempfile.TemporaryDirectory] = {}
_OPEN: list[Stage] = []


def shared_dir(spark: SparkSession) -> str:
    """Folder for written intermediate tables: the one the cluster names in ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    app = spark.conf.get("spark.app.id")
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.TemporaryDirectory(prefix="cuebreaks-")
        atexit.register(_LOCAL_DIRS[app].cleanup)
    return _LOCAL_DIRS[app].name


def _delete(spark: SparkSession, folder: str) -> None:
    """Delete a folder by the file system it lies in, as executors may not share the driver's disks."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Stage:
    """Writes relations as Parquet below the shared folder and hands back a scan of them.

    A staged relation cuts the lineage, survives the loss of any executor, is read with
    column pruning, and carries its file size, so Spark can size its joins.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, lasting: bool = False):
        self.spark = spark
        self.app = spark.conf.get("spark.app.id")
        self.root = f"{root or shared_dir(spark)}/cuebreaks-stage/{uuid.uuid4().hex}"
        self._written: list[tuple[str, DataFrame | None]] = []
        if not lasting:  # else it stays until released by name
            _OPEN.append(self)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{len(self._written):02d}-{name}"
        df.write.parquet(path)
        staged = self.spark.read.schema(df.schema).parquet(path)
        self._written.append((path, staged))
        return staged

    def drop(self, staged: DataFrame) -> None:
        """Delete one staged relation that nothing reads any more."""
        for place, (path, written) in enumerate(self._written):
            if written is staged:
                _delete(self.spark, path)
                self._written[place] = (path, None)

    def release(self) -> None:
        """Delete all of it; call it after the last action that reads a staged relation."""
        if self._written:
            _delete(self.spark, self.root)
        self._written.clear()
        if self in _OPEN:
            _OPEN.remove(self)


def release_staged(spark: SparkSession) -> None:
    """Release what operators staged in this application without being handed a stage.

    Call it when the results that read those relations have been written.
    """
    app = spark.conf.get("spark.app.id")
    for stage in [s for s in _OPEN if s.app == app]:
        stage.release()
