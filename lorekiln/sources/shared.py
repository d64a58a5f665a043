"""Intermediate tables in the folder that driver and executors share.

``spark.checkpoint.dir`` names that folder on a cluster. Only where it is unset and Spark runs in
one process, as in local tests, a temporary folder of this machine stands in for it.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOT: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder for intermediate tables; read from the session."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOT:
        _LOCAL_ROOT[app] = "file://" + tempfile.mkdtemp(prefix="lorekiln-")
    return _LOCAL_ROOT[app]


class Workspace:
    """Parquet tables of one run below :func:`shared_root`.

    ``keep`` writes a frame and reads it back, which cuts its lineage: after a lost
    executor only the reading job is repeated. ``drop`` deletes a table that no later
    frame reads. What the returned, still lazy frame reads has to stay; ``close``
    deletes all of it once that frame was consumed.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_root(spark)}/lorekiln/{name}-{uuid.uuid4().hex}"

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def keep(self, df: DataFrame, table: str) -> DataFrame:
        df.write.parquet(self.path(table))
        return self.spark.read.schema(df.schema).parquet(self.path(table))

    def drop(self, table: str) -> None:
        self._delete(self.path(table))

    def close(self) -> None:
        self._delete(self.root)

    def _delete(self, path: str) -> None:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)
